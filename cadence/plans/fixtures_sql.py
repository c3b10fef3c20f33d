"""DuckDB twins of the F1-F4 fixture frames and of the feature projection.

Float literals are written as DOUBLE so that DuckDB does not switch to exact
decimal arithmetic where Spark uses doubles.
"""

from __future__ import annotations

K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"


def _calendar(dt: str) -> str:
    return (f"CAST(CASE WHEN isodow({dt}) - 1 < 5 THEN 1 ELSE 0 END AS INTEGER) AS workingday, "
            f"CAST(CASE WHEN day({dt}) = 1 THEN 1 ELSE 0 END AS INTEGER) AS holiday")


F1 = f"""f1 AS (
  SELECT datetime,
         date_diff('hour', TIMESTAMP '1970-01-01 00:00:00', datetime) AS row_id,
         CAST(1 + floor((day(datetime) - 1) / 8) AS INTEGER) AS season,
         {_calendar('datetime')},
         CAST(1 + floor(humidity / 25) AS INTEGER) AS weather,
         avg_value / 2 AS temp,
         2 + 0.9::DOUBLE * (avg_value / 2) + 0.05::DOUBLE * humidity
           + 0.01::DOUBLE * (date_diff('hour', TIMESTAMP '1970-01-01 00:00:00', datetime) % 7) AS atemp,
         humidity, windspeed, casual, count - casual AS registered, count
  FROM (SELECT date_trunc('hour', ts) AS datetime,
               count(*) AS count,
               count(*) FILTER (WHERE event_type = 'purchase') AS casual,
               avg(k) AS humidity,
               CAST(sum(CAST(value AS DECIMAL(18, 2))) AS DOUBLE) / count(*) AS avg_value,
               CAST(count(*) FILTER (WHERE event_type = 'error' AND k < 5) AS DOUBLE) AS windspeed
        FROM (SELECT ts, event_type, value, {K} AS k FROM events) e
        GROUP BY 1) h
)"""

F2 = f"""f2 AS (
  SELECT ts AS datetime,
         event_id AS row_id,
         CAST(1 + floor((day(ts) - 1) / 8) AS INTEGER) AS season,
         {_calendar('ts')},
         CAST(1 + floor(k / 25) AS INTEGER) AS weather,
         5 + 30 * (event_id % 97) / 96 AS temp,
         2 + 0.9::DOUBLE * (5 + 30 * (event_id % 97) / 96) + 0.05::DOUBLE * k
           + 0.01::DOUBLE * (event_id % 7) AS atemp,
         CAST(k AS DOUBLE) AS humidity,
         CASE WHEN k < 10 THEN 0.0::DOUBLE ELSE k / 2.0::DOUBLE END AS windspeed,
         CASE WHEN event_type = 'purchase' THEN value ELSE 0.0::DOUBLE END AS casual,
         value - CASE WHEN event_type = 'purchase' THEN value ELSE 0.0::DOUBLE END AS registered,
         value AS count
  FROM (SELECT *, {K} AS k FROM events) e
)"""

F3 = f"""f3 AS (
  SELECT o_orderdate AS datetime,
         o_orderkey AS row_id,
         CAST(quarter(o_orderdate) AS INTEGER) AS season,
         {_calendar('o_orderdate')},
         CAST(1 + o_custkey % 4 AS INTEGER) AS weather,
         CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0.0::DOUBLE END AS casual,
         o_totalprice - CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0.0::DOUBLE END AS registered,
         o_totalprice AS count
  FROM orders
)"""

F4 = f"""f4 AS (
  SELECT l_shipdate AS datetime,
         l_orderkey, l_partkey, l_suppkey, l_linenumber, l_extendedprice,
         CAST(quarter(l_shipdate) AS INTEGER) AS season,
         {_calendar('l_shipdate')},
         CAST(1 + l_suppkey % 4 AS INTEGER) AS weather,
         l_tax * 400 AS temp,
         2 + 0.9::DOUBLE * (l_tax * 400) + 0.05::DOUBLE * (l_discount * 1000) AS atemp,
         l_discount * 1000 AS humidity,
         CAST(l_linenumber - 1 AS DOUBLE) AS windspeed,
         CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0::DOUBLE END AS casual,
         l_quantity - CASE WHEN l_returnflag = 'R' THEN l_quantity ELSE 0.0::DOUBLE END AS registered,
         l_quantity AS count
  FROM lineitem
)"""

FIXTURE_CTES = {"f1": F1, "f2": F2, "f3": F3, "f4": F4}

PI2 = "(2 * pi())"


def feature_select(src: str) -> str:
    """The B8 projection over a fixture CTE, as a CTE named ``{src}x``."""
    return f"""{src}x AS (
  SELECT *,
    CAST(hour(datetime) AS SMALLINT) AS hour,
    CAST(isodow(datetime) - 1 AS SMALLINT) AS dayofweek,
    CAST(month(datetime) AS SMALLINT) AS month,
    CAST(year(datetime) AS SMALLINT) AS year,
    CAST(CASE WHEN isodow(datetime) - 1 >= 5 THEN 1 ELSE 0 END AS TINYINT) AS is_weekend,
    CAST(sin({PI2} * hour(datetime) / 24) AS FLOAT) AS hour_sin,
    CAST(cos({PI2} * hour(datetime) / 24) AS FLOAT) AS hour_cos,
    CAST(sin({PI2} * (month(datetime) - 1) / 12) AS FLOAT) AS month_sin,
    CAST(cos({PI2} * (month(datetime) - 1) / 12) AS FLOAT) AS month_cos,
    CAST(sin(2 * {PI2} * hour(datetime) / 24) AS FLOAT) AS hour_sin2,
    CAST(cos(2 * {PI2} * hour(datetime) / 24) AS FLOAT) AS hour_cos2,
    CAST(CAST(sin({PI2} * hour(datetime) / 24) AS FLOAT) * workingday AS FLOAT) AS hour_sin_workday,
    CAST(CAST(cos({PI2} * hour(datetime) / 24) AS FLOAT) * workingday AS FLOAT) AS hour_cos_workday
  FROM {src}
)"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
