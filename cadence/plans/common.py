"""Output hygiene shared by every registered query and its DuckDB oracle.

Rounding is spelled out as plain IEEE arithmetic, ``floor(x * 10^d + 0.5) / 10^d``
(ties toward +inf), identical in both engines; the engines' own ``round`` functions
disagree on exact ties (one rounds the shortest decimal string, the other the
scaled binary value). ``x`` appears once, so wide projections stay small, and the
result is never -0.0. Pick fewer digits for magnitudes near 1e12 and above.

Spark side: doubles rounded (6 places by default, fewer for large magnitudes),
negative zero folded to zero, every integer type widened to bigint, timestamps
rendered as ``yyyy-MM-dd HH:mm:ss`` text, booleans as 0/1 bigint. The DuckDB
side applies the same rules through the ``r``/``i``/``ts`` text helpers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_INTS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.BooleanType)
_FLOATS = (T.FloatType, T.DoubleType, T.DecimalType)
_TIMES = (T.TimestampType, T.TimestampNTZType)


def finish(df: DataFrame, digits: int = 6, overrides: dict[str, int] | None = None) -> DataFrame:
    overrides = overrides or {}
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, _FLOATS):
            c = round_expr(c.cast("double"), overrides.get(f.name, digits))
        elif isinstance(t, _INTS):
            c = c.cast("long")
        elif isinstance(t, (T.DateType,) + _TIMES):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        cols.append(c.alias(f.name))
    return df.select(*cols)


def round_expr(x, digits: int):
    scale = float(10 ** digits)
    return F.floor(x * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


# --- DuckDB text helpers ---------------------------------------------------------
def r(expr: str, digits: int = 6) -> str:
    """Round a double the same way ``finish`` does."""
    scale = f"{float(10 ** digits)!r}::DOUBLE"
    return f"(floor(CAST({expr} AS DOUBLE) * {scale} + 0.5::DOUBLE) / {scale})"


def i(expr: str) -> str:
    return f"CAST({expr} AS BIGINT)"


def ts(expr: str) -> str:
    return f"strftime({expr}, '%Y-%m-%d %H:%M:%S')"
