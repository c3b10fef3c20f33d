"""DuckDB oracles of the closed-form learners: ridge as a linear solve (Gauss-Jordan as a
recursive query over the Gram matrix) and boosted stumps, round by round."""

from __future__ import annotations

import re
from collections.abc import Sequence

from cadence.config import LINEAR_NUMERIC, LINEAR_ONE_HOT, LINEAR_PASSTHROUGH


def _long(src: str, numeric: Sequence[str], passthrough: Sequence[str], one_hot: Sequence[str]) -> str:
    """One row per (fit, row, column with a value); a level is a column of ones."""
    parts = [f"SELECT f, rid, '{c}' AS c, CAST({c} AS DOUBLE) AS x FROM {src}" for c in (*numeric, *passthrough)]
    parts += [f"SELECT f, rid, '{c}=' || CAST({c} AS VARCHAR), 1.0::DOUBLE FROM {src} WHERE {c} IS NOT NULL" for c in one_hot]
    return " UNION ALL ".join(parts)


def ridge_ctes(train: str, judged: str, label: str = "count", alpha: float = 1.0, numeric: Sequence[str] = LINEAR_NUMERIC,
               passthrough: Sequence[str] = LINEAR_PASSTHROUGH, one_hot: Sequence[str] = LINEAR_ONE_HOT, tag: str = "") -> list[str]:
    """CTEs up to ``rp`` (f, rid, log_pred): ridge of ln(1 + label), fitted per f on the
    rows of ``train`` (f, rid, columns), for the rows of ``judged`` (f, rid, columns);
    and ``rw`` (f, c, w), ``rb`` (f, b): raw weights and intercepts. Needs RECURSIVE. All names end in ``tag``."""
    scaled = ", ".join(f"'{c}'" for c in numeric) or "''"
    ctes = [
        f"rx AS ({_long(train, numeric, passthrough, one_hot)} UNION ALL SELECT f, rid, '~y', ln(1 + {label}) FROM {train})",
        f"rn AS (SELECT f, count(*) AS n FROM {train} GROUP BY f)",
        "rm AS (SELECT rx.f, c, sum(x) / any_value(n) AS m, CASE WHEN c IN (" + scaled + ") AND stddev_pop(x) > 0 THEN stddev_pop(x) ELSE 1.0::DOUBLE END AS s, "
        "any_value(n) AS n, row_number() OVER (PARTITION BY rx.f ORDER BY c) AS j FROM rx JOIN rn ON rn.f = rx.f GROUP BY rx.f, c)",
        "rg AS (SELECT a.f, a.c AS a, b.c AS b, sum(a.x * b.x) AS g FROM rx a JOIN rx b ON a.f = b.f AND a.rid = b.rid GROUP BY ALL)",
        "rc AS (SELECT a.f, a.j AS i, b.j, (coalesce(g, 0) - a.n * a.m * b.m) / (a.s * b.s) "
        f"+ CASE WHEN a.j = b.j THEN {float(alpha)!r}::DOUBLE ELSE 0 END AS v "
        "FROM rm a JOIN rm b ON a.f = b.f LEFT JOIN rg ON rg.f = a.f AND rg.a = a.c AND rg.b = b.c WHERE a.c <> '~y')",
        "rr AS (SELECT f, i, list(v ORDER BY j) AS r FROM rc GROUP BY f, i)",
        "gj AS (SELECT f, 0 AS k, CAST(count(*) AS INTEGER) AS p, list(r ORDER BY i) AS m FROM rr GROUP BY f UNION ALL "
        "SELECT f, k + 1, p, list_transform(m, lambda row, i: CASE WHEN i = k + 1 THEN piv "
        "ELSE list_transform(row, lambda v, j: v - row[k + 1] * piv[j]) END) "
        "FROM (SELECT *, list_transform(m[k + 1], lambda v: v / m[k + 1][k + 1]) AS piv FROM gj WHERE k < p))",
        "rs AS (SELECT f, unnest(list_transform(m, lambda row: row[p + 1])) AS w, unnest(range(1, p + 1)) AS j FROM gj WHERE k = p)",
        "rw AS (SELECT rs.f, rm.c, rs.w / rm.s AS w, rm.m FROM rs JOIN rm ON rm.f = rs.f AND rm.j = rs.j)",
        "rb AS (SELECT rw.f, any_value(y.m) - sum(rw.w * rw.m) AS b FROM rw JOIN rm y ON y.f = rw.f AND y.c = '~y' GROUP BY rw.f)",
        f"re AS ({_long(judged, numeric, passthrough, one_hot)})",
        "rp AS (SELECT re.f, re.rid, any_value(rb.b) + sum(re.x * coalesce(rw.w, 0)) AS log_pred FROM re JOIN rb ON rb.f = re.f "
        "LEFT JOIN rw ON rw.f = re.f AND rw.c = re.c GROUP BY re.f, re.rid)",
    ]
    own = re.compile(r"\b(rx|rn|rm|rg|rc|rr|gj|rs|rw|rb|re|rp)\b(?!')")
    return [own.sub(lambda m: m[1] + tag, c) for c in ctes] if tag else ctes


#: The prediction on the count scale.
BACK = "CASE WHEN exp({0}) - 1 < 0 THEN 0.0::DOUBLE ELSE exp({0}) - 1 END"


def recursive(sql: str) -> str:
    return sql.replace("WITH ", "WITH RECURSIVE ", 1)


def stump_ctes(train: str, judged: str, features: Sequence[str], rounds: int, rate: float, label: str = "count",
               tag: str = "", penalty: float = 0.0) -> list[str]:
    """CTEs up to ``sp`` (rid, log_pred) and ``sb`` (round, c, gain): boosting of depth 1
    from the mean of ln(1 + label), unrolled, with an L2 ``penalty`` on leaves. Cuts lie midway between neighbouring values
    of the training rows. All names end in ``tag``."""
    long = " UNION ALL ".join(f"SELECT rid, {k} AS o, '{c}' AS c, CAST({c} AS DOUBLE) AS x, {{y}} AS y FROM {{src}}" for k, c in enumerate(features))
    out = [f"sx AS (SELECT *, y - (SELECT avg(ln(1 + {label})) FROM {train}) AS g0 FROM ({long.format(src=train, y=f'ln(1 + {label})')}))"]
    grad = "g0"
    for k in range(rounds):
        out += [
            f"sv{k} AS (SELECT o, c, x, sum({grad}) AS g, count(*) AS n FROM sx{'' if not k else k} GROUP BY o, c, x)",
            f"sc{k} AS (SELECT o, c, x, (x + lead(x) OVER w) / 2 AS cut, sum(g) OVER w AS gl, sum(n) OVER w AS nl, "
            f"sum(g) OVER (PARTITION BY c) AS g, sum(n) OVER (PARTITION BY c) AS n FROM sv{k} WINDOW w AS (PARTITION BY c ORDER BY x))",
            f"sk{k} AS (SELECT *, gl * gl / (nl + {penalty!r}::DOUBLE) + (g - gl) * (g - gl) / (n - nl + {penalty!r}::DOUBLE) - g * g / (n + {penalty!r}::DOUBLE) AS gain FROM sc{k} WHERE nl < n)",
            f"s{k} AS (SELECT * FROM sk{k} ORDER BY round(gain, 9) DESC, o, x LIMIT 1)",
            f"sl{k} AS (SELECT rid, CASE WHEN x <= (SELECT cut FROM s{k}) THEN (SELECT {rate!r}::DOUBLE * gl / (nl + {penalty!r}::DOUBLE) FROM s{k}) "
            f"ELSE (SELECT {rate!r}::DOUBLE * (g - gl) / (n - nl + {penalty!r}::DOUBLE) FROM s{k}) END AS v FROM sx WHERE c = (SELECT c FROM s{k}))",
            f"sx{k + 1} AS (SELECT a.*, a.{grad} - l.v AS g{k + 1} FROM sx{'' if not k else k} a JOIN sl{k} l USING (rid))",
        ]
        grad = f"g{k + 1}"
    long = long.format(src=judged, y="0")
    value = " + ".join(f"sum(CASE WHEN e.c = s{k}.c THEN CASE WHEN e.x <= s{k}.cut THEN {rate!r}::DOUBLE * s{k}.gl / (s{k}.nl + {penalty!r}::DOUBLE) "
                       f"ELSE {rate!r}::DOUBLE * (s{k}.g - s{k}.gl) / (s{k}.n - s{k}.nl + {penalty!r}::DOUBLE) END END)" for k in range(rounds))
    out += [f"sp AS (SELECT rid, (SELECT avg(ln(1 + {label})) FROM {train}) + {value} AS log_pred FROM ({long}) e "
            + " ".join(f"CROSS JOIN s{k}" for k in range(rounds)) + " GROUP BY rid)",
            "sb AS (" + " UNION ALL ".join(f"SELECT {k} AS round, c, gain FROM s{k}" for k in range(rounds)) + ")"]
    own = re.compile(r"\b(s[xvckl]?\d*|sx|sp|sb)\b(?!\()")
    return [own.sub(lambda m: m[1] + tag if m[1] != "s" else m[1], c) for c in out] if tag else out
