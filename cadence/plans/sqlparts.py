"""Reusable DuckDB SQL fragments for the oracles."""

from __future__ import annotations

from cadence.plans.common import i, r


def report_sql(y: str = "y", p: str = "pred", with_n: bool = True) -> str:
    """The four metrics (E26-E30) as DuckDB aggregate expressions."""
    pc = f"(CASE WHEN {p} < 0 THEN 0.0 ELSE {p} END)"
    ss_tot = f"(var_pop({y}) * count({y}))"
    close = f"(count(*) FILTER (WHERE abs({y} - {p}) > 1e-8::DOUBLE + 1e-5::DOUBLE * abs({p})) = 0)"
    r2 = (f"CASE WHEN {ss_tot} = 0 THEN (CASE WHEN {close} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) "
          f"ELSE 1 - sum(({p} - {y}) * ({p} - {y})) / {ss_tot} END")
    parts = [
        f"{r(f'sqrt(avg((ln(1 + {pc}) - ln(1 + {y})) * (ln(1 + {pc}) - ln(1 + {y}))))')} AS rmsle",
        f"{r(f'sqrt(avg(({p} - {y}) * ({p} - {y})))')} AS rmse",
        f"{r(f'avg(abs({p} - {y}))')} AS mae",
        f"{r(r2)} AS r2",
    ]
    if with_n:
        parts.append(f"{i('count(*)')} AS n")
    return ", ".join(parts)


def report_sql_raw(y: str = "y", p: str = "pred") -> str:
    """Unrounded metrics, for further aggregation (fold summaries)."""
    pc = f"(CASE WHEN {p} < 0 THEN 0.0 ELSE {p} END)"
    ss_tot = f"(var_pop({y}) * count({y}))"
    close = f"(count(*) FILTER (WHERE abs({y} - {p}) > 1e-8::DOUBLE + 1e-5::DOUBLE * abs({p})) = 0)"
    r2 = (f"CASE WHEN {ss_tot} = 0 THEN (CASE WHEN {close} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) "
          f"ELSE 1 - sum(({p} - {y}) * ({p} - {y})) / {ss_tot} END")
    return (f"sqrt(avg((ln(1 + {pc}) - ln(1 + {y})) * (ln(1 + {pc}) - ln(1 + {y})))) AS rmsle, "
            f"sqrt(avg(({p} - {y}) * ({p} - {y}))) AS rmse, avg(abs({p} - {y})) AS mae, {r2} AS r2, "
            f"count(*) AS n")


def fold_cte(src: str, order: str, k: int = 5, gap: int = 0, name: str = "fz") -> str:
    """Rank rows of ``src`` chronologically and tag val_fold / train_seg (C4)."""
    return f"""{name}_r AS (
  SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS rank, count(*) OVER () AS n_all FROM {src}
),
{name} AS (
  SELECT *,
    CASE WHEN rank >= n_all - {k} * (n_all // {k + 1})
         THEN CAST((rank - (n_all - {k} * (n_all // {k + 1}))) // (n_all // {k + 1}) + 1 AS INTEGER) END AS val_fold,
    CAST(CASE {' '.join(f'WHEN rank < n_all - ({k} - {j}) * (n_all // {k + 1}) - {gap} THEN {j + 1}' for j in range(k))}
         ELSE {k + 1} END AS INTEGER) AS train_seg
  FROM {name}_r
)"""
