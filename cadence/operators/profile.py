"""Data profiles (E1-E22, D2, D3): every report is one or two aggregations with
partial (map-side) combine; only the small results are reshaped."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cadence.operators.order import cut_expr, exact_quantiles, join_small, quantile_edges

_FLOATS = (T.FloatType, T.DoubleType)


def _missing(df: DataFrame, c: str) -> Column:
    col = F.col(f"`{c}`")
    cond = col.isNull()
    if isinstance(df.schema[c].dataType, _FLOATS):
        cond = cond | F.isnan(col)
    return F.count_if(cond)


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: dtype, missing count (NULL or NaN), and the row count."""
    cols = df.columns
    wide = df.agg(F.count(F.lit(1)).alias("_n"), *[_missing(df, c).alias(f"m_{k}") for k, c in enumerate(cols)])
    spark = df.sparkSession
    meta = spark.createDataFrame([(k, c, df.schema[c].dataType.simpleString()) for k, c in enumerate(cols)],
                                 "k int, column string, dtype string")
    long = wide.unpivot("_n", [f"m_{k}" for k in range(len(cols))], "key", "n_missing") \
        .withColumn("k", F.regexp_extract("key", r"m_(\d+)", 1).cast("int"))
    return long.join(F.broadcast(meta), "k").select("column", "dtype", "n_missing", F.col("_n").alias("n_rows"))


def leakage_identity(df: DataFrame, parts=("casual", "registered"), total: str = "count") -> DataFrame:
    """Rows where the sub-targets do not add up to the target (expect 0)."""
    a, b = parts
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(~(F.col(a) + F.col(b)).eqNullSafe(F.col(total))).alias("n_mismatch"))


def feature_profile(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Dtype, min and max of each listed column (long form)."""
    aggs = []
    for k, c in enumerate(cols):
        aggs += [F.min(c).cast("double").alias(f"lo_{k}"), F.max(c).cast("double").alias(f"hi_{k}")]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"),
                                        F.lit(df.schema[c].dataType.simpleString()).alias("dtype"),
                                        F.col(f"lo_{k}").alias("min"), F.col(f"hi_{k}").alias("max"))
                               for k, c in enumerate(cols)]))
    return wide.select(rows.alias("r")).select("r.*")


def group_mean(df: DataFrame, keys: Sequence[str], value: str, name: str = "mean") -> DataFrame:
    """Mean of ``value`` per key combination, with the group size."""
    return df.groupBy(*keys).agg(F.avg(value).alias(name), F.count(F.lit(1)).alias("n"))


def level_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per level, sorted by level."""
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(col)


def _shares(df: DataFrame, cols: Sequence[str], name: str) -> DataFrame:
    # rows are counted by all columns first; only those counts are unpivoted
    cells = df.groupBy(*[F.col(c).cast("string").alias(c) for c in cols]).agg(F.count(F.lit(1)).alias("_n"))
    long = cells.unpivot(["_n"], list(cols), "column", "level")
    counts = long.groupBy("column", "level").agg(F.sum("_n").alias("_c"))
    # The window runs over the aggregated (column, level) table, not over rows.
    return counts.withColumn(name, F.col("_c") / F.sum("_c").over(Window.partitionBy("column"))).drop("_c")


def level_shares(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> DataFrame:
    """E9 + D2: share of each level per column, train against test; a level absent
    on one side has share 0 there (full outer join)."""
    a = _shares(train, cols, "train_share")
    b = _shares(test, cols, "test_share")
    return a.join(b, ["column", "level"], "full_outer").select(
        "column", "level", F.coalesce("train_share", F.lit(0.0)).alias("train_share"),
        F.coalesce("test_share", F.lit(0.0)).alias("test_share"))


def _moments(df: DataFrame, cols: Sequence[str], side: str) -> DataFrame:
    aggs = []
    for k, c in enumerate(cols):
        aggs += [F.avg(c).alias(f"a_{k}"), F.stddev_samp(c).alias(f"s_{k}")]
    wide = df.agg(*aggs)
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"a_{k}").alias(f"{side}_mean"),
                                        F.col(f"s_{k}").alias(f"{side}_std")) for k, c in enumerate(cols)]))
    return wide.select(rows.alias("r")).select("r.*")


def moments_compare(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> DataFrame:
    """E10 + D3: mean and sample std of numeric columns, train against test, aligned
    by column name."""
    return _moments(train, cols, "train").join(_moments(test, cols, "test"), "column", "full_outer")


def _r(cov: Column, sa: Column, sb: Column) -> Column:
    """Pearson from covar_pop / (stddev_pop * stddev_pop); NULL when a side is constant."""
    den = sa * sb
    return cov / F.when(den != 0, den)


def pearson_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The full matrix in long form (col_a, col_b, r), one pass over the rows:
    one population std per column and one covariance per unordered pair (k + k(k-1)/2
    aggregates, not three per pair); r is assembled on the one-row result."""
    k = len(cols)
    casted = df.select(*[F.col(c).cast("double").alias(f"c{j}") for j, c in enumerate(cols)])
    pairs = [(a, b) for a in range(k) for b in range(a + 1, k)]
    wide = casted.agg(*[F.stddev_pop(f"c{j}").alias(f"s{j}") for j in range(k)],
                      *[F.covar_pop(f"c{a}", f"c{b}").alias(f"v_{a}_{b}") for a, b in pairs])
    entries = []
    for a in range(k):
        for b in range(k):
            if a == b:
                r = _r(F.col(f"s{a}") * F.col(f"s{a}"), F.col(f"s{a}"), F.col(f"s{a}"))
            else:
                lo, hi = min(a, b), max(a, b)
                r = _r(F.col(f"v_{lo}_{hi}"), F.col(f"s{a}"), F.col(f"s{b}"))
            entries.append(F.struct(F.lit(cols[a]).alias("col_a"), F.lit(cols[b]).alias("col_b"), r.alias("r")))
    return wide.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def pearson_with_target(df: DataFrame, cols: Sequence[str], target: str) -> DataFrame:
    """Correlation of each column with the target, sorted descending."""
    casted = df.select(F.col(target).cast("double").alias("_y"),
                       *[F.col(c).cast("double").alias(f"c{k}") for k, c in enumerate(cols)])
    wide = casted.agg(F.stddev_pop("_y").alias("sy"), *[F.stddev_pop(f"c{k}").alias(f"s{k}") for k in range(len(cols))],
                      *[F.covar_pop(f"c{k}", "_y").alias(f"v{k}") for k in range(len(cols))])
    rows = F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), _r(F.col(f"v{k}"), F.col(f"s{k}"), F.col("sy")).alias("r"))
                               for k, c in enumerate(cols)]))
    return wide.select(rows.alias("e")).select("e.*").orderBy(F.desc_nulls_last("r"), "feature")


def pivot_mean(df: DataFrame, row: str, col: str, values: Sequence, value: str) -> DataFrame:
    """Mean of ``value`` in a row x column grid; the column levels are passed
    explicitly so no extra job is spent discovering them."""
    return df.groupBy(row).pivot(col, list(values)).agg(F.avg(value))


def quantile_bin_pivot(df: DataFrame, row_col: str, col_col: str, value: str, q: int = 5) -> DataFrame:
    """Mean of ``value`` over two equal-frequency cuts (long form: row bin,
    column bin, mean, n)."""
    re = quantile_edges(df, row_col, q)
    ce = quantile_edges(df, col_col, q)
    binned = df.select(cut_expr(F.col(row_col), re).alias("rb"), cut_expr(F.col(col_col), ce).alias("cb"), value)
    return binned.groupBy(F.col("rb.idx").alias("row_bin"), F.col("cb.idx").alias("col_bin")).agg(
        F.min("rb.lo").alias("row_lo"), F.min("rb.hi").alias("row_hi"),
        F.min("cb.lo").alias("col_lo"), F.min("cb.hi").alias("col_hi"),
        F.avg(value).alias("mean"), F.count(F.lit(1)).alias("n"))


def quantile_bin_grid(df: DataFrame, row_col: str, col_col: str, value: str, q: int = 5) -> DataFrame:
    """E15 as a grid: one row per row bin, the means of column bins 1 to q beside it."""
    long = quantile_bin_pivot(df, row_col, col_col, value, q)
    return long.groupBy("row_bin").pivot("col_bin", list(range(1, q + 1))).agg(F.max("mean")).select(
        "row_bin", *[F.col(str(k)).alias(f"mean_{k}") for k in range(1, q + 1)])


def melt(table: DataFrame, keys: Sequence[str], columns: dict, name: str, value: str) -> DataFrame:
    """A wide result table to one row per key and column; ``columns`` maps each
    column to its label in ``name``."""
    cells = F.array(*[F.struct(F.lit(label).alias(name), F.col(c).alias(value)) for c, label in columns.items()])
    return table.select(*keys, F.explode(cells).alias("_cell")).select(*keys, f"_cell.{name}", f"_cell.{value}")


def error_by_bin(df: DataFrame, actual: str, pred: str, q: int = 5) -> DataFrame:
    """RMSE, MAE, mean bias and n per equal-frequency bin of the actual value."""
    edges = quantile_edges(df, actual, q)
    res = F.col(pred) - F.col(actual)
    b = df.select(cut_expr(F.col(actual), edges).alias("b"), res.alias("_r"))
    return b.groupBy(F.col("b.idx").alias("bin")).agg(
        F.min("b.lo").alias("lo"), F.min("b.hi").alias("hi"), F.count(F.lit(1)).alias("n"),
        F.sqrt(F.avg(F.col("_r") * F.col("_r"))).alias("rmse"), F.avg(F.abs("_r")).alias("mae"),
        F.avg("_r").alias("mean_bias"))


def error_by_group(df: DataFrame, keys: Sequence[str], actual: str, pred: str) -> DataFrame:
    """MAE and count per group."""
    return df.groupBy(*keys).agg(F.avg(F.abs(F.col(pred) - F.col(actual))).alias("mae"),
                                 F.count(F.lit(1)).alias("n"))


def five_number_summary(df: DataFrame, group: str, value: str) -> DataFrame:
    """Min, quartiles, max, whisker ends and outlier count (1.5 IQR fences)
    per group, with exact quantiles that never hold a group in one task."""
    q = exact_quantiles(df, value, [0.0, 0.25, 0.5, 0.75, 1.0], [group])
    wide = q.groupBy(group).agg(*[F.max(F.when(F.col("p") == p, F.col("q"))).alias(n) for p, n in
                                  [(0.0, "min"), (0.25, "q1"), (0.5, "median"), (0.75, "q3"), (1.0, "max")]])
    iqr = F.col("q3") - F.col("q1")
    wide = wide.withColumn("lo_fence", F.col("q1") - 1.5 * iqr).withColumn("hi_fence", F.col("q3") + 1.5 * iqr)
    fences = wide.select(group, "lo_fence", "hi_fence")
    v = F.col(value)
    inside = (v >= F.col("lo_fence")) & (v <= F.col("hi_fence"))
    flagged = join_small(df.select(group, value).filter(v.isNotNull()), fences, group)
    tally = flagged.groupBy(group).agg(F.count(F.lit(1)).alias("n"),
                                       F.count_if(~inside).alias("n_outliers"),
                                       F.min(F.when(inside, v)).alias("whisker_lo"),
                                       F.max(F.when(inside, v)).alias("whisker_hi"))
    return wide.join(tally, group)


def histogram(df: DataFrame, value: str, bins: int = 60) -> DataFrame:
    """Equal-width bins between min and max, last bin closed, as NumPy bins them:
    index from (x - lo) / (hi - lo) * bins, then corrected against the edges
    ``lo + k * step`` (the last edge is exactly ``hi``). Every bin has a row, empty ones
    with 0; NULL and NaN are ignored."""
    v = F.nullif(F.col(value).cast("double"), F.lit(float("nan")))
    mm = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi")).first()
    lo, hi = mm["lo"], mm["hi"]
    if lo is None:
        return df.sparkSession.createDataFrame([], "bin int, lo double, hi double, n long")
    if hi == lo:
        lo, hi = lo - 0.5, hi + 0.5
    step = (hi - lo) / bins

    def edge(k):
        return F.when(k == bins, F.lit(hi)).otherwise(k.cast("double") * F.lit(step) + F.lit(lo))
    i0 = F.least(F.floor((v - F.lit(lo)) / F.lit(hi - lo) * bins), F.lit(bins - 1))
    i1 = F.when(v < edge(i0), i0 - 1).otherwise(i0)
    i2 = F.when((v >= edge(i1 + 1)) & (i1 != bins - 1), i1 + 1).otherwise(i1)
    counted = df.filter(v.isNotNull()).groupBy(i2.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    full = every.join(counted, "bin", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return full.select("bin", edge(F.col("bin")).alias("lo"), edge(F.col("bin") + 1).alias("hi"), "n")


def adjusted_skew(x: Column) -> Column:
    """Bias-corrected sample skewness G1 = g1 * sqrt(n (n - 1)) / (n - 2)."""
    n = F.count(x)
    return F.when(n > 2, F.skewness(x) * F.sqrt(n * (n - 1)) / (n - 2))


def kde_binned(df: DataFrame, value: str, grid_size: int = 200, n_bins: int = 512, cut: float = 3.0) -> DataFrame:
    """Gaussian density on a grid (Scott bandwidth), from a histogram.

    The rows are reduced to ``n_bins`` counts first; each bin then adds its kernel
    to the ``grid_size`` evaluation points. Work after the scan is bins x grid,
    independent of the row count.
    """
    v = F.col(value).cast("double")
    st = df.agg(F.min(v).alias("lo"), F.max(v).alias("hi"), F.stddev_samp(v).alias("sd"),
                F.count(v).alias("n")).first()
    lo, hi, sd, n = st["lo"], st["hi"], st["sd"], st["n"]
    if not n or sd is None or sd == 0:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    h = sd * n ** (-1.0 / 5.0)
    g_lo, g_hi = lo - cut * h, hi + cut * h
    width = (hi - lo) / n_bins if hi > lo else 1.0
    idx = F.least(F.floor((v - F.lit(lo)) / F.lit(width)), F.lit(n_bins - 1)).cast("int")
    bins = df.filter(v.isNotNull()).groupBy(idx.alias("b")).agg(F.count(F.lit(1)).alias("c"))
    step = (g_hi - g_lo) / (grid_size - 1)
    center = F.lit(lo) + (F.col("b") + 0.5) * F.lit(width)
    pts = bins.select(center.alias("m"), "c", F.explode(F.sequence(F.lit(0), F.lit(grid_size - 1))).alias("point"))
    x = F.lit(g_lo) + F.col("point") * F.lit(step)
    z = (x - F.col("m")) / F.lit(h)
    k = F.col("c") * F.exp(-0.5 * z * z) / F.lit(math.sqrt(2 * math.pi) * h * n)
    return pts.groupBy("point").agg(F.sum(k).alias("density")).select(
        "point", (F.lit(g_lo) + F.col("point") * F.lit(step)).alias("x"), "density")
