"""Exact positions and quantiles without funnelling rows through one task.

``row_number()`` over an unpartitioned order plans ``Exchange SinglePartition``:
every row of the table would pass through one task. Instead:

1. range-partition on (group keys, order keys, tie-breaker) and sort inside each
   partition, so a hot group or a hot value is split over many partitions;
2. number rows inside each partition (``monotonically_increasing_id`` minus the
   partition's base) and cut lineage by writing that table to the shared checkpoint
   folder (Parquet; or a reliable ``checkpoint``) so the numbers never change on a
   retry;
3. count rows per (partition, group) - at most partitions + groups rows - and turn
   those counts into offsets with a window over that small table;
4. join the offsets back.

Quantiles need no positions of rows: counts per value range narrow the column to the
ranges that hold a wanted position, and only their distinct values are put in order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.session import ensure_checkpoint_dir, scratch_path

MATERIALIZE = "parquet"   # or "checkpoint"


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner", rows_bound: int | None = None) -> DataFrame:
    """Join ``small`` to ``big``. With ``rows_bound``, a proven bound on its rows (24
    hours, folds x 24), it is broadcast; else Spark decides by its size at run time."""
    return big.join(F.broadcast(small) if rows_bound else small, on, how)


def ordered_positions(df: DataFrame, order_cols: Sequence[str], group_cols: Sequence[str] = (),
                      rank_col: str = "rank", size_col: str | None = None,
                      num_partitions: int | None = None, tie_breaker: bool = False) -> DataFrame:
    """Add ``rank_col``: the exact 0-based position of each row in ``order_cols``
    order within its ``group_cols`` group (the global position when there are none).

    ``order_cols`` should form a total order (end with a row key); otherwise pass
    ``tie_breaker=True`` to order runs of equal keys by a hash of the whole row, which
    depends on the row alone (rows equal in every column are interchangeable).
    ``size_col`` optionally receives the group's row count.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    keys = [*group_cols, *order_cols]
    if tie_breaker:
        df = df.withColumn("__op_tie", F.xxhash64(*df.columns))
        keys = keys + ["__op_tie"]
    pid = F.spark_partition_id().cast("long")
    staged = (df.repartitionByRange(n_parts, *keys)
              .sortWithinPartitions(*keys)
              .withColumn("__op_pid", pid)
              .withColumn("__op_pos", F.monotonically_increasing_id() - F.shiftleft(pid, 33)))
    # Cut lineage once, in shared storage, so the numbering can never change on a
    # retry: a Parquet table in the checkpoint folder (columnar; consumers that read a
    # few columns prune the rest) or a reliable RDD checkpoint.
    if MATERIALIZE == "parquet":
        path = scratch_path(spark, "positions")
        staged.write.mode("errorifexists").parquet(path)
        staged = spark.read.parquet(path)
    else:
        staged = staged.checkpoint(eager=True)

    seg = staged.groupBy("__op_pid", *group_cols).agg(F.min("__op_pos").alias("__op_first"),
                                                  F.count(F.lit(1)).alias("__op_cnt"))
    by_group = Window.partitionBy(*[F.col(c) for c in group_cols]) if group_cols else Window.partitionBy()
    seg = seg.withColumn(
        "__op_off",
        F.coalesce(F.sum("__op_cnt").over(by_group.orderBy("__op_pid").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)))
    if size_col:
        seg = seg.withColumn(size_col, F.sum("__op_cnt").over(by_group))
    seg = seg.drop("__op_cnt")

    if group_cols:
        # Null-safe equality so NULL group keys keep their rows.
        seg_r = seg.select(*[F.col(c).alias(f"__op_g_{c}") for c in group_cols], "__op_pid", "__op_first", "__op_off",
                           *([size_col] if size_col else []))
        seg_r = seg_r.withColumnRenamed("__op_pid", "__op_spid")
        cond = staged["__op_pid"] == seg_r["__op_spid"]
        for c in group_cols:
            cond = cond & staged[c].eqNullSafe(seg_r[f"__op_g_{c}"])
        joined = staged.join(seg_r, cond, "inner").drop("__op_spid", *[f"__op_g_{c}" for c in group_cols])
    else:
        # one row per partition; Spark chooses the join by its size
        joined = staged.join(seg, "__op_pid", "inner")
    out = joined.withColumn(rank_col, F.col("__op_off") + F.col("__op_pos") - F.col("__op_first"))
    drop = ["__op_pid", "__op_pos", "__op_first", "__op_off"] + (["__op_tie"] if tie_breaker else [])
    return out.drop(*drop)


#: Cut points that narrow a column before its exact quantiles are looked up.
NARROW = 256


def _bucket(x: Column, cuts: Sequence[float]) -> Column:
    """Number of ``cuts`` at or below ``x``, by a binary search as a fold."""
    n = len(cuts)
    if not n:
        return F.lit(0)
    widths = [1 << e for e in range(n.bit_length() - 1, -1, -1)]
    edges = F.array(*[F.lit(float(c)) for c in cuts])

    def narrow(at: Column, w: Column) -> Column:
        return F.when((at + w <= n) & (F.get(edges, F.least(at + w, F.lit(n)) - 1) <= x), at + w).otherwise(at)
    return F.coalesce(F.aggregate(F.array(*[F.lit(w) for w in widths]), F.lit(0), narrow), F.lit(0))


def exact_quantiles(df: DataFrame, value_col: str, probs: Sequence[float],
                    group_cols: Sequence[str] = (), num_partitions: int | None = None) -> DataFrame:
    """Quantiles with linear interpolation at ``p * (n - 1)`` (pandas/NumPy "linear",
    DuckDB ``quantile_cont``), per group; NULL and NaN values are ignored.

    Equal values are counted before anything is shuffled. Counts per (group, value
    range) over at most ``NARROW`` ranges say which ranges hold a wanted position; only
    the distinct values of those ranges are put in order. Nothing is sorted whole or
    written. Returns one row per (group, probability): ``group_cols..., p, q``.
    """
    v = F.col(value_col).cast("double")
    groups = [f"__g{k}" for k in range(len(group_cols))]
    base = df.select(*[F.col(c).alias(g) for c, g in zip(group_cols, groups)], v.alias("_v")).filter(
        F.col("_v").isNotNull() & ~F.isnan("_v"))
    cuts = base.agg(F.percentile_approx("_v", [i / NARROW for i in range(1, NARROW)], 20 * NARROW).alias("c")).first()["c"]
    counts = base.groupBy(*groups, "_v").agg(F.count(F.lit(1)).alias("_c")).withColumn("_b", _bucket(F.col("_v"), sorted(set(cuts or []))))
    whole = Window.partitionBy(*groups)
    cells = counts.groupBy(*groups, "_b").agg(F.sum("_c").alias("_n"))
    cells = (cells.withColumn("_total", F.sum("_n").over(whole))
             .withColumn("_start", F.sum("_n").over(whole.orderBy("_b")) - F.col("_n")))
    wanted = cells.select(*groups, "_b", "_start", "_n", F.explode(F.array(*[
        F.struct(F.lit(i).alias("i"), F.lit(float(p)).alias("p"), (F.lit(float(p)) * (F.col("_total") - 1)).alias("h"))
        for i, p in enumerate(probs)])).alias("_q")).select(*groups, "_b", "_start", "_n", "_q.*")

    def holds(place: Column, lo: Column, n: Column) -> Column:
        return (place >= lo) & (place < lo + n)
    wanted = wanted.filter(holds(F.floor("h"), F.col("_start"), F.col("_n")) | holds(F.ceil("h"), F.col("_start"), F.col("_n"))).drop("_n")

    def matched(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        other = right.select(*[F.col(c).alias(f"{c}_r") for c in (*groups, "_b")], *[c for c in right.columns if c not in (*groups, "_b")])
        cond = F.col("_b") == F.col("_b_r")
        for g in groups:
            cond = cond & F.col(g).eqNullSafe(F.col(f"{g}_r"))
        joined = left.join(other, cond, how)
        return joined if how == "left_semi" else joined.drop(*[f"{c}_r" for c in (*groups, "_b")])
    inside = matched(counts, wanted, "left_semi")
    inside = inside.withColumn("_end", F.sum("_c").over(Window.partitionBy(*groups, "_b").orderBy("_v")))
    hits = matched(inside, wanted, "inner").withColumn("_first", F.col("_start") + F.col("_end") - F.col("_c"))
    agg = hits.groupBy(*groups, "i", "p", "h").agg(
        F.max(F.when(holds(F.floor("h"), F.col("_first"), F.col("_c")), F.col("_v"))).alias("_lo"),
        F.max(F.when(holds(F.ceil("h"), F.col("_first"), F.col("_c")), F.col("_v"))).alias("_hi"))
    q = F.col("_lo") + (F.col("_hi") - F.col("_lo")) * (F.col("h") - F.floor("h"))
    return agg.select(*[F.col(g).alias(c) for c, g in zip(group_cols, groups)], "p", q.alias("q"))


def quantile_edges(df: DataFrame, value_col: str, n_bins: int) -> list[float]:
    """Edges of an equal-frequency cut into ``n_bins``; duplicate edges dropped.

    Only ``n_bins + 1`` numbers reach the driver.
    """
    probs = [i / n_bins for i in range(n_bins + 1)]
    rows = exact_quantiles(df, value_col, probs).orderBy("p").collect()
    edges: list[float] = []
    for r in rows:
        if not edges or r["q"] != edges[-1]:
            edges.append(float(r["q"]))
    return sorted(set(edges))


def cut_expr(x: Column, edges: Sequence[float]) -> Column:
    """Right-closed bins over ``edges``, lowest edge included (pandas ``cut``
    with ``include_lowest``). Returns ``struct(idx, lo, hi)``; NULL outside."""
    if len(edges) < 2:
        return F.lit(None).cast("struct<idx:int,lo:double,hi:double>")
    expr = None
    for j in range(1, len(edges)):
        lo, hi = float(edges[j - 1]), float(edges[j])
        cond = (x >= F.lit(lo)) & (x <= F.lit(hi)) if j == 1 else (x > F.lit(lo)) & (x <= F.lit(hi))
        val = F.struct(F.lit(j).alias("idx"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi"))
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    return expr


def quantile_cut(df: DataFrame, value_col: str, n_bins: int = 5, out_col: str = "bin") -> DataFrame:
    """Equal-frequency cut (``pd.qcut(..., duplicates="drop")``) as a struct column."""
    edges = quantile_edges(df, value_col, n_bins)
    return df.withColumn(out_col, cut_expr(F.col(value_col), edges))
