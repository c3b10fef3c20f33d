"""Mixing sources to target weights by systematic sampling.

Sizes are word counts. Sources in code point order (null last) weigh ``weights``,
repeating; together they share ``share`` of all words. A source's target stops at
``cap`` times its size and the excess is shared among the others by weight until none
is above, which is the level L with sum(min(cap * size, L * weight)) = share * total.

Within a source each document has the same expected number of copies, target / size.
Documents stand in order of (size, id); the prefix sum of expected copies plus one
random offset in [0, 1) per source crosses whole numbers, and a document is emitted once
for each that it crosses. In that order the copies are spread over all sizes, so a
source's taken words come near its target.

The prefix sum of document i is expected * i, so its position i is all it takes. The
rows are dealt to buckets that ascend with (size, id), cut at quantiles over all rows,
so a source with a third of all rows, or a third of all rows of one size, is spread
over the buckets; counts per (source, bucket) give each bucket's offset. Only the table
of sources, one row each, is ordered as a whole.

Null and empty texts have size 0 and null is a source of its own. Null ids come last
among rows of one size. Repeated rows count each. Sources without words have target 0
and no copies. An empty table gives an empty result. Added columns are named as
``mix`` says and replace clashing input columns.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import bucket_of, ordered_bounds, prepare, written

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2.0


def words_in(text: Column) -> Column:
    """Number of runs of characters other than ASCII white space (null: 0)."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def offset_of(source: Column, seed: int) -> Column:
    """The source's random offset: 20 bits of an md5 of seed and source."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.concat(F.lit("s:"), source), F.lit("null")))
    return F.conv(F.substring(F.md5(name), 1, 5), 16, 10).cast("double") / float(1 << 20)


def targets(sources: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP) -> DataFrame:
    """Adds ``target`` to one row per source (columns source, source_size)."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    nth = (F.row_number().over(order) - 1) % len(weights) + 1
    t = sources.withColumn("__nth", nth).withColumn("__w", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), F.col("__nth")))
    t = t.withColumn("__cap", F.col("source_size") * cap)
    whole = Window.partitionBy()
    before = Window.orderBy(F.col("__cap") / F.col("__w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    t = (t.withColumn("__all", F.sum("source_size").over(whole) * share).withColumn("__ws", F.sum("__w").over(whole))
         .withColumn("__cb", F.coalesce(F.sum("__cap").over(before), F.lit(0.0)))
         .withColumn("__wb", F.coalesce(F.sum("__w").over(before), F.lit(0.0))))
    t = t.withColumn("__capped", (F.col("__all") - F.col("__cb")) / (F.col("__ws") - F.col("__wb")) * F.col("__w") >= F.col("__cap"))
    level = F.try_divide(F.col("__all") - F.sum(F.when(F.col("__capped"), F.col("__cap")).otherwise(0.0)).over(whole),
                         F.col("__ws") - F.sum(F.when(F.col("__capped"), F.col("__w")).otherwise(0.0)).over(whole))
    t = t.withColumn("__level", level)
    return t.select("source", "source_size", F.when(F.col("__capped"), F.col("__cap")).otherwise(
        F.least(F.col("__cap"), F.col("__level") * F.col("__w"))).alias("target"))


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        carry: Sequence[str] = (), weights: Sequence[float] = WEIGHTS, share: float = SHARE, cap: float = CAP,
        seed: int = 42) -> DataFrame:
    """id, size, source_size, target, copies, taken (and the ``carry`` columns) of every
    row. Reruns agree: the offset depends on seed and source alone."""
    spark = docs.sparkSession
    prepare(spark)
    light = written(docs.select(F.col(id_col).alias("__id"), F.col(source_col).alias("source"),
                                words_in(F.col(text_col)).alias("size")), "sizes")
    span = light.agg(F.min("__id").alias("lo"), F.max("__id").alias("hi")).first()
    lo, width = (float(span["lo"]), float(span["hi"]) - float(span["lo"]) + 1.0) if span["lo"] is not None else (0.0, 1.0)
    key = F.col("size") + F.coalesce((F.col("__id") - F.lit(lo)) / F.lit(width), F.lit(1.0))
    bounds = ordered_bounds(light, key, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.withColumns({"__bucket": bucket_of(key, bounds), "__null": F.col("source").isNull(),
                                 "__source": F.coalesce("source", F.lit(""))})

    cell = ["__null", "__source", "__bucket"]
    cells = written(dealt(light).groupBy(*cell).agg(F.count(F.lit(1)).alias("__n"), F.sum("size").alias("__words")), "cells")
    sources = cells.groupBy("__null", "__source").agg(F.sum("__words").alias("source_size")).select(
        F.when(~F.col("__null"), F.col("__source")).alias("source"), "source_size")
    goal = targets(sources, weights, share, cap).select(
        F.col("source").isNull().alias("__null"), F.coalesce("source", F.lit("")).alias("__source"), "source_size", "target",
        offset_of(F.col("source"), seed).alias("__u"))
    earlier = Window.partitionBy("__null", "__source").orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.withColumn("__before", F.coalesce(F.sum("__n").over(earlier), F.lit(0))).join(goal, ["__null", "__source"])

    rows = light
    if carry:
        rows = docs.select(F.col(id_col).alias("__id"), F.col(source_col).alias("source"),
                           words_in(F.col(text_col)).alias("size"), F.struct(*[docs[c] for c in carry]).alias("__row"))
    within = Window.partitionBy(*cell).orderBy("size", F.col("__id").asc_nulls_last())
    rows = dealt(rows).withColumn("__k", F.row_number().over(within))
    rows = rows.join(cells.select(*cell, "__before", "source_size", "target", "__u"), cell)
    expected = F.coalesce(F.try_divide(F.col("target"), F.col("source_size")), F.lit(0.0))
    at = F.col("__before") + F.col("__k")
    crossed = F.floor(expected * at + F.col("__u")) - F.floor(expected * (at - 1) + F.col("__u"))
    copies = F.least(crossed, F.ceil(F.lit(cap))).cast("bigint")
    out = rows.select("*", copies.alias("copies"))
    return out.select(F.col("__id").alias(id_col), "size", F.col("source_size").cast("bigint").alias("source_size"), "target",
                      "copies", (F.col("copies") * F.col("size")).alias("taken"), *(["__row"] if carry else []))


def emit(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` once per copy, all columns, and the number
    ``copy`` (from 1; it replaces an input column of that name)."""
    names = [c for c in docs.columns if c != "copy"]
    taken = mix(docs, carry=names, **options).filter("copies > 0")
    return taken.select("__row.*", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy"))
