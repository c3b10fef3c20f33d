"""Document fingerprints by Order MinHash, in DataFrame functions only.

A text's tokens are runs of non-white characters (ASCII white space), cut into pieces of
at most ``PIECE`` characters, so texts without blanks have tokens too. Its k-mers are
``k`` consecutive tokens (fewer tokens: one k-mer of all). The j-th repeat of a k-mer is
a k-mer of its own, numbered j. Slot s of the signature takes the ``length`` smallest
occurrence-numbered k-mers under hash function s, keeps them in the order in which they
stand in the text, and hashes that tuple; so two texts agree in a slot only if they
share those k-mers and their order. The hash functions are the rotations of one 64-bit
hash u: h_s(x) = u(x) - s * 2^64 / slots mod 2^64, whose smallest values are the first
ones at or after a slot's edge in the sorted u, going round. Likeness is the share of
slots that agree.

Hashes have 40 bits in texts of every size, so all fingerprints compare. For both sorts
of a text, of its k-mers to number repeats and of u, hash and token position are packed
in one long (the position in the low 24 bits); the work is linear but for them. Texts of
more than 2^24 tokens sort structs of hash and position instead, to the same result.

``chained`` gives each row the text that follows in ascending id order, the last the
first. Rows are dealt to buckets that ascend with the id, cut at quantiles over all
rows, each with an extra row holding the next bucket's first text: one shuffle of whole
texts, no global order, and the buckets' edges are all that reaches the driver (four per
shuffle partition).

Null texts are empty; texts without tokens have the all-zero fingerprint. Null ids come
last, rows of one id in the order of their texts, each a row of its own. A single row
follows itself. An empty table gives an empty result. Other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadence.llm.common import bucket_of, ordered_bounds, prepare

PIECE = 16
K = 2
LENGTH = 2
SLOTS = 32


def _long(x: int) -> Column:
    return F.lit(x).cast("bigint")


def signature(df: DataFrame, text_col: str, out_col: str, k: int = K, length: int = LENGTH, slots: int = SLOTS,
              packed: int = 1 << 24) -> DataFrame:
    """Adds ``out_col``: ``slots`` 32-bit numbers. Every step is a column of its own that
    the next refers to more than once, so none is computed twice. ``packed``: most tokens
    (2^24 at most) whose positions are packed with their hashes; results don't change."""
    rest = df.columns
    high, low = _long(-(1 << 24)), _long((1 << 24) - 1)

    def tmp(name: str) -> Column:
        return F.col(f"__omh_{name}")

    def step(frame: DataFrame, keep: list[str], **made: Column) -> DataFrame:
        return frame.select(*rest, *[tmp(c) for c in keep], *[v.alias(f"__omh_{n}") for n, v in made.items()])

    def ordered(frame: DataFrame, h: str, p: str, pairs) -> DataFrame:
        """Sorted hashes ``h`` and their positions ``p``; ``pairs(make)`` is the array of
        make(hash, position)."""
        few = tmp("few")
        frame = step(frame, ["n", "few"], s=F.when(few, F.sort_array(pairs(lambda x, i: x.bitwiseOR(i)))),
                     w=F.when(~few, F.sort_array(pairs(lambda x, i: F.struct(x.alias("h"), i.alias("p"))))))
        return step(frame, ["n", "few"], **{
            h: F.when(few, F.transform(tmp("s"), lambda x: x.bitwiseAND(high))).otherwise(tmp("w")["h"]),
            p: F.when(few, F.transform(tmp("s"), lambda x: x.bitwiseAND(low))).otherwise(tmp("w")["p"])})

    d = step(df, [], t=F.regexp_extract_all(F.coalesce(F.col(text_col), F.lit("")), F.lit(rf"\S{{1,{PIECE}}}"), F.lit(0)))
    d = step(d, ["t"], n=F.when(F.size(tmp("t")) == 0, 0).otherwise(F.greatest(F.size(tmp("t")) - (k - 1), F.lit(1))),
             few=F.size(tmp("t")) <= packed)

    def upto(n: Column) -> Column:  # 0 .. n - 1
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    # k-mers with their positions, equal ones side by side
    d = ordered(d, "m", "p", lambda make: F.transform(upto(tmp("n")), lambda i: make(
        F.xxhash64(*[F.get(tmp("t"), i + j) for j in range(k)]).bitwiseAND(high), i.cast("bigint"))))

    def mer(i: Column) -> Column:
        return F.coalesce(F.get(tmp("m"), i), _long(0))

    d = step(d, ["n", "few", "m", "p"], again=F.filter(upto(tmp("n")), lambda i: (i > 0) & (mer(i) == mer(i - 1))))
    d = step(d, ["n", "few", "m", "p", "again"], first=F.array_except(upto(tmp("n")), tmp("again")))

    def numbered(make, i: Column, nth: Column) -> Column:
        return make(F.xxhash64(mer(i), nth).bitwiseAND(high), F.coalesce(F.get(tmp("p"), i), _long(0)))

    # the j-th repeat stands at i: i - j of the places up to i are first ones, the last
    # of them that of its own k-mer
    d = ordered(d, "u", "q", lambda make: F.concat(
        F.transform(tmp("first"), lambda i: numbered(make, i, F.lit(0))),
        F.transform(tmp("again"), lambda i, j: numbered(make, i, i - F.coalesce(F.get(tmp("first"), i - j - 1), F.lit(0))))))
    d = step(d, ["n", "u", "q"], widths=F.transform(F.sequence(F.ceil(F.log2(tmp("n") + 1)).cast("int"), F.lit(0), F.lit(-1)),
                                                    lambda e: F.pow(F.lit(2.0), e).cast("int")))

    def edge(j: Column) -> Column:
        return F.call_function("shiftleft", (j - slots // 2).cast("bigint"), F.lit(64 - (slots.bit_length() - 1)))

    def below(j: Column) -> Column:  # how many hashes are below slot j's edge
        def narrow(at: Column, w: Column) -> Column:
            return F.when((at + w <= tmp("n")) & (F.get(tmp("u"), at + w - 1) < edge(j)), at + w).otherwise(at)
        return F.aggregate(tmp("widths"), F.lit(0), narrow)

    def slot(j: Column) -> Column:
        def place(at: Column) -> Column:
            def taken(x: Column) -> Column:  # position in front, so that sorting restores the order of the text
                i = F.pmod(at + x, tmp("n"))
                return F.struct(F.get(tmp("q"), i).alias("q"), F.coalesce(F.get(tmp("u"), i), _long(0)).alias("u"))

            found = F.sort_array(F.transform(F.sequence(F.lit(0), F.least(F.lit(length), tmp("n")) - 1), taken))
            return F.xxhash64(F.transform(found, lambda x: F.call_function("shiftrightunsigned", x["u"], F.lit(24))))
        return F.get(F.transform(F.array(below(j)), place), F.lit(0))

    sig = F.transform(F.sequence(F.lit(0), F.lit(slots - 1)), lambda j: slot(j).bitwiseAND(_long((1 << 32) - 1)))
    none = F.array(*[_long(0)] * slots)
    return d.select(*rest, F.when(tmp("n") == 0, none).otherwise(sig).alias(out_col))


def text_of(sig: Column) -> Column:
    """A signature as hexadecimal text, eight digits a slot."""
    return F.array_join(F.transform(sig, lambda x: F.lower(F.lpad(F.hex(x), 8, "0"))), "")


def likeness(a: Column, b: Column, slots: int = SLOTS) -> Column:
    """Share of slots that agree."""
    same = F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("int")), F.lit(0), lambda t, x: t + x)
    return same / F.lit(float(slots))


def chained(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, text, next, __bucket, __extra, __at): ``next`` is the following row's
    text. Rows with ``__extra`` only carry the first text of the bucket that follows;
    ``__at`` is the place in the bucket."""
    spark = docs.sparkSession
    prepare(spark)
    docs = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    bounds = ordered_bounds(docs, F.col("id"), 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    docs = docs.withColumn("__bucket", bucket_of(F.col("id"), bounds))
    first = sorted((r["__bucket"], r["id"]) for r in docs.groupBy("__bucket").agg(F.min("id").alias("id")).collect())
    heads = [(first[i - 1][0], *first[i]) for i in range(len(first))]
    kind = docs.schema["id"].dataType.simpleString()
    starts = spark.createDataFrame(heads, f"__for int, __in int, __id {kind}")
    extra = docs.join(F.broadcast(starts),  # one row a bucket, four buckets a shuffle partition
                      (F.col("__bucket") == F.col("__in")) & F.col("id").eqNullSafe(F.col("__id")))
    extra = extra.groupBy("__for").agg(F.min("text").alias("text")).select(
        F.lit(None).cast(kind).alias("id"), "text", F.col("__for").alias("__bucket"), F.lit(1).alias("__extra"))
    rows = docs.withColumn("__extra", F.lit(0)).unionByName(extra)
    order = Window.partitionBy("__bucket").orderBy("__extra", F.col("id").asc_nulls_last(), "text")
    return rows.select("*", F.lead("text").over(order).alias("next"), F.row_number().over(order).alias("__at"))


def edited_text(text: Column, following: Column) -> Column:
    """``text`` with its last quarter (rounded down, in characters) replaced by as many
    first characters of ``following``, or all it has."""
    n = F.char_length(text)
    q = F.floor(n / 4).cast("int")
    return F.concat(F.substring(text, F.lit(1), n - q), F.substring(F.coalesce(following, F.lit("")), F.lit(1), q))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and
    near_next of every row."""
    rows = chained(docs, id_col, text_col)
    rows = rows.withColumn("edited", F.when(F.col("__extra") == 0, edited_text(F.col("text"), F.col("next"))))
    rows = rows.select("id", "text", "edited", "__bucket", "__extra", "__at", F.char_length("text").cast("bigint").alias("n_chars"),
                       F.sha2("edited", 256).alias("edited_sha256"))
    rows = signature(rows, "text", "sig").drop("text")
    rows = signature(rows, "edited", "edited_sig").drop("edited")
    order = Window.partitionBy("__bucket").orderBy("__at")
    rows = rows.withColumn("next_sig", F.lead("sig").over(order)).filter("__extra = 0")
    return rows.select(F.col("id").alias(id_col), "n_chars", "edited_sha256", text_of(F.col("sig")).alias("fingerprint"),
                       text_of(F.col("edited_sig")).alias("edited_fingerprint"),
                       likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"),
                       likeness(F.col("sig"), F.col("next_sig")).alias("near_next"))
