"""SimHash near-duplicates by anchor-point covering.

Fingerprints: bit b is set if it is set in over half of the 64-bit hashes of a text's
word shingles, repeats included.

Links: two fingerprints link at ``max_bits`` differing bits or fewer. The 64 bits are
cut into halves; a linked pair differs by at most t = max_bits // 2 bits in one half at
least. The anchors of a half are a covering code of 32 bits: the [31, 26] Hamming code
(perfect, covering radius 1) times one free bit, 2^27 anchors. A fingerprint goes once
to the anchor that covers its half (at distance 0 or 1: exactly one) and is replicated
to every anchor within covering radius plus threshold, 1 + t bits (17 of them at most
for t = 1). If x and y differ by at most t bits in the half, the anchor that covers x is
within 1 + t of y, so every linked pair meets at an anchor, where whole fingerprints
are compared.

Only distinct fingerprints, as classes of equal ones, enter the join, so copies are
never expanded into pairs: a class counts once, whatever its size. The join is between
one row (covering side) and at most 17 rows (replica side) per class and half, hashed
by anchor over 2^27 anchors; Spark splits a hot anchor as a skewed join. No side of a join
here is broadcast: all grow with the documents, and Spark sizes them by the 16 bytes of a
class or a link, before they are replicated. Components of
the links are found by alternating large-star and small-star steps on the table of
links, written to the shared checkpoint folder after each round.

Long texts are hashed in stretches whose bit counts add up: a task's memory does not
grow with a text but for the text itself and its longest word.
Null and empty texts have no shingles: fingerprint zero, linked like any other. Rows
with equal ids share a node; columns other than the id and the text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import CHUNK_BYTES, SPACE, Words, byte_table, map_texts, prepare, written

SHINGLE = 3
MAX_BITS = 3
SEED = 42


def _bit_counts(w: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(how many shingle hashes set each of the 64 bits, number of shingles) per text."""
    raw = w.flat.tobytes()
    n = np.maximum(w.counts - size + 1, (w.counts > 0).astype(np.int64))
    row = np.repeat(np.arange(len(n)), n)
    first = np.cumsum(n) - n
    at = w.first[:-1][row] + np.arange(len(row)) - first[row]
    begin = w.spaces[at] + 1
    end = w.spaces[np.minimum(at + size, w.first[1:][row] - 1)]
    digest = xxhash.xxh64_intdigest
    h = np.array([digest(raw[a:b], SEED) for a, b in zip(begin.tolist(), end.tolist())], np.uint64)
    step = 1 << 17  # shingles whose bits are spread out at once
    ones = np.zeros((len(n), 64), np.int64)
    for i in np.flatnonzero(n).tolist():
        for lo in range(int(first[i]), int(first[i] + n[i]), step):
            part = h[lo:min(lo + step, int(first[i] + n[i]))]
            bits = np.unpackbits(part.view(np.uint8), bitorder="little").reshape(-1, 64)
            ones[i] += bits.sum(axis=0, dtype=np.int32)
    return ones, n


def _long_counts(data: np.ndarray, size: int, stretch: int) -> tuple[np.ndarray, np.ndarray]:
    """``_bit_counts`` of one text, added up over stretches of about ``stretch`` bytes
    that end at a separator; each is led by the last ``size - 1`` words before it."""
    table = byte_table(SPACE)
    ones, n, lo, carry = np.zeros((1, 64), np.int64), 0, 0, b""
    w = Words(data[:0], np.zeros(2, np.int64), table)
    while lo < len(data):
        hi = min(lo + stretch, len(data))
        while hi < len(data) and data[hi] not in SPACE:  # a word is never cut
            ahead = np.flatnonzero(table[data[hi:hi + stretch]] == 0x20)
            hi = min(hi + (int(ahead[0]) if len(ahead) else stretch), len(data))
        part = np.concatenate((np.frombuffer(carry + b" ", np.uint8), data[lo:hi]))
        w = Words(part, np.array([0, len(part)]), table)
        count, lo = int(w.counts[0]), hi
        if count >= size:
            more, k = _bit_counts(w, size)
            ones, n = ones + more, n + int(k[0])
        last = min(size - 1, count)
        carry = w.flat[w.spaces[-1 - last]:w.spaces[-1]].tobytes()
    return (ones, np.array([n])) if n else _bit_counts(w, size)


def simhash(data: np.ndarray, off: np.ndarray, size: int = SHINGLE, stretch: int = CHUNK_BYTES) -> np.ndarray:
    """Unsigned 64-bit fingerprints of a few texts; a text above ``stretch`` bytes that
    comes alone is taken stretch by stretch, so its memory is that of a stretch."""
    if len(off) == 2 and len(data) > stretch:
        ones, n = _long_counts(data, size, stretch)
    else:
        ones, n = _bit_counts(Words(data, off, byte_table(SPACE)), size)
    return np.packbits(2 * ones > n[:, None], axis=1, bitorder="little").view("<u8").ravel().astype(np.uint64)


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE) -> DataFrame:
    """id, and fp: the fingerprint as a signed 64-bit integer."""
    prepare(docs.sparkSession)
    return map_texts(docs, text_col, lambda: lambda data, off: [simhash(data, off, size).view(np.int64)],
                     [("fp", pa.int64(), "bigint")], [id_col])


def hex16(fp: Column) -> Column:
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


def _syndrome_bits() -> list[int]:
    """Masks of the parity checks of the [31, 26] Hamming code: check j covers the
    positions 1..31 (bit position - 1) whose number has bit j."""
    return [sum(1 << (p - 1) for p in range(1, 32) if p >> j & 1) for j in range(5)]


def _covering(half: Column) -> Column:
    """The anchor that covers a 32-bit half: its low 31 bits with the bit in error
    (named by the syndrome) corrected, its top bit as it is."""
    syndrome = F.lit(0).cast("bigint")
    for j, mask in enumerate(_syndrome_bits()):
        parity = F.bit_count(half.bitwiseAND(F.lit(mask))) % 2
        syndrome = syndrome + parity.cast("bigint") * (1 << j)
    flip = F.when(syndrome == 0, F.lit(0).cast("bigint")).otherwise(
        F.call_function("shiftleft", F.lit(1).cast("bigint"), (syndrome - 1).cast("int")))
    return half.bitwiseXOR(flip)


def _flips(t: int) -> list[int]:
    """All changes of at most t of 32 bits."""
    masks = {0}
    for _ in range(t):
        masks |= {m ^ (1 << b) for m in masks for b in range(32)}
    return sorted(masks)


def _halves(fp: Column) -> Column:
    low = fp.bitwiseAND(F.lit(0xFFFFFFFF))
    high = F.shiftrightunsigned(fp, 32)
    return F.array(F.struct(F.lit(0).alias("part"), low.alias("half")),
                   F.struct(F.lit(1).alias("part"), high.alias("half")))


def links(classes: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Distinct pairs (a, b), a < b, of the ``rep`` values of distinct ``fp`` values
    that differ by at most ``max_bits`` bits (at most 5: two in a half)."""
    if not 0 <= max_bits <= 5:
        raise ValueError("max_bits must be 0 to 5")
    # a class is 16 bytes but makes up to 34 rows: a scan would pack many classes into one
    # task, so they are dealt by number first, which AQE doesn't coalesce
    tasks = int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    classes = classes.select("rep", "fp").repartition(tasks, "fp")
    parts = classes.select("rep", "fp", F.explode(_halves(F.col("fp"))).alias("h")).select("rep", "fp", "h.part", "h.half")
    covered = parts.select(F.col("rep").alias("a"), F.col("fp").alias("fa"), "part", _covering(F.col("half")).alias("anchor"))
    # every anchor within 1 + t of a half covers some half that differs from it by at
    # most t bits: those anchors are the covering anchors of all such halves
    near = F.array_distinct(F.transform(F.array(*[F.lit(m) for m in _flips(max_bits // 2)]),
                                        lambda m: _covering(F.col("half").bitwiseXOR(m))))
    spread = parts.select(F.col("rep").alias("b"), F.col("fp").alias("fb"), "part", F.explode(near).alias("anchor"))
    close = F.bit_count(F.col("fa").bitwiseXOR(F.col("fb"))) <= max_bits
    met = covered.join(spread.hint("merge"), ["part", "anchor"]).filter((F.col("fa") != F.col("fb")) & close)
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(pairs: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable over pairs (a, b), for every node
    of a pair that is not itself the smallest. Rounds of large-star and small-star until
    the set of links stays as it is (its count and hash sum are all the driver sees)."""
    edges = written(pairs.filter("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        state = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
        if state == before or not state["n"]:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state
        both = edges.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e")).select("e.*")
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low.hint("merge"), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low.hint("merge"), "u").select(F.explode(F.array(
            F.struct("u", F.col("m").alias("v")),
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")).select("e.*")
        edges = written(small.filter("u != v").distinct(), "edges")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
                    max_bits: int = MAX_BITS) -> DataFrame:
    """id, fp and component_id (smallest id reachable) of every row. Rows are grouped
    by fingerprint first; ids of null are left out of links and are their own null
    component."""
    marked = written(fingerprints(docs, id_col, text_col, size), "simhash")
    classes = written(marked.groupBy("fp").agg(F.min(id_col).alias("rep")).filter("rep is not null"), "classes")
    # equal ids with different fingerprints are one node: they link their classes
    same_id = marked.filter(F.col(id_col).isNotNull()).groupBy(id_col).agg(
        F.min("fp").alias("lo"), F.max("fp").alias("hi"), F.count(F.lit(1)).alias("n")).filter("n > 1 and lo != hi")
    twins = marked.join(same_id.select(id_col).hint("merge"), id_col).select("fp", F.col(id_col).alias("a")).join(classes.hint("merge"), "fp").select(
        F.least("a", "rep").alias("a"), F.greatest("a", "rep").alias("b")).filter("a != b")
    found = components(links(classes, max_bits).unionByName(twins))
    labelled = classes.join(found.hint("merge"), F.col("rep") == F.col("node"), "left").select(
        F.col("fp").alias("__fp"), F.coalesce("component", "rep").alias("__component"))
    out = marked.join(labelled.hint("merge"), F.col("fp") == F.col("__fp"), "left")
    return out.select(F.col(id_col), "fp", F.when(F.col(id_col).isNotNull(), F.col("__component")).alias("component_id"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each component: the one whose id names it. Of rows that repeat
    that id one stays; rows without id all stay."""
    marked = written(near_duplicates(docs, id_col, text_col, **options).select(id_col, "component_id"), "components")
    gone = marked.filter(F.col(id_col) != F.col("component_id")).select(F.col(id_col).alias("__gone")).distinct()
    # the list of ids grows with the documents: never broadcast, the same plan at any size
    kept = docs.join(gone.hint("merge"), docs[id_col] == F.col("__gone"), "left_anti")
    again = marked.filter(F.col(id_col) == F.col("component_id")).groupBy(F.col(id_col).alias("__again")).count().filter(
        "count > 1").select("__again")
    if again.isEmpty():
        return kept
    same = kept[id_col] == F.col("__again")
    return kept.join(again.hint("merge"), same, "left_anti").unionByName(kept.join(again.hint("merge"), same, "left_semi").dropDuplicates([id_col]))
