"""Helpers shared by the operators: Arrow text buffers, word boundaries, ordered
buckets, written tables and bounded label samples."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.session import ensure_checkpoint_dir, scratch_path

#: Separators between words as the contracts state them: ASCII white space only.
SPACE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
#: Text bytes that the vectorised helpers take at once; longer texts go alone.
CHUNK_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches (texts may be long), and the shared checkpoint folder."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    ensure_checkpoint_dir(spark)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back: its
    rows are then computed once and survive the loss of executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_buffer(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column, end to end, and the n + 1 offsets of its rows
    (null: empty)."""
    arr = pc.fill_null(col, "").cast(pa.large_binary())
    n = len(arr)
    if not n:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(arr.buffers()[1], np.int64)[arr.offset:arr.offset + n + 1]
    data = arr.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[off[0]:off[-1]], off - off[0]


def chunks(off: np.ndarray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges whose texts hold at most ``limit`` bytes together (one row at least)."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def byte_table(separators: Sequence[int]) -> np.ndarray:
    """Byte map that lower-cases A-Z and turns every separator into a space."""
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    table[list(separators)] = 0x20
    return table


class Words:
    """The words of consecutive texts, mapped by a ``byte_table``, as one buffer.

    Each text reads ``" w1 w2 ... wn "`` (``" "`` without words), texts are parted by
    byte 255, which UTF-8 never holds, so ``spaces[first[i]:first[i + 1]]`` are the spaces of text i and its word
    j lies between spaces j and j + 1."""

    def __init__(self, data: np.ndarray, off: np.ndarray, table: np.ndarray):
        mapped = table[data].tobytes()
        base = int(off[0])
        raw = b" \xff ".join(mapped[int(a) - base:int(b) - base] for a, b in zip(off[:-1], off[1:]))
        flat = np.frombuffer(b" " + raw + b" ", np.uint8)
        blank = flat == 0x20
        blank[1:] &= flat[:-1] == 0x20
        blank[0] = False
        self.flat = flat[~blank]
        self.spaces = np.flatnonzero(self.flat == 0x20)
        ends = np.searchsorted(self.spaces, np.flatnonzero(self.flat == 0xFF))
        self.first = np.concatenate(([0], ends, [len(self.spaces)])).astype(np.int64)
        self.counts = np.diff(self.first) - 1


def _by_chunk(col: pa.Array, fn) -> list[list]:
    """``fn(data, off)`` over pieces of a text column; its result lists end to end."""
    data, off = text_buffer(col)
    out: list[list] = []
    for lo, hi in chunks(off):
        part = fn(data[off[lo]:off[hi]], off[lo:hi + 1] - off[lo])
        out = [list(x) for x in part] if not out else [a + list(b) for a, b in zip(out, part)]
    return out


def map_texts(df: DataFrame, text_col: str, factory, fields: Sequence[tuple[str, pa.DataType, str]],
              keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns and the ``fields`` (name, Arrow type, SQL type) that ``factory()``,
    called once a task, returns a function for: (bytes, offsets) of a few texts -> one
    list per field. Whole texts, one Arrow batch in memory, no shuffle."""
    by_name = {f.name: f.dataType.simpleString() for f in df.schema}
    n = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = factory()
        for batch in batches:
            made = _by_chunk(batch.column(n), fn) or [[] for _ in fields]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:n], *(pa.array(v, t) for v, (_, t, _) in zip(made, fields))],
                names=[*keep, *(f[0] for f in fields)])

    ddl = [f"`{c}` {by_name[c]}" for c in keep] + [f"`{name}` {sql}" for name, _, sql in fields]
    return df.select(*keep, text_col).mapInArrow(run, ", ".join(ddl))


def filter_texts(df: DataFrame, text_col: str, factory) -> DataFrame:
    """The rows of ``df``, with all columns, whose texts ``factory()``'s function maps
    to true (in its only list)."""
    at = df.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = factory()
        for batch in batches:
            made = _by_chunk(batch.column(at), fn)
            yield batch.filter(pa.array(made[0] if made else [], pa.bool_()))

    return df.mapInArrow(run, df.schema)


def ordered_bounds(df: DataFrame, value: Column, n: int) -> list[float]:
    """About ``n`` ascending cut points of a numeric column with about as many rows
    between neighbours (one pass, a bounded digest per task; ``n`` numbers reach the
    driver). Empty without values."""
    probs = [i / n for i in range(1, n)]
    if not probs:
        return []
    got = df.agg(F.percentile_approx(value, probs, max(1000, 4 * n)).alias("q")).first()["q"]
    return sorted(set(got or []))


def bucket_of(value: Column, bounds: Sequence[float]) -> Column:
    """Number of ``bounds`` at or below ``value``: a bucket that ascends with it.

    A binary search as a fold over its step widths, so a value costs log2(n)
    comparisons whatever the number of buckets. Null values get the last bucket + 1."""
    n = len(bounds)
    if not n:
        return F.when(value.isNull(), F.lit(1)).otherwise(F.lit(0))
    steps, w = [], 1
    while w <= n:
        steps.append(w)
        w *= 2
    cut = F.array(*[F.lit(b) for b in bounds])

    def step(at: Column, width: Column) -> Column:
        to = at + width
        return F.when((to <= n) & (F.get(cut, F.least(to, F.lit(n)) - 1) <= value), to).otherwise(at)

    found = F.aggregate(F.array(*[F.lit(s) for s in reversed(steps)]), F.lit(0), step)
    # never null, or a join on it would filter by the whole expression once more
    return F.when(value.isNull(), F.lit(n + 1)).otherwise(F.coalesce(found, F.lit(0)))


def uniform(*cols: Column) -> Column:
    """A number in [0, 1) that depends on the columns alone (same on every run)."""
    return F.pmod(F.xxhash64(*cols), F.lit(1 << 40)) / float(1 << 40)


def bounded_sample(rows: DataFrame, cls: str, key: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each class, chosen by a hash of ``key``; all rows of
    smaller classes. Counts come from all rows; classes reach the driver, rows don't."""
    counts = {r[cls]: r["n"] for r in rows.groupBy(cls).agg(F.count(F.lit(1)).alias("n")).collect()}
    keep = F.lit(False)
    for c, n in counts.items():
        keep = keep | ((F.col(cls) == F.lit(c)) & (uniform(F.col(key)) < min(1.0, per_class / n)))
    return rows.filter(keep)


def id_hash(key: Column) -> Column:
    """crc32 of an id as text (null: of the empty text), for folds."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")))


def pack(a: np.ndarray) -> bytes:
    return np.ascontiguousarray(a).tobytes()
