"""Near-duplicate vectors by cosine: subspace pigeonhole join.

For unit vectors a cosine of at least t is a squared distance of at most D = 2 - 2 t. An
orthogonal rotation keeps it and spreads it over all coordinates. The rotated coordinates
are split into blocks of ``BLOCK``; block b gets the share D * size(b) / dimensions of the
budget, and if two vectors lie within D, at least one block lies within its share.

1. Equal vectors of a label become one class, so copies are never compared.
2. A label's classes of one length are dealt to tiles by a hash, of at most about ``TILE``
   classes and ``TILE_BYTES``, and each tile is written as one row. Tiles of a label meet in
   pairs, each pair once, in a cartesian product that reads the table of tiles: a vector is
   shuffled and written a fixed number of times, whatever its label's size.
3. In a pair of tiles each block is a range join on a grid over its coordinates: a class of
   the one stands in its home cell, a class of the other in every cell that its ball (the
   root of the block's budget) reaches. Slabs are halves or uniform slabs about the pair's
   mean, never narrower than twice the radius, so that a ball reaches two slabs a coordinate
   at most; the more classes, the more slabs, so that a cell holds about ``CELL`` of them.
4. A cell finds the pairs within the block's budget, verifies their cosine on the given
   vectors in double precision, and keeps a pair if this block is the first within its
   budget. A class has one home cell a block, so each pair is seen exactly once (from
   either side within a tile).
5. Pairs are not written: a pair of tiles returns, per class, the number of vectors linked
   and one edge to the root of its component there, a spanning forest. Components of the
   forests' union are the components of all links.

Classes carry the SHA-256 of their vector, as which rows find their class again.
The work stays near quadratic in a label's size.
Rotated coordinates are rounded to single precision and made once for all blocks of a pair
of tiles; budgets are wider by ``SLACK``, which covers the
rounding. Links are decided by the exact cosine alone.

Defined cases: a null label, a null, empty or zero vector, and one that holds a null or a
component that is not finite, link with nothing; vectors of different lengths don't link.
A row without links is its own component. Repeated ids are rows of their own; a component
is named by its smallest id that is not null. Labels and ids may be of any type that
orders. Extra columns are not read; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.llm.common import prepare, written
from cadence.llm.simhash import components

THRESHOLD = 0.98
#: Rotated coordinates a block.
BLOCK = 8
#: Classes that a cell should hold, and classes and bytes of doubles that a tile may hold.
CELL, TILE, TILE_BYTES = 1024, 8192, 16 << 20
SLACK = 1e-6
ROTATION_SEED = 42
#: Pairs whose cosines are computed at once, and pairs of a cell that are compared at once.
PAIRS, COMPARED = 1 << 15, 1 << 20


@lru_cache(maxsize=8)
def rotation(size: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(ROTATION_SEED).normal(size=(size, size)))
    return q * np.sign(np.diag(r))


def blocks_of(size: int) -> list[tuple[int, int]]:
    return [(a, min(a + BLOCK, size)) for a in range(0, size, BLOCK)]


def budgets(size: int, threshold: float) -> list[float]:
    """Squared distance that each block may use up, in proportion to its coordinates."""
    whole = 2 - 2 * threshold
    return [whole * (b - a) / size + SLACK for a, b in blocks_of(size)]


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows of length 1, scaled by their largest component first (no overflow)."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def matrix(col: pa.Array) -> np.ndarray:
    """A list column whose lists have one length, as a matrix of doubles."""
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(col), -1)


def _whole(col: pa.ChunkedArray | pa.Array) -> pa.Array:
    return col.combine_chunks() if isinstance(col, pa.ChunkedArray) else col


def valid(vector: str, label: str) -> Column:
    """Rows that can link with others."""
    return (F.col(label).isNotNull() & F.col(vector).isNotNull() & (F.size(vector) > 0)
            & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
            & F.exists(vector, lambda x: x != 0))


def vector_key(vector: str) -> Column:
    """SHA-256 of a valid vector's components as doubles (both zeros alike)."""
    return F.unhex(F.sha2(F.transform(vector, lambda x: x.cast("double") + F.lit(0.0)).cast("string"), 256))


def classes_of(rows: DataFrame) -> DataFrame:
    """Distinct vectors (label, vector) of rows (id, label, vector, key): class number, size
    of the class, smallest id, vector and key."""
    distinct = rows.groupBy("label", "key").agg(F.first("vector").alias("vector"), F.min("id").alias("rep"), F.count(F.lit(1)).alias("mult"))
    # the class number is fixed by the table that is read, not made again on a retry
    return written(distinct.withColumn("cls", F.monotonically_increasing_id()), "classes")


def slabs(x: np.ndarray, radius: float, n: int, mean: np.ndarray, spread: np.ndarray,
          per_cell: int = CELL) -> tuple[np.ndarray, ...]:
    """For rows of one block's coordinates: home slab and first and last slab that the
    ball reaches, each (rows, coordinates), numbers within a byte.

    The bits that bring n classes down to ``per_cell`` a cell are dealt to the coordinates in
    turn: no bit leaves a coordinate whole, one halves it at the mean, more give slabs of
    uniform width."""
    bits = max(0, int(np.ceil(np.log2(max(n, 1) / per_cell))))
    dims = x.shape[1]
    home, low, high = (np.zeros(x.shape, np.int64) for _ in range(3))
    reach = radius + 1e-6
    for c in range(dims):
        own = bits // dims + (c < bits % dims)
        if not own:
            continue
        width = 1e300 if own == 1 else max(2 * reach * (1 + 1e-9), 4 * spread[c] / 2 ** own)
        for out, shift in ((home, 0.0), (low, -reach), (high, reach)):
            out[:, c] = np.clip(np.floor((x[:, c] + shift - mean[c]) / width), -128, 127)
    return home, low, high


def _reached(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and cell of every cell between low and high."""
    cells, rows = low.copy(), np.arange(len(low))
    for c in range(low.shape[1]):
        more = np.flatnonzero(high[rows, c] > low[rows, c])
        extra = cells[more].copy()
        extra[:, c] += 1
        cells, rows = np.concatenate([cells, extra]), np.concatenate([rows, rows[more]])
    return rows, cells


def _packed(cells: np.ndarray) -> np.ndarray:
    """Eight slab numbers of one byte as one integer."""
    out = np.zeros(len(cells), np.int64)
    for c in range(cells.shape[1]):
        out = (out << 8) | (cells[:, c] & 0xFF)
    return out


def _tiles(classes: DataFrame, tile: int) -> DataFrame:
    """One row a tile: label, size (of its vectors), part, k (tiles of that label and size),
    and the classes' numbers, sizes and vectors as binary columns."""
    kind = classes.schema["label"].dataType.simpleString()
    sized = classes.select("label", F.size("vector").alias("size"), "cls", "mult", "vector")
    most = F.greatest(F.lit(1), F.least(F.lit(tile), F.floor(F.lit(TILE_BYTES) / (8 * F.col("size")))))
    # a written table, so that Spark broadcasts it or splits a hot label's join
    counts = written(sized.groupBy("label", "size").agg(F.count(F.lit(1)).alias("n")).select(
        "label", "size", F.ceil(F.col("n") / most).cast("int").alias("k")), "counts")
    dealt = sized.join(counts, ["label", "size"]).withColumn("part", F.pmod(F.xxhash64("cls"), F.col("k")).cast("int"))

    def pack(group: pa.Table) -> pa.Table:
        group = group.sort_by("cls")
        vector = _whole(group["vector"])
        kept = np.float32 if pa.types.is_float32(vector.type.value_type) else np.float64
        blobs = (group["cls"].to_numpy().astype(np.int64), group["mult"].to_numpy().astype(np.int64), matrix(vector).astype(kept))
        return pa.table([*(group[c].slice(0, 1) for c in ("label", "size", "part", "k")), pa.array([kept is np.float32]),
                         *(pa.array([b.tobytes()], pa.binary()) for b in blobs)],
                        names=["label", "size", "part", "k", "single", "cls", "mult", "vector"])

    # a fixed number of partitions, so that the tiles' files, and then the pairs' tasks, are not few
    dealt = dealt.repartition(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")), "label", "size", "part")
    return written(dealt.groupBy("label", "size", "part").applyInArrow(
        pack, f"label {kind}, size int, part int, k int, single boolean, cls binary, mult binary, vector binary"), "tiles")


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """Smallest node of each node's component under the edges a - b, by hooking and
    pointer jumping."""
    root = np.arange(n)
    while True:
        ra, rb = root[a], root[b]
        open_ = ra != rb
        if not open_.any():
            return root
        a, b = a[open_], b[open_]
        ra, rb = ra[open_], rb[open_]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while True:
            up = root[root]
            if (up == root).all():
                break
            root = up


def _first_block(x: np.ndarray, y: np.ndarray, block: int, limits: list[float]) -> np.ndarray:
    """Pairs of rotated rows for which ``block`` is the first block within its budget.
    The sums run in one fixed order, so every group decides a pair alike."""
    keep = np.ones(len(x), bool)
    for b, (lo, hi) in enumerate(blocks_of(x.shape[1])[:block + 1]):
        d = np.zeros(len(x))
        for c in range(lo, hi):
            step = x[:, c].astype(np.float64) - y[:, c]
            d += step * step
        keep &= (d <= limits[b]) if b == block else (d > limits[b])
    return keep


def group_links(home: dict, other: dict, block: int, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Links of a group's home classes with its replicas: positions of either side.
    Sides: cls, unit (exact vectors of length 1), rot."""
    dims = home["rot"].shape[1]
    limits = budgets(dims, threshold)
    lo, hi = blocks_of(dims)[block]
    x, y = (s["rot"][:, lo:hi].astype(np.float64) for s in (home, other))
    far = (y * y).sum(axis=1)
    found_a, found_b = [], []
    for at in range(0, len(x), 256):
        part = x[at:at + 256]
        near = (part * part).sum(axis=1)[:, None] + far[None, :] - 2 * (part @ y.T) <= limits[block] + 1e-9
        i, j = np.nonzero(near)
        i += at
        other_class = home["cls"][i] != other["cls"][j]
        i, j = i[other_class], j[other_class]
        for p in range(0, len(i), PAIRS):
            a, b = i[p:p + PAIRS], j[p:p + PAIRS]
            good = np.einsum("ij,ij->i", home["unit"][a], other["unit"][b]) >= threshold
            a, b = a[good], b[good]
            first = _first_block(home["rot"][a], other["rot"][b], block, limits)
            found_a.append(a[first]), found_b.append(b[first])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_a]), np.concatenate([none, *found_b])


def _side(size: int, single: bool, cls: bytes, mult: bytes, vector: bytes) -> dict:
    """A tile's classes: numbers, sizes, unit vectors and rotated coordinates."""
    rows = unit(np.frombuffer(vector, np.float32 if single else np.float64).reshape(-1, size).astype(np.float64))
    return {"cls": np.frombuffer(cls, np.int64), "mult": np.frombuffer(mult, np.int64), "unit": rows, "rot": (rows @ rotation(size)).astype(np.float32)}


def _ranges(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Order of the rows by key, the distinct keys, and where each begins (and the end)."""
    order = np.argsort(keys, kind="stable")
    known, first = np.unique(keys[order], return_index=True)
    return order, known, np.r_[first, len(keys)]


def tile_links(home: dict, other: dict, threshold: float, per_cell: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Classes a and b and numbers n as ``links`` has them, of two tiles of a label, or of
    one (given twice)."""
    same, n = other is home, len(home["cls"])
    cls = home["cls"] if same else np.concatenate([home["cls"], other["cls"]])
    counts, root, shift = np.zeros(len(cls), np.int64), np.arange(len(cls)), 0 if same else n
    size, parts = home["rot"].shape[1], ("cls", "unit", "rot")
    for b, ((lo, hi), budget) in enumerate(zip(blocks_of(size), budgets(size, threshold))):
        x, y = (side["rot"][:, lo:hi].astype(np.float64) for side in (home, other))
        both = np.concatenate([x, y])
        grid = (float(np.sqrt(budget)), len(y), both.mean(axis=0), both.std(axis=0), per_cell)
        at_home = _packed(slabs(x, *grid)[0])
        rows, cells = _reached(*slabs(y, *grid)[1:])
        (order_x, cell_x, first_x), (order_y, cell_y, first_y) = _ranges(at_home), _ranges(_packed(cells))
        for u, v in zip(*np.intersect1d(cell_x, cell_y, return_indices=True)[1:]):
            h, o = order_x[first_x[u]:first_x[u + 1]], rows[order_y[first_y[v]:first_y[v + 1]]]
            far = {k: other[k][o] for k in parts}
            step = max(1, COMPARED // len(o))
            for at in range(0, len(h), step):
                own = h[at:at + step]
                i, j = group_links({k: home[k][own] for k in parts}, far, b, threshold)
                if not len(i):
                    continue
                i, j = own[i], o[j]
                counts[:n] += np.bincount(i, other["mult"][j], n).astype(np.int64)
                if not same:
                    counts[n:] += np.bincount(j, home["mult"][i], len(cls) - n).astype(np.int64)
                known = np.flatnonzero(root != np.arange(len(cls)))
                root = _forest(np.concatenate([known, i]), np.concatenate([root[known], j + shift]), len(cls))
    linked, below = np.flatnonzero(counts), np.flatnonzero(root != np.arange(len(cls)))
    return (np.concatenate([cls[linked], cls[below]]), np.concatenate([cls[linked], cls[root[below]]]),
            np.concatenate([counts[linked], np.zeros(len(below), np.int64)]))


def links(classes: DataFrame, threshold: float = THRESHOLD, per_cell: int = CELL, tile: int = TILE) -> DataFrame:
    """Rows (a, b, n): class a counts n linked vectors of other classes (a = b), or
    belongs to one component with class b (n = 0)."""
    tiles = _tiles(classes, tile)
    blobs = ("cls", "mult", "vector")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                get = lambda c: batch[c][r].as_py()
                home = _side(get("size"), get("single"), *map(get, blobs))
                other = home if "o_cls" not in batch.schema.names else _side(get("size"), get("single"), *(get(f"o_{c}") for c in blobs))
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in tile_links(home, other, threshold, per_cell)], names=["a", "b", "n"])

    ddl = "a bigint, b bigint, n bigint"
    own = tiles.select("size", "single", *blobs).mapInArrow(compare, ddl)
    several = tiles.filter("k > 1")
    if several.isEmpty():
        return own
    others = several.select(*(F.col(c).alias(f"o_{c}") for c in ("label", "size", "part", *blobs)))
    # a cartesian product of the table's partitions: no tile is shuffled or copied
    met = several.join(others.hint("shuffle_replicate_nl"), (F.col("label") == F.col("o_label")) & (F.col("size") == F.col("o_size")) & (F.col("part") < F.col("o_part")))
    return own.unionByName(met.select("size", "single", *blobs, *(f"o_{c}" for c in blobs)).mapInArrow(compare, ddl))


def near_duplicates(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    threshold: float = THRESHOLD, per_cell: int = CELL, tile: int = TILE) -> DataFrame:
    """id, n_links (other vectors linked directly), component_id (smallest id reachable)
    and kept (the row names its component) of every row. ``per_cell`` and ``tile`` size
    the cells and groups; results don't depend on them."""
    prepare(df.sparkSession)
    rows = df.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("vector"))
    able = valid("vector", "label")
    keyed = rows.filter(able).withColumn("key", vector_key("vector"))
    classes = classes_of(keyed)
    found = written(links(classes, threshold, per_cell, tile), "links")
    counts = found.groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("others"))
    joined = components(written(found.filter("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "forest"))
    of = classes.select("cls", "label", "key", "rep", "mult").join(
        joined.select(F.col("node").alias("cls"), "component"), "cls", "left").join(counts, "cls", "left")
    of = written(of.select("label", "key", "rep", F.coalesce("component", "cls").alias("component"),
                           (F.col("mult") - 1 + F.coalesce("others", F.lit(0))).alias("n_links")), "linked")
    named = written(of.groupBy("component").agg(F.min("rep").alias("component_id")), "named")
    of = of.join(named, "component").select(F.col("label").alias("c_label"), F.col("key").alias("c_key"), "n_links", "component_id")
    linked = keyed.drop("vector").join(of, (F.col("label") == F.col("c_label")) & (F.col("key") == F.col("c_key")))
    apart = rows.filter(~F.coalesce(able, F.lit(False))).select("id", F.lit(0).cast("bigint").alias("n_links"), F.col("id").alias("component_id"))
    out = linked.select("id", F.col("n_links").cast("bigint").alias("n_links"), "component_id").unionByName(apart)
    return out.select(F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
