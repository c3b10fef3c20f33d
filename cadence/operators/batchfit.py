"""Many tree ensembles fitted together on one binned table.

The columns that any fit reads are binned once and written, with the label, as chunks of
rows (one byte a value) to the shared checkpoint folder. A fit names its columns, its
settings, and the rows it learns from: a *view* gives every row the first fold that it
trains and the fold that it validates, so folds, gaps and the holdout are views of one
table and every fold of every draw and arm is a fit on it.

Two ways to grow the trees, with the same trees from either:

- ``in tasks``: while a fit's rows are at most ``task_rows``, its chunks (a few bytes a
  row) are dealt to one task, which grows all its rounds; a forest's trees are dealt in
  batches. The fits of a whole search are one job.
- ``over the cluster``: beyond that, chunks stay where they are. Boosted trees of a limited
  depth (``_boosted``): the rows that train stand in Spark's cache as numbers of bundles
  with their running scores; a level is one job whose tasks sum the histograms of all
  fits, and the driver adds these and picks the splits; a root's job also serves the second
  level if the root's split was guessed from the tree before. Other trees (``_over_cluster``): a
  level's job sums histograms per node by a shuffle and only splits reach the driver;
  nodes of at most ``task_rows`` rows of a tree without a depth limit go to tasks that
  finish their subtrees; a forest that is kept (``forest``) puts its trees together in
  tasks too and writes them. The running scores are written to the shared folder every
  ``REFRESH`` rounds, so no job walks more trees than that and a lost executor costs one
  job.

The size is counted, never assumed.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.operators import trees as tr
from cadence.operators.trees import Bundles, Growth, Layout, Picked, Settings, Steps, Tree
from cadence.session import ensure_checkpoint_dir, scratch_path

MAX_BINS = 128
#: Rows that one task may hold (about 250 bytes a row and 20 columns while a level is counted).
TASK_ROWS = 500_000
TREES_A_TASK = 25
#: Nodes of a batch of trees that predicts in one task (20 bytes a node).
NODES_A_TASK = 1 << 23
#: Times ``TASK_ROWS`` (9 bytes and a byte a column each) that meet a batch of trees in one task.
SHARE = 8
#: Trees that grow together in a step over the cluster, and rounds between written scores.
FOREST_STEP, REFRESH = 8, 10
#: For boosting over the cluster: rows of a block, rows that propose the bundles, rounds
#: between checkpoints, tasks whose sums the driver adds itself, and the cells of the
#: histograms (2 numbers each) that are held for all fits at once.
BLOCK, SAMPLE, CHECKPOINT, DIRECT, HELD = 100_000, 20_000, 100, 64, 1 << 22
#: Splits of a tree's root that are guessed, and the rows from which on that is tried: with
#: fewer, sums differ too much between the draws of neighbouring trees.
GUESSES, GUESS_ROWS = 3, 100_000


@dataclass(frozen=True)
class View:
    """Columns (int): first fold that a row trains, and fold that it validates (0: none)."""

    train_from: Column
    validates: Column


@dataclass(frozen=True)
class Fit:
    columns: tuple[str, ...]
    settings: Settings
    view: int = 0
    fold: int = 1


class BinnedTable:
    """Chunks of rows: n, keys, labels (log1p), views and bin codes as binary columns."""

    def __init__(self, chunks: DataFrame, columns: Sequence[str], edges: list[np.ndarray], views: int, rows: int):
        self.chunks, self.columns, self.edges, self.views, self.rows = chunks, list(columns), edges, views, rows

    def place(self, fit: Fit) -> list[int]:
        return [self.columns.index(c) for c in fit.columns]

    def layout(self, fit: Fit) -> Layout:
        return Layout([len(self.edges[i]) + 1 for i in self.place(fit)])


def _written(df: DataFrame, name: str) -> DataFrame:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bin_edges(df: DataFrame, columns: Sequence[str], max_bins: int = MAX_BINS) -> list[np.ndarray]:
    """Ascending cut points of every column: between neighbouring values where there are
    at most ``max_bins`` of them, else approximate quantiles. Two passes for all columns;
    at most ``max_bins`` numbers a column reach the driver."""
    at = [F.col(f"`{c}`").cast("double") for c in columns]
    at = [F.when(~F.isnan(c), c) for c in at]
    sizes = df.agg(*[F.approx_count_distinct(c).alias(f"n{k}") for k, c in enumerate(at)]).first()
    few = [sizes[f"n{k}"] <= 2 * max_bins for k in range(len(at))]
    probs = [(i + 1) / max_bins for i in range(max_bins - 1)]
    got = df.agg(*[F.collect_set(c).alias(f"v{k}") if few[k] else F.percentile_approx(c, probs, 100 * max_bins).alias(f"v{k}")
                   for k, c in enumerate(at)]).first() if at else {}
    out = []
    for k in range(len(at)):
        v = np.unique(np.array(got[f"v{k}"] or [], np.float64))
        if few[k] and len(v) <= max_bins:
            mid = (v[1:] + v[:-1]) / 2
            v = np.where(mid < v[1:], mid, v[:-1])     # neighbours without a number between them
        elif few[k]:
            v = np.unique(np.quantile(v, probs, method="inverted_cdf"))
        out.append(v)
    return out


def binned(df: DataFrame, columns: Sequence[str], label: str, views: Sequence[View], key: Column,
           max_bins: int = MAX_BINS) -> BinnedTable:
    """The binned table of ``df``. ``key`` (64 bits) identifies a row in the draws. Rows
    without a label train and validate nothing."""
    ensure_checkpoint_dir(df.sparkSession)
    edges = bin_edges(df, columns, max_bins)
    y = F.log1p(F.col(label).cast("double"))
    folds = [c for v in views for c in (v.train_from, v.validates)]
    flat = [F.coalesce(c.cast("int"), F.lit(0)).alias(f"__v{k}") for k, c in enumerate(folds)]
    rows = df.select(key.cast("bigint").alias("__key"), y.alias("__y"), *flat,
                     *[F.col(f"`{c}`").cast("double").alias(f"__c{k}") for k, c in enumerate(columns)])
    rows = rows.filter(F.col("__y").isNotNull() & ~F.isnan("__y"))
    n_views = 2 * len(views)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            n = len(cols[0])
            fold = np.stack(cols[2:2 + n_views], axis=1).astype(np.int32) if n_views else np.zeros((n, 0), np.int32)
            values = np.stack(cols[2 + n_views:], axis=1).astype(np.float64) if columns else np.zeros((n, 0))
            parts = [cols[0].astype(np.int64), cols[1].astype(np.float64), fold, tr.bin_codes(values, edges)]
            yield pa.RecordBatch.from_arrays([pa.array([n], pa.int32()), *(pa.array([p.tobytes()], pa.binary()) for p in parts)],
                                             names=["n", "keys", "y", "folds", "codes"])

    chunks = _written(rows.mapInArrow(pack, "n int, keys binary, y binary, folds binary, codes binary"), "binned")
    total = chunks.agg(F.sum("n")).first()[0]
    return BinnedTable(chunks, columns, edges, len(views), int(total or 0))


class _Rows:
    """Arrays of chunks: keys, labels, folds (rows, views, 2), codes and scores."""

    def __init__(self, batch: pa.RecordBatch | pa.Table, views: int, columns: int):
        get = lambda name, kind: np.concatenate([np.zeros(0, kind), *(np.frombuffer(b, kind) for b in batch[name].to_pylist())])
        self.keys, self.y = get("keys", np.int64), get("y", np.float64)
        self.folds = get("folds", np.int32).reshape(-1, views, 2)
        self.codes = get("codes", np.uint8).reshape(-1, columns)

    def trains(self, fit: Fit) -> np.ndarray:
        first = self.folds[:, fit.view, 0]
        return (first > 0) & (first <= fit.fold)

    def validates(self, fit: Fit) -> np.ndarray:
        return self.folds[:, fit.view, 1] == fit.fold


SCORES = "fit int, key bigint, y double, log_pred double"
TREES = "fit int, tree int, base double, col binary, cut binary, lft binary, value binary, gain binary"
_PARTS = (("column", np.int32), ("cut", np.int32), ("left", np.int32), ("value", np.float64), ("gain", np.float64))


def tree_row(tree: Tree) -> list[bytes]:
    return [getattr(tree, name).astype(kind).tobytes() for name, kind in _PARTS]


def tree_of(row) -> Tree:
    return Tree(*(np.frombuffer(row[c], kind) for c, (_, kind) in zip(("col", "cut", "lft", "value", "gain"), _PARTS)))


def _in_tasks(table: BinnedTable, fits: Sequence[Fit], keep_trees: bool) -> DataFrame:
    """One group per fit, or per batch of a forest's trees: scores of the rows that the
    fit validates (a forest's are sums over the batch), or the trees."""
    units = []
    for i, f in enumerate(fits):
        step = TREES_A_TASK if f.settings.bootstrap else f.settings.rounds
        units += [(i, a, min(a + step, f.settings.rounds)) for a in range(0, f.settings.rounds, step)]
    # the longest first, so that none is left to run alone at the end
    units.sort(key=lambda u: -(u[2] - u[1]) * 2 ** (min(fits[u[0]].settings.max_depth or 10, 10) / 2) * fits[u[0]].fold)
    places, layouts = [table.place(f) for f in fits], [table.layout(f) for f in fits]
    views, columns = table.views, len(table.columns)

    def work(group: pa.Table) -> pa.Table:
        i, first, last = units[group["unit"][0].as_py()]
        f, rows = fits[i], _Rows(group, views, columns)
        order = np.argsort(rows.keys, kind="stable")    # the order of chunks doesn't matter
        train, judged = rows.trains(f)[order], rows.validates(f)[order]
        used = order[train | judged] if not keep_trees else order[train]
        train, judged = rows.trains(f)[used], rows.validates(f)[used]
        made, base, score = tr.fit(rows.codes[used][:, places[i]], rows.y[used], rows.keys[used], train, layouts[i], f.settings, first, last)
        if keep_trees:
            cols = list(zip(*(tree_row(t) for t in made)))
            return pa.table([pa.array([i] * len(made), pa.int32()), pa.array(range(first, last), pa.int32()), pa.array([base] * len(made)),
                             *(pa.array(c, pa.binary()) for c in cols)], names=[x.split()[0] for x in TREES.split(", ")])
        return pa.table([pa.array(np.full(judged.sum(), i, np.int32)), pa.array(rows.keys[used][judged]), pa.array(rows.y[used][judged]),
                         pa.array(score[judged])], names=["fit", "key", "y", "log_pred"])

    # a partition a unit, in order: ranges of the unit's number, which AQE doesn't merge
    every = table.chunks.select(F.explode(F.array(*[F.lit(u) for u in range(len(units))])).alias("unit"), "*")
    dealt = every.repartitionByRange(min(2000, len(units)), "unit")
    return dealt.groupBy("unit").applyInArrow(work, TREES if keep_trees else SCORES)


class _Open:
    """A tree that grows over the cluster."""

    def __init__(self, fit: int, tree: int):
        self.fit, self.tree, self.growth, self.depth = fit, tree, Growth(), 0
        self.handed: list[tuple[int, int]] = []      # (node, depth) of subtrees that tasks finish

    def partial(self) -> tuple[Tree, int, int]:
        """The tree so far, its size, and the open level's nodes."""
        g = self.growth
        none = [np.zeros(0)] * 5
        done = g.tree() if g.column else Tree(*none)
        pad = np.zeros(g.live)
        whole = Tree(np.r_[done.column, pad - 1].astype(np.int32), *(np.r_[getattr(done, n), pad].astype(k) for n, k in _PARTS[1:]))
        return whole, g.size, g.live


def _graft(tree: Tree, node: int, sub: Tree) -> Tree:
    """``tree`` with the leaf ``node`` replaced by the root of ``sub``."""
    shift = len(tree.column) - 1
    parts = {n: np.concatenate([getattr(tree, n), getattr(sub, n)[1:]]) for n, _ in _PARTS}
    for n, _ in _PARTS:
        parts[n][node] = getattr(sub, n)[0]
    moved = parts["left"]
    own = np.r_[node, np.arange(len(tree.column), len(moved))]
    moved[own] = np.where(parts["column"][own] >= 0, moved[own] + shift, 0)
    return Tree(**parts)


def _over_cluster(table: BinnedTable, fits: Sequence[Fit], task_rows: int, to: str | None = None) -> tuple[list[list[Tree]], list[float], DataFrame]:
    """Trees and starts of all fits, and the chunks with the scores of every fit. With a
    path ``to`` (forests only) the trees are written there as ``TREES`` instead: the driver
    holds no more of them than the nodes above those that tasks finish."""
    places, layouts = [table.place(f) for f in fits], [table.layout(f) for f in fits]
    kinds = [np.int16 if lay.total < 1 << 15 else np.int32 for lay in layouts]
    views, columns = table.views, len(table.columns)

    def unpacked(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, _Rows, np.ndarray]]:
        for k in range(batch.num_rows):
            one = batch.slice(k, 1)
            rows = _Rows(one, views, columns)
            yield one, rows, np.frombuffer(one["score"][0].as_py(), np.float64).reshape(len(fits), -1)

    def codes_of(rows: _Rows, i: int) -> np.ndarray:
        return np.asfortranarray(rows.codes[:, places[i]].astype(np.int64) + layouts[i].starts)

    def scored(rows: _Rows, held: np.ndarray, i: int, fresh: Sequence[Tree]) -> np.ndarray:
        out = held[i].copy()
        codes = codes_of(rows, i) if fresh else None
        for t in fresh:
            out += t.value[tr.leaves(codes, t)]
        return out

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = np.zeros(len(fits)), np.zeros(len(fits))
        for batch in batches:
            for k in range(batch.num_rows):
                rows = _Rows(batch.slice(k, 1), views, columns)
                for i, f in enumerate(fits):
                    m = rows.trains(f)
                    n[i] += m.sum()
                    s[i] += rows.y[m].sum()
        yield pa.RecordBatch.from_arrays([pa.array(range(len(fits)), pa.int32()), pa.array(n), pa.array(s)], names=["fit", "n", "s"])

    sums = table.chunks.mapInArrow(start, "fit int, n double, s double").groupBy("fit").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    base = [0.0] * len(fits)
    for r in sums:
        if not fits[r["fit"]].settings.bootstrap and r["n"]:
            base[r["fit"]] = r["s"] / r["n"]

    def with_scores(chunks: DataFrame, fresh: dict[int, list[Tree]], first: bool = False) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                if first:
                    blobs = [np.repeat(np.array(base), n).tobytes() for n in batch["n"].to_pylist()]
                else:
                    blobs = [np.stack([scored(rows, held, i, fresh.get(i, ())) for i in range(len(fits))]).tobytes()
                             for _, rows, held in unpacked(batch)]
                own = [batch[c] for c in ("n", "keys", "y", "folds", "codes")]
                yield pa.RecordBatch.from_arrays([*own, pa.array(blobs, pa.binary())], names=["n", "keys", "y", "folds", "codes", "score"])
        return _written(chunks.mapInArrow(run, "n int, keys binary, y binary, folds binary, codes binary, score binary"), "scores")

    state = with_scores(table.chunks, {}, first=True)
    made: list[list[Tree]] = [[] for _ in fits]
    fresh: dict[int, list[Tree]] = {}

    def prepared(rows: _Rows, held: np.ndarray, o: _Open, walk: Tree):
        """Numbered codes, node, gradient and weight of the rows that train a tree."""
        f = fits[o.fit]
        m = np.flatnonzero(rows.trains(f))
        w = tr.weights(rows.keys[m], f.settings, o.tree)
        m, w = m[w > 0], w[w > 0]
        y = rows.y if f.settings.bootstrap else rows.y - scored(rows, held, o.fit, fresh.get(o.fit, ()))
        codes = tr.rows_of(codes_of(rows, o.fit), m)
        return codes, tr.leaves(codes, walk), y[m], w, rows.keys[m]

    def level(opened: list[_Open]) -> list:
        walks = [o.partial() for o in opened]

        def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held_hist: dict[int, np.ndarray] = {}
            for batch in batches:
                for _, rows, held in unpacked(batch):
                    for u, o in enumerate(opened):
                        walk, size, live = walks[u]
                        codes, node, g, w, _ = prepared(rows, held, o, walk)
                        at = np.flatnonzero(node >= size)
                        f = fits[o.fit]
                        hist = tr.histogram(tr.rows_of(codes, at), node[at] - size, live, (g * w)[at], w[at] if f.settings.bootstrap else None, layouts[o.fit])
                        held_hist[u] = held_hist[u] + hist if u in held_hist else hist
            for u, hist in held_hist.items():
                nodes = np.flatnonzero(hist[0].sum(axis=1))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(nodes), u, np.int32)), pa.array(nodes.astype(np.int32)),
                                                  pa.array([hist[:, k].tobytes() for k in nodes], pa.binary())], names=["unit", "node", "hist"])

        def choose(group: pa.Table) -> pa.Table:
            u, k = group["unit"][0].as_py(), group["node"][0].as_py()
            o, f, lay = opened[u], fits[opened[u].fit], layouts[opened[u].fit]
            hist = sum(np.frombuffer(b.as_py(), np.float64) for b in group["hist"]).reshape(-1, 1, lay.total)
            settings = f.settings
            mask = tr.allowed(settings, o.tree, o.depth, walks[u][2], len(lay.sizes))
            p = tr.pick(hist, lay, settings, None if mask is None else mask[k:k + 1])
            return pa.table([pa.array([x]) for x in (u, k, int(p.column[0]), int(p.cut[0]), float(p.gain[0]), float(p.rows[0]), float(p.g[0]), float(p.h[0]))],
                            names=["unit", "node", "column", "cut", "gain", "rows", "g", "h"])

        parts = state.mapInArrow(count, "unit int, node int, hist binary")
        return parts.groupBy("unit", "node").applyInArrow(choose, "unit bigint, node bigint, column bigint, cut bigint, gain double, rows double, g double, h double").collect()

    def subtrees(opened: list[_Open]) -> DataFrame:
        """Subtrees of the nodes that were handed over, each grown in one task: ``TREES``,
        with the number in ``opened`` as fit and the node as tree."""
        whole = [o.growth.tree() for o in opened]
        depths = {(u, node): d for u, o in enumerate(opened) for node, d in o.handed}

        def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for _, rows, held in unpacked(batch):
                    for u, o in enumerate(opened):
                        codes, node, g, w, keys = prepared(rows, held, o, whole[u])
                        for k in np.unique(node).tolist():
                            if (u, k) in depths:
                                m = node == k
                                yield pa.RecordBatch.from_arrays(
                                    [pa.array([u], pa.int32()), pa.array([k], pa.int32()),
                                     *(pa.array([x.tobytes()], pa.binary()) for x in (codes[m].astype(kinds[o.fit]), g[m], w[m], keys[m]))],
                                    names=["unit", "node", "codes", "g", "w", "keys"])

        def subtree(group: pa.Table) -> pa.Table:
            u, k = group["unit"][0].as_py(), group["node"][0].as_py()
            get = lambda c, kind: np.concatenate([np.frombuffer(b.as_py(), kind) for b in group[c]])
            lay = layouts[opened[u].fit]
            order = np.argsort(get("keys", np.int64), kind="stable")
            codes = get("codes", kinds[opened[u].fit]).reshape(-1, len(lay.sizes))[order].astype(np.int64)
            tree, _ = tr.grow(codes, get("g", np.float64)[order], get("w", np.float64)[order], lay, fits[opened[u].fit].settings, opened[u].tree, depths[u, k])
            return pa.table([pa.array([u], pa.int32()), pa.array([k], pa.int32()), pa.array([0.0]), *(pa.array([b], pa.binary()) for b in tree_row(tree))],
                            names=[x.split()[0] for x in TREES.split(", ")])

        dealt = state.mapInArrow(deal, "unit int, node int, codes binary, g binary, w binary, keys binary")
        parts = dealt.repartition(min(2000, 2 * len(depths)), "unit", "node").groupBy("unit", "node")
        return parts.applyInArrow(subtree, TREES)

    def put(opened: list[_Open]) -> None:
        """Writes trees, those with subtrees put together in a task each."""
        whole, handed = [o.growth.tree() for o in opened], [[node for node, _ in o.handed] for o in opened]
        numbers = [(o.fit, o.tree) for o in opened]

        def graft(group: pa.Table) -> pa.Table:
            u = group["fit"][0].as_py()
            below, tree = {r["tree"]: r for r in group.to_pylist()}, whole[u]
            for node in handed[u]:
                tree = _graft(tree, node, tree_of(below.pop(node)))
            fit, number = numbers[u]
            return pa.table([pa.array([fit], pa.int32()), pa.array([number], pa.int32()), pa.array([0.0]), *(pa.array([b], pa.binary()) for b in tree_row(tree))],
                            names=[x.split()[0] for x in TREES.split(", ")])

        if any(handed):
            # a partition, and so a file, a tree or a few
            subtrees(opened).repartition(len(opened), "fit").groupBy("fit").applyInArrow(graft, TREES).write.mode("append").parquet(to)
        done = [(*numbers[u], 0.0, *map(bytearray, tree_row(whole[u]))) for u in range(len(opened)) if not handed[u]]
        if done:
            table.chunks.sparkSession.createDataFrame(done, TREES).write.mode("append").parquet(to)

    most = max(f.settings.rounds for f in fits)
    step = FOREST_STEP if all(f.settings.bootstrap for f in fits) else 1
    for first in range(0, most, step):
        opened = [_Open(i, t) for i, f in enumerate(fits) for t in range(first, min(first + step, f.settings.rounds))]
        growing = opened
        while growing:
            found: dict[int, list] = {}
            for r in level(growing):
                found.setdefault(r["unit"], []).append(r)
            still = []
            for u, o in enumerate(growing):
                s, live = fits[o.fit].settings, o.growth.live
                p = Picked(np.full(live, -1), np.zeros(live, np.int64), *(np.zeros(live) for _ in range(4)))
                for r in found.get(u, ()):
                    k = r["node"]
                    p.column[k], p.cut[k], p.gain[k], p.rows[k], p.g[k], p.h[k] = (r[c] for c in ("column", "cut", "gain", "rows", "g", "h"))
                if s.max_depth is None:
                    small = (p.rows <= task_rows) & (p.column >= 0)
                    o.handed += [(o.growth.size + int(k), o.depth) for k in np.flatnonzero(small)]
                    p.column[small] = -1
                o.growth.close_level(p, s, s.max_depth is None or o.depth < s.max_depth)
                o.depth += 1
                if o.growth.live:
                    still.append(o)
            growing = still
        if to is not None:
            put(opened)
            continue
        below = {(r["fit"], r["tree"]): tree_of(r) for r in subtrees(opened).collect()} if any(o.handed for o in opened) else {}
        for u, o in enumerate(opened):
            tree = o.growth.tree()
            for node, _ in o.handed:
                tree = _graft(tree, node, below[u, node])
            made[o.fit].append(tree)
            fresh.setdefault(o.fit, []).append(tree)
        if (first // step + 1) % REFRESH == 0:
            state, fresh = with_scores(state, fresh), {}
    if fresh:
        state = with_scores(state, fresh)
    return made, base, state


def _limited(fit: Fit) -> bool:
    """Whether a fit is boosted with trees of a limited depth."""
    return not fit.settings.bootstrap and (fit.settings.max_depth or 0) > 0


class _Block:
    """Rows that train, of some chunks: numbers of bundles, labels, keys, and by fit
    whether a row trains it and its running score."""

    def __init__(self, packed: np.ndarray, y: np.ndarray, keys: np.ndarray, train: np.ndarray, score: np.ndarray):
        self.packed, self.y, self.keys, self.train, self.score = packed, y, keys, train, score

    def added(self, fresh: Sequence[Sequence[Steps]]) -> _Block:
        score = self.score.copy()
        for i, steps in enumerate(fresh):
            for t in steps:
                score[i] += t.value.take(t.leaves(self.packed))
        return _Block(self.packed, self.y, self.keys, self.train, score)


def _bundles(table: BinnedTable, fits: Sequence[Fit], full: Layout) -> tuple[Bundles, list[float]]:
    """The bundles of a table's columns, proposed by at most about ``SAMPLE`` rows and with
    the joint codes of all rows, and the starts of the fits. Two passes; a task returns at
    most ``APART`` numbers a bundle."""
    views, columns, share = table.views, len(table.columns), SAMPLE / max(1, table.rows)
    read = lambda batch: (_Rows(batch.slice(k, 1), views, columns) for k in range(batch.num_rows))

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows in read(batch):
                codes = rows.codes[tr.uniform(rows.keys, 1) < share]
                yield pa.RecordBatch.from_arrays([pa.array([codes.tobytes()], pa.binary())], names=["codes"])

    looked = b"".join(bytes(r["codes"]) for r in table.chunks.mapInArrow(some, "codes binary").collect())
    groups = tr.proposed(np.frombuffer(looked, np.uint8).reshape(-1, columns), full)

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[np.ndarray | None] = [np.zeros(0, np.int64)] * len(groups)
        n, s = np.zeros(len(fits)), np.zeros(len(fits))
        for batch in batches:
            for rows in read(batch):
                for b, group in enumerate(groups):
                    if found[b] is not None:
                        both = np.union1d(found[b], tr.joint_codes(rows.codes, group, full))
                        found[b] = both if len(group) == 1 or len(both) <= tr.APART else None
                for i, f in enumerate(fits):
                    m = rows.trains(f)
                    n[i] += m.sum()
                    s[i] += rows.y[m].sum()
        blobs = [None if x is None else x.astype(np.int64).tobytes() for x in found]
        yield pa.RecordBatch.from_arrays([pa.array([n.tobytes()], pa.binary()), pa.array([s.tobytes()], pa.binary()), pa.array([blobs], pa.list_(pa.binary()))],
                                         names=["n", "s", "known"])

    got = table.chunks.mapInArrow(known, "n binary, s binary, known array<binary>").collect()
    n = sum((np.frombuffer(r["n"]) for r in got), np.zeros(len(fits)))
    s = sum((np.frombuffer(r["s"]) for r in got), np.zeros(len(fits)))
    parts, joint = [], []
    for b, group in enumerate(groups):
        all_ = [r["known"][b] for r in got]
        numbers = None if None in all_ else np.unique(np.concatenate([np.zeros(0, np.int64), *(np.frombuffer(x, np.int64) for x in all_)]))
        if numbers is None or len(group) > 1 and len(numbers) > tr.APART:
            parts += [[c] for c in group]
            joint += [np.arange(full.sizes[c]) for c in group]
        else:
            parts.append(group)
            joint.append(numbers)
    return Bundles(full, parts, joint), [float(a / b) if b else 0.0 for a, b in zip(s, n)]


def _boosted(table: BinnedTable, fits: Sequence[Fit]) -> tuple[list[list[Tree]], list[float]]:
    """Trees and starts of boosted fits of a limited depth, without moving rows. A tree of
    depth d takes d jobs: its leaves' sums are those of the last splits' sides. On
    ``GUESS_ROWS`` rows or more most take one job less: the last level's job also counts the
    next tree's rows, from which some splits of its root are guessed (``foreseen``). The
    root's job then counts by the sides of all guesses; if the split that is picked from the
    exact sums is among them, the second level's sums are there already. Trees are
    added to the cached scores every ``REFRESH`` rounds, by the next level's job, and the
    cached rows are checkpointed every ``CHECKPOINT`` rounds."""
    full = Layout([len(e) + 1 for e in table.edges])
    places, layouts = [table.place(f) for f in fits], [table.layout(f) for f in fits]
    cells = [np.concatenate([np.arange(full.starts[c], full.ends[c]) for c in p]) if p else np.zeros(0, np.int64) for p in places]
    views, columns = table.views, len(table.columns)
    bundles, base = _bundles(table, fits, full)
    kind = np.uint16 if max(bundles.sizes, default=0) <= 1 << 16 else np.int32

    def blocks(chunks: Iterator) -> Iterator[_Block]:
        held: list[_Block] = []

        def whole() -> _Block:
            cat = lambda name, axis=0: np.concatenate([getattr(b, name) for b in held], axis=axis)
            return _Block(np.asfortranarray(cat("packed")), cat("y"), cat("keys"), cat("train", 1), cat("score", 1))
        for chunk in chunks:
            rows = _Rows({name: pa.array([bytes(chunk[name])], pa.binary()) for name in ("keys", "y", "folds", "codes")}, views, columns)
            train = np.stack([rows.trains(f) for f in fits])
            m = np.flatnonzero(train.any(axis=0))
            held.append(_Block(bundles.packed(rows.codes[m], kind), rows.y[m], rows.keys[m], train[:, m], np.repeat(np.array(base)[:, None], len(m), axis=1)))
            if sum(len(b.y) for b in held) >= BLOCK:
                yield whole()
                held = []
        if held:
            yield whole()

    spark = table.chunks.sparkSession
    tasks = max(spark.sparkContext.defaultParallelism, -(-table.rows // TASK_ROWS))
    state = table.chunks.repartition(tasks).rdd.mapPartitions(blocks).persist(StorageLevel.MEMORY_AND_DISK)
    old = None
    made: list[list[Tree]] = [[] for _ in fits]
    fresh: list[list[Steps]] = [[] for _ in fits]

    guessed: list[list[tuple[int, np.ndarray]]] = [[] for _ in fits]      # sides of the next root's guessed splits
    most = GUESSES if table.rows >= GUESS_ROWS else 0

    def foreseen(o: _Open, counts: np.ndarray) -> list[tuple[int, np.ndarray]]:
        """Guesses of the next tree's root, from its rows' sums before ``o`` by the nodes of
        ``o``'s last level and the leaves above it. The sides of a last split are known in
        the bundle of its column, elsewhere taken to be dealt evenly."""
        tree, lay, s = o.growth.tree(), layouts[o.fit], fits[o.fit].settings
        rows, g = counts[0], counts[1].sum(axis=0)
        ends = np.cumsum(bundles.sizes)
        for k in range(len(rows)):
            c, left = tree.column[k], tree.left[k]
            step = np.full(len(g), tree.value[k])
            if c >= 0:
                home, right = bundles.right(places[o.fit][c], tree.cut[k] - lay.starts[c])
                own = slice(ends[home] - len(right), ends[home])
                sides = np.where(right, *tree.value[[left + 1, left]])
                step[:] = rows[k, own] @ sides / max(1.0, rows[k, own].sum())
                step[own] = sides
            g = g - rows[k] * step
        hist = bundles.by_columns(np.stack([rows.sum(axis=0), g])[:, None])[:, :, cells[o.fit]]
        out: dict[tuple, tuple[int, np.ndarray]] = {}
        for c, cut in tr.likely(hist, lay, s, tr.allowed(s, o.tree + 1, 0, 1, len(lay.sizes)), 8 * most):
            home, right = bundles.right(places[o.fit][c], cut - lay.starts[c])
            out.setdefault((home, right.tobytes()), (home, right))
        return list(out.values())[:most]

    def level(opened: list[_Open]) -> list[tuple[np.ndarray, np.ndarray | None]]:
        """Histograms of the open levels' nodes, by the fits' columns (a root's by the sides of
        its guessed splits), and for trees at their last level the next tree's counts."""
        walks = []
        for o in opened:
            tree, size, live = o.partial()
            s, sides = fits[o.fit].settings, [] if o.depth else guessed[o.fit]
            ahead = most > 0 and 1 < s.max_depth == o.depth + 1 and o.tree + 1 < s.rounds
            walks.append((o.fit, o.tree, Steps(bundles, tree, places[o.fit], layouts[o.fit].starts), size, live << len(sides), sides, ahead))

        def drawn(keys: np.ndarray, i: int, t: int, node: np.ndarray, other: int) -> np.ndarray:
            """The node of rows that are drawn for a tree, ``other`` for the rest."""
            return node if fits[i].settings.row_share >= 1 else np.where(tr.weights(keys, fits[i].settings, t) > 0, node, other)

        def count(some: Iterator[_Block]) -> Iterator[list[np.ndarray]]:
            total = [np.zeros((2, nodes, sum(bundles.sizes))) for *_, size, live, _, ahead in walks for nodes in (live, size + live if ahead else 0)]
            for block in some:
                for u, (i, t, steps, size, live, sides, ahead) in enumerate(walks):
                    m = block.train[i]
                    every = m.all()
                    m = np.flatnonzero(m)
                    packed, keys = (block.packed, block.keys) if every else (tr.rows_of(block.packed, m), block.keys[m])
                    node = steps.leaves(packed)
                    g = (block.y - block.score[i])[m]
                    for earlier in fresh[i]:
                        g -= earlier.value.take(earlier.leaves(packed))
                    # rows that don't count go to a node after the last
                    if ahead:
                        total[2 * u + 1] += bundles.counts(packed, drawn(keys, i, t + 1, node, size + live), size + live + 1, g, None)[:, :-1]
                    node -= size
                    at = np.where(node < 0, live, node) if size else node
                    for k, (home, right) in enumerate(sides):
                        at = at + (right.take(packed[:, home]).astype(np.int64) << k)
                    total[2 * u] += bundles.counts(packed, drawn(keys, i, t, at, live), live + 1, g, None)[:, :-1]
            yield total

        add = lambda a, b: [x + y for x, y in zip(a, b)]
        summed = state.mapPartitions(count).treeReduce(add, depth=1 if tasks <= DIRECT else 2)
        return [(bundles.by_columns(summed[2 * u])[:, :, cells[o.fit]], summed[2 * u + 1] if walks[u][-1] else None) for u, o in enumerate(opened)]

    def closed(o: _Open, hist: np.ndarray) -> bool:
        """Takes the histogram of a tree's open level; whether another level opens."""
        s, lay = fits[o.fit].settings, layouts[o.fit]
        p = tr.pick(hist, lay, s, tr.allowed(s, o.tree, o.depth, o.growth.live, len(lay.sizes)))
        o.growth.close_level(p, s)
        o.depth += 1
        if o.growth.live and o.depth < s.max_depth:
            return True
        if o.growth.live:
            sides = []
            for k in np.flatnonzero(p.column >= 0).tolist():
                c = p.column[k]
                left = hist[:, k, lay.starts[c]:p.cut[k] + 1].sum(axis=1)
                sides += [left, hist[:, k, lay.starts[c]:lay.ends[c]].sum(axis=1) - left]
            rows, g = np.array(sides).T
            none = np.full(len(rows), -1)
            o.growth.close_level(Picked(none, none, none, rows, g, rows), s)
        return False

    def second(o: _Open, hist: np.ndarray, sides: Sequence[tuple[int, np.ndarray]]) -> np.ndarray | None:
        """The second level's histogram if the root was split as one of the guesses."""
        c, cut = int(o.growth.column[0][0]), int(o.growth.cut[0][0])
        home, right = bundles.right(places[o.fit][c], cut - layouts[o.fit].starts[c])
        for k, (b, guess) in enumerate(sides):
            if b == home and (guess == right).all():
                bit = np.arange(hist.shape[1]) >> k & 1
                return np.stack([hist[:, bit == x].sum(axis=1) for x in (0, 1)], axis=1)
        return None

    for t in range(max(f.settings.rounds for f in fits)):
        opened = [_Open(i, t) for i, f in enumerate(fits) if t < f.settings.rounds]
        growing = opened
        while growing:
            still = []
            for o, (hist, ahead) in zip(growing, level(growing)):
                sides = [] if o.depth else guessed[o.fit]
                more = closed(o, hist.sum(axis=1, keepdims=True) if sides else hist)
                below = second(o, hist, sides) if more and sides else None
                if below is not None:
                    more = closed(o, below)
                if more:
                    still.append(o)
                else:
                    guessed[o.fit] = [] if ahead is None else foreseen(o, ahead)
            growing = still
            if old is not None:                   # the new scores are cached by now
                old.unpersist()
                old = None
        for o in opened:
            tree = o.growth.tree()
            made[o.fit].append(tree)
            fresh[o.fit].append(Steps(bundles, tree, places[o.fit], layouts[o.fit].starts))
        if (t + 1) % REFRESH == 0:
            held = fresh
            fresh = [[] for _ in fits]
            old, state = state, state.map(lambda block, held=held: block.added(held)).persist(StorageLevel.MEMORY_AND_DISK)
            if (t + 1) % CHECKPOINT == 0:
                state.checkpoint()
    for rdd in (old, state):
        if rdd is not None:
            rdd.unpersist()
    return made, base


def _boosted_in_shares(table: BinnedTable, fits: Sequence[Fit]) -> tuple[list[list[Tree]], list[float]]:
    """``_boosted``, as many fits at once as histograms may be held."""
    made, base, at = [], [], 0
    total = sum(len(e) + 1 for e in table.edges)
    while at < len(fits):
        end, held = at, 0
        while end < len(fits) and (end == at or held + (total << fits[end].settings.max_depth) <= HELD):
            held += total << fits[end].settings.max_depth
            end += 1
        some = _boosted(table, fits[at:end])
        made, base, at = made + some[0], base + some[1], end
    return made, base


def _scored(table: BinnedTable, fits: Sequence[Fit], numbers: Sequence[int], models: Sequence[Ensemble]) -> DataFrame:
    """``SCORES`` of fitted ensembles, under the given numbers."""
    views, columns = table.views, len(table.columns)
    places, starts = [table.place(f) for f in fits], [table.layout(f).starts for f in fits]
    shared = table.chunks.sparkSession.sparkContext.broadcast(list(models))

    def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows = _Rows(batch.slice(k, 1), views, columns)
                for i, f in enumerate(fits):
                    m = np.flatnonzero(rows.validates(f))
                    score = shared.value[i].of_codes(np.asfortranarray(rows.codes[m][:, places[i]] + starts[i]))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(m), numbers[i], np.int32)), pa.array(rows.keys[m]), pa.array(rows.y[m]), pa.array(score)],
                                                     names=["fit", "key", "y", "log_pred"])
    return table.chunks.mapInArrow(judged, SCORES)


def scores(table: BinnedTable, fits: Sequence[Fit], task_rows: int = TASK_ROWS) -> DataFrame:
    """fit, key, y (log1p of the label) and log_pred of the rows that each fit validates."""
    if not fits:
        return table.chunks.sparkSession.createDataFrame([], SCORES)
    limited = [i for i, f in enumerate(fits) if _limited(f)]
    if table.rows <= task_rows:
        made = _in_tasks(table, fits, False)
    elif limited:
        own = [fits[i] for i in limited]
        trees, starts = _boosted_in_shares(table, own)
        made = _scored(table, own, limited, [Ensemble.of(table, f, a, b) for f, a, b in zip(own, starts, trees)])
        rest = [i for i in range(len(fits)) if i not in limited]
        if rest:
            others = scores(table, [fits[i] for i in rest], task_rows)
            return made.unionByName(others.withColumn("fit", F.element_at(F.array(*map(F.lit, rest)), F.col("fit") + 1).cast("int")))
        return made
    else:
        _, _, state = _over_cluster(table, fits, task_rows)
        views, columns = table.views, len(table.columns)

        def judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for k in range(batch.num_rows):
                    rows = _Rows(batch.slice(k, 1), views, columns)
                    held = np.frombuffer(batch["score"][k].as_py(), np.float64).reshape(len(fits), -1)
                    for i, f in enumerate(fits):
                        m = rows.validates(f)
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(m.sum(), i, np.int32)), pa.array(rows.keys[m]), pa.array(rows.y[m]),
                                                          pa.array(held[i][m])], names=["fit", "key", "y", "log_pred"])
        made = state.mapInArrow(judged, SCORES)
    rounds = {i: f.settings.rounds for i, f in enumerate(fits) if f.settings.bootstrap}
    if not rounds:
        return made
    # a forest's score is the mean over its trees, whose sums come in batches
    trees = F.element_at(F.create_map(*[F.lit(x) for i, n in rounds.items() for x in (i, float(n))]), F.col("fit"))
    whole = made.groupBy("fit", "key", "y").agg(F.sum("log_pred").alias("log_pred"))
    return whole.select("fit", "key", "y", (F.col("log_pred") / F.coalesce(trees, F.lit(1.0))).alias("log_pred"))


@dataclass
class Ensemble:
    """A fitted ensemble: a row's log score from its raw columns."""

    columns: list[str]
    edges: list[np.ndarray]
    settings: Settings
    base: float
    trees: list[Tree]

    @staticmethod
    def of(table: BinnedTable, fit: Fit, base: float, trees: list[Tree]) -> Ensemble:
        return Ensemble(list(fit.columns), [table.edges[i] for i in table.place(fit)], fit.settings, base, trees)

    def log_score(self, values: np.ndarray) -> np.ndarray:
        starts = Layout([len(e) + 1 for e in self.edges]).starts
        return self.of_codes(np.asfortranarray(tr.bin_codes(values, self.edges).astype(np.int32) + starts.astype(np.int32)))

    def of_codes(self, codes: np.ndarray) -> np.ndarray:
        """Log scores of numbered codes."""
        out = np.full(len(codes), self.base)
        for t in self.trees:
            out += t.value[tr.leaves(codes, t)]
        return out / len(self.trees) if self.settings.bootstrap else out


@dataclass
class Forest:
    """A fitted forest whose trees stand in a table (``TREES``), a row a tree."""

    columns: list[str]
    edges: list[np.ndarray]
    settings: Settings
    trees: DataFrame
    base: float = 0.0


def forest(table: BinnedTable, fit: Fit, task_rows: int = TASK_ROWS) -> Forest:
    """One forest, grown in tasks that write its trees to the shared folder. Beyond
    ``task_rows`` a task holds a subtree's rows, or one whole tree to put it together."""
    if table.rows <= task_rows:
        trees = _written(_in_tasks(table, [fit], True), "forest")
    else:
        path = scratch_path(table.chunks.sparkSession, "forest")
        _over_cluster(table, [fit], task_rows, path)
        trees = table.chunks.sparkSession.read.schema(TREES).parquet(path)
    return Forest(list(fit.columns), [table.edges[i] for i in table.place(fit)], fit.settings, trees)


def forest_scores(model: Forest, df: DataFrame, out: str) -> DataFrame:
    """``df`` with the mean of the trees' values. Its rows are written once with a number,
    their bin codes go to every batch of trees, a share of the rows at a time (``SHARE``
    times what is walked at once, as each share needs all trees), and the batches' sums come
    together by the number, in the trees' order. A batch is ``TREES_A_TASK`` trees, or as
    many as have ``NODES_A_TASK`` nodes."""
    held = _written(df.withColumn("__at", F.monotonically_increasing_id()), "judged")
    walked = TASK_ROWS
    shares = max(1, -(-held.count() // (SHARE * walked)))
    largest = (model.trees.agg(F.max(F.octet_length("col"))).first()[0] or 0) // 4
    step = max(1, min(TREES_A_TASK, NODES_A_TASK // max(1, largest)))
    edges, columns = model.edges, len(model.columns)
    starts = Layout([len(e) + 1 for e in edges]).starts

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, *values = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            codes = tr.bin_codes(np.stack(values, axis=1).astype(np.float64) if columns else np.zeros((len(at), 0)), edges)
            yield pa.RecordBatch.from_arrays([pa.array([b], pa.binary()) for b in (at.astype(np.int64).tobytes(), codes.tobytes())], names=["at", "codes"])

    rows = held.select("__at", *[F.col(f"`{c}`").cast("double").alias(f"__c{k}") for k, c in enumerate(model.columns)])
    rows = rows.mapInArrow(pack, "at binary, codes binary").withColumn("share", F.pmod(F.xxhash64("at"), F.lit(shares)).cast("int"))
    units = -(-model.settings.rounds // step)
    rows = rows.withColumn("unit", F.explode(F.sequence(F.lit(0), F.lit(units - 1))))
    trees = model.trees.drop("gain").withColumn("unit", F.floor(F.col("tree") / step).cast("int")) \
        .withColumn("share", F.explode(F.sequence(F.lit(0), F.lit(shares - 1))))

    def walk(some: pa.Table, batch: pa.Table) -> pa.Table:
        get = lambda c, kind: np.concatenate([np.zeros(0, kind), *(np.frombuffer(b.as_py(), kind) for b in some[c])])
        at = get("at", np.int64)
        codes, total = get("codes", np.uint8).reshape(len(at), columns), np.zeros(len(at))
        made = [tree_of({**t, "gain": t["value"]}) for t in sorted(batch.to_pylist(), key=lambda t: t["tree"])] if len(at) else []
        for lo in range(0, len(at), walked):
            some_codes = codes[lo:lo + walked].astype(np.int64) + starts
            for tree in made:
                total[lo:lo + walked] += tree.value[tr.leaves(some_codes, tree)]
        unit = batch["unit"][0].as_py() if batch.num_rows else 0
        return pa.table([pa.array(at), pa.array(np.full(len(at), unit, np.int32)), pa.array(total)], names=["__at", "unit", "sum"])

    parts = rows.groupBy("unit", "share").cogroup(trees.groupBy("unit", "share")).applyInArrow(walk, "__at bigint, unit int, sum double")
    added = F.aggregate(F.sort_array(F.collect_list(F.struct("unit", "sum"))), F.lit(0.0), lambda a, x: a + x["sum"])
    whole = parts.groupBy("__at").agg((added / F.lit(float(model.settings.rounds))).alias(out))
    return held.drop(out).join(whole, "__at").drop("__at")


def ensemble(table: BinnedTable, fit: Fit, task_rows: int = TASK_ROWS) -> Ensemble:
    """One fit's trees. They reach the driver: a boosted model has at most rounds x
    2^(depth + 1) nodes; a forest without a depth limit holds about a node a training row
    and tree, so learners keep forests in their table (``forest``)."""
    if table.rows <= task_rows:
        rows = _in_tasks(table, [fit], True).collect()
        rows.sort(key=lambda r: r["tree"])
        made, base = [tree_of(r) for r in rows], rows[0]["base"] if rows else 0.0
    elif _limited(fit):
        every, starts = _boosted(table, [fit])
        made, base = every[0], starts[0]
    else:
        every, starts, _ = _over_cluster(table, [fit], task_rows)
        made, base = every[0], starts[0]
    return Ensemble.of(table, fit, base, made)
