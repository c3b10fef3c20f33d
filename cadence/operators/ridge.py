"""Many ridge fits from one scan (M6, M7, M12, M22-M26): Gram matrices that add up.

One pass gives X'X, X'y and the row count of every training segment of every view (see
``batchfit.View``) for all columns that any fit reads. Segments add up: the Gram matrix of
a fold is the sum over the segments that it trains on, that of an arm is a sub-matrix,
centring and scaling are matrix algebra, and a level that a fold has not seen is a zero
column whose weight is zero. So every fold, gap and arm is a solve of a few dozen
unknowns on the driver, and all predictions are one more scan.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cadence.operators.batchfit import SCORES, View
from cadence.operators.learners import LinearFitted, LinearSpec


@dataclass(frozen=True)
class RidgeFit:
    """``columns`` renames columns of the spec for this fit (a version fitted in its fold)."""

    spec: LinearSpec
    alpha: float = 1.0
    view: int = 0
    fold: int = 1
    columns: tuple[tuple[str, str], ...] = ()

    def named(self, column: str) -> str:
        return dict(self.columns).get(column, column)


def _levels_of(df: DataFrame, cols: Sequence[str]) -> dict[str, list[float]]:
    """The levels of categorical columns (few by their nature; over 10,000 is an error)."""
    from cadence.operators.fitted import OneHotLevels
    return {c: [float(v) for v in vs] for c, vs in OneHotLevels(cols).fit(df).levels_.items()}


class GramTable:
    """Sums of outer products by view and training segment, over [1, columns, label]."""

    def __init__(self, df: DataFrame, fits: Sequence[RidgeFit], label: str, views: Sequence[View], key: Column):
        plain = dict.fromkeys(f.named(c) for f in fits for c in (*f.spec.numeric, *f.spec.passthrough))
        hot = _levels_of(df, list(dict.fromkeys(c for f in fits for c in f.spec.one_hot)))
        self.place = {c: k for k, c in enumerate(plain)}
        self.hot, self.levels, self.width = {}, hot, len(plain)
        for c, levels in hot.items():
            self.hot[c] = list(range(self.width, self.width + len(levels)))
            self.width += len(levels)
        folds = [c for v in views for c in (v.train_from, v.validates)]
        flat = [F.coalesce(c.cast("int"), F.lit(0)).alias(f"__v{k}") for k, c in enumerate(folds)]
        self.rows = df.select(key.cast("bigint").alias("__key"), F.log1p(F.col(label).cast("double")).alias("__y"), *flat,
                              *[F.col(f"`{c}`").cast("double").alias(f"__c{k}") for k, c in enumerate(plain)],
                              *[F.col(f"`{c}`").cast("double").alias(f"__h{k}") for k, c in enumerate(hot)]).filter(
            F.col("__y").isNotNull() & ~F.isnan("__y"))
        self.views = n_views = len(views)
        n_plain, levels = len(plain), list(hot.values())

        def unpack(batch: pa.RecordBatch):
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            folds = np.stack(cols[2:2 + 2 * n_views], axis=1).reshape(-1, n_views, 2)
            own = cols[2 + 2 * n_views:2 + 2 * n_views + n_plain]
            own += [(c == v) for c, vs in zip(cols[2 + 2 * n_views + n_plain:], levels) for v in vs]
            x = np.stack(own, axis=1).astype(np.float64) if own else np.zeros((len(cols[0]), 0))
            return cols[0], cols[1].astype(np.float64), folds, x
        self.unpack = unpack
        self.sums = self._scan()

    def _scan(self) -> dict[tuple[int, int], np.ndarray]:
        unpack, n_views, size = self.unpack, self.views, self.width + 2
        upper = np.triu_indices(size)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: dict[tuple[int, int], np.ndarray] = {}
            for batch in batches:
                _, y, folds, x = unpack(batch)
                z = np.concatenate([np.ones((len(y), 1)), x, y[:, None]], axis=1)
                for v in range(n_views):
                    for s in np.unique(folds[:, v, 0]).tolist():
                        part = z[folds[:, v, 0] == s]
                        held[v, s] = held.get((v, s), 0) + part.T @ part
            for (v, s), m in held.items():
                yield pa.RecordBatch.from_arrays([pa.array([v], pa.int32()), pa.array([s], pa.int32()), pa.array([m[upper]], pa.list_(pa.float64()))],
                                                 names=["view", "segment", "m"])

        parts = self.rows.mapInArrow(run, "view int, segment int, m array<double>").select("view", "segment", F.posexplode("m").alias("at", "x"))
        out: dict[tuple[int, int], np.ndarray] = {}
        cells = parts.groupBy("view", "segment", "at").agg(F.sum("x").alias("x"))
        whole = cells.groupBy("view", "segment").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("m"))
        for r in whole.collect():
            m = np.zeros((size, size))
            m[upper] = [e["x"] for e in r["m"]]
            out[r["view"], r["segment"]] = m + np.triu(m, 1).T
        return out

    def solve(self, fit: RidgeFit) -> tuple[float, np.ndarray]:
        """Intercept and weights on the raw columns of the table (0 where not read)."""
        names = [fit.named(c) for c in (*fit.spec.numeric, *fit.spec.passthrough)]
        own = [self.place[c] for c in names] + [k for c in fit.spec.one_hot for k in self.hot[c]]
        gram = sum((m for (v, s), m in self.sums.items() if v == fit.view and 0 < s <= fit.fold), np.zeros((self.width + 2,) * 2))
        n = gram[0, 0]
        weights = np.zeros(self.width)
        if not n:
            return 0.0, weights
        at = np.array([1 + k for k in own] + [self.width + 1])
        mean = gram[0, at] / n
        c = gram[np.ix_(at, at)] - n * np.outer(mean, mean)
        scale = np.ones(len(own))
        spread = np.sqrt(np.maximum(np.diag(c)[:len(fit.spec.numeric)], 0) / n)
        scale[:len(spread)] = np.where(spread > 1e-12 * np.maximum(1, np.abs(mean[:len(spread)])), spread, 1.0)
        a = c[:-1, :-1] / np.outer(scale, scale) + fit.alpha * np.eye(len(own))
        w = np.linalg.lstsq(a, c[:-1, -1] / scale, rcond=None)[0] if not fit.alpha else np.linalg.solve(a, c[:-1, -1] / scale)
        weights[own] = w / scale
        return float(mean[-1] - mean[:-1] @ (w / scale)), weights

    def fitted(self, fit: RidgeFit) -> LinearFitted:
        b, w = self.solve(fit)
        names = {fit.named(c): float(w[self.place[fit.named(c)]]) for c in (*fit.spec.numeric, *fit.spec.passthrough)}
        return LinearFitted(b, names, {c: dict(zip(self.levels[c], w[self.hot[c]].tolist())) for c in fit.spec.one_hot})

    def scores(self, fits: Sequence[RidgeFit]) -> DataFrame:
        """fit, key, y (log1p of the label) and log_pred of the rows that each fit validates."""
        solved = [self.solve(f) for f in fits]
        unpack, wanted = self.unpack, [(f.view, f.fold) for f in fits]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keys, y, folds, x = unpack(batch)
                for i, ((view, fold), (b, w)) in enumerate(zip(wanted, solved)):
                    m = folds[:, view, 1] == fold
                    if m.any():
                        used = w != 0          # a column that the fit doesn't read may be missing
                        yield pa.RecordBatch.from_arrays([pa.array(np.full(m.sum(), i, np.int32)), pa.array(keys[m]), pa.array(y[m]),
                                                          pa.array(b + x[m][:, used] @ w[used])], names=["fit", "key", "y", "log_pred"])
        return self.rows.mapInArrow(run, SCORES)
