"""Histogram trees: against plain recursion, both ways of growing, and many fits at once."""
import numpy as np
import pytest
from pyspark.sql import functions as F

from cadence.operators import batchfit as bf
from cadence.operators import trees as tr
from cadence.operators.trees import Settings


def data(n=400, seed=0, levels=(4, 9, 200)):
    rng = np.random.default_rng(seed)
    x = np.stack([rng.integers(0, k, n).astype(float) for k in levels], axis=1)
    y = np.expm1(2 + 0.3 * x[:, 0] + np.sin(x[:, 1]) + 0.002 * x[:, 2] + rng.normal(0, 0.2, n))
    return x, y


def frame(spark, x, y, parts=3):
    rows = [(i, *map(float, r), float(v), 1 + i % 3, 3 if i % 4 == 0 else 0) for i, (r, v) in enumerate(zip(x, y))]
    cols = ", ".join(f"x{k} double" for k in range(x.shape[1]))
    return spark.createDataFrame(rows, f"key bigint, {cols}, count double, t int, e int").repartition(parts)


def table_of(spark, x, y, parts=3):
    df = frame(spark, x, y, parts)
    return bf.binned(df, [f"x{k}" for k in range(x.shape[1])], "count", [bf.View(F.col("t"), F.col("e"))], F.col("key"))


def plain_tree(x, g, w, s, rows, depth=0):
    """The best split by trying every value of every column, and its subtrees."""
    def split(m):
        total, h = (g * w)[m].sum(), w[m].sum()
        best = (1e-10, None)
        for c in range(x.shape[1]):
            for v in np.unique(x[m, c])[:-1]:
                a, b = m[x[m, c] <= v], m[x[m, c] > v]
                ha, hb = w[a].sum(), w[b].sum()
                if min(len(a), len(b)) < s.min_rows or min(ha, hb) < s.min_weight:
                    continue
                p = s.leaf_penalty
                gain = (g * w)[a].sum() ** 2 / (ha + p) + (g * w)[b].sum() ** 2 / (hb + p) - total ** 2 / (h + p)
                if gain > best[0] * (1 + 1e-12):
                    best = (gain, (c, v, a, b))
        return best[1], total / (h + s.leaf_penalty)
    found, value = split(rows)
    if found is None or (s.max_depth is not None and depth >= s.max_depth):
        return value
    c, v, a, b = found
    return c, v, plain_tree(x, g, w, s, a, depth + 1), plain_tree(x, g, w, s, b, depth + 1)


def plain_value(tree, row):
    while isinstance(tree, tuple):
        c, v, a, b = tree
        tree = a if row[c] <= v else b
    return tree


@pytest.mark.parametrize("s", [Settings(4, 0.3, 2), Settings(3, 0.5, 3, leaf_penalty=2.0, min_weight=5),
                               Settings(3, 0.5, 4, row_share=0.7, min_rows=4), Settings(2, bootstrap=True, min_rows=2)])
def test_trees_against_plain_recursion(s):
    x, count = data(150, levels=(4, 9, 60))
    y, keys = np.log1p(count), np.arange(150)
    edges = [np.unique(x[:, c])[:-1] for c in range(3)]
    layout = tr.Layout([len(e) + 1 for e in edges])
    _, base, got = tr.fit(tr.bin_codes(x, edges), y, keys, keys < 120, layout, s)
    want = np.full(150, base)
    for t in range(s.rounds):
        w = tr.weights(keys, s, t)
        grown = plain_tree(x, y if s.bootstrap else y - want, w, s, np.flatnonzero((keys < 120) & (w > 0)))
        want = want + np.array([plain_value(grown, r) for r in x]) * (1 if s.bootstrap else s.learning_rate)
    assert np.allclose(got, want, atol=1e-9)
    assert s.bootstrap or base == y[:120].mean()


FITS = [bf.Fit(("x0", "x1", "x2"), Settings(5, 0.3, 3), fold=2), bf.Fit(("x1", "x2"), Settings(4, 0.5, 4, row_share=0.6, leaf_penalty=1.0), fold=3),
        bf.Fit(("x0", "x2"), Settings(3, 0.5, 2, tree_columns=0.5, node_columns="sqrt"), fold=3),
        bf.Fit(("x0", "x1", "x2"), Settings(6, bootstrap=True, min_rows=2), fold=3)]


def collected(df):
    return {(r["fit"], r["key"]): (r["y"], r["log_pred"]) for r in df.collect()}


def test_tasks_and_cluster_grow_the_same_trees(spark, monkeypatch):
    monkeypatch.setattr(bf, "REFRESH", 2)
    x, y = data()
    table = table_of(spark, x, y)
    assert table.rows == 400
    a, b = collected(bf.scores(table, FITS)), collected(bf.scores(table, FITS, task_rows=40))
    # every fit of fold 3 judges each fourth row; no row validates fold 2
    assert {k[0] for k in a} == {1, 2, 3} and len(a) == 300
    assert a.keys() == b.keys() and all(np.allclose(a[k], b[k], atol=1e-9) for k in a)
    other = collected(bf.scores(table_of(spark, x, y, 1), FITS))
    assert all(np.allclose(a[k], other[k], atol=1e-9) for k in a)


def test_ensembles_score_raw_columns(spark):
    x, y = data()
    table = table_of(spark, x, y)
    judged = collected(bf.scores(table, FITS))
    for i, f in enumerate(FITS):
        for rows in (bf.TASK_ROWS, 40):
            made = bf.ensemble(table, f, rows)
            values = x[:, [int(c[1]) for c in f.columns]]
            got = made.log_score(values)
            assert len(made.trees) == f.settings.rounds
            assert all(abs(judged[k][1] - got[k[1]]) < 1e-9 for k in judged if k[0] == i)


def test_forest_is_deeper_than_thirty_levels():
    n = 64
    x = np.arange(n, dtype=float)[:, None]
    y = 3.0 ** np.arange(n)                      # each best split takes the largest value off
    layout = tr.Layout([n])
    tree, leaf = tr.grow(tr.bin_codes(x, [x[:-1, 0]]).astype(np.int64), y, np.ones(n), layout, Settings(1, bootstrap=True), 0)
    depth = np.zeros(len(tree.column), int)
    for k in np.flatnonzero(tree.column >= 0):
        depth[[tree.left[k], tree.left[k] + 1]] = depth[k] + 1
    assert depth.max() > 30 and np.allclose(tree.value[leaf][-5:], y[-5:])


def test_edges_missing_values_and_empty_tables(spark):
    df = spark.createDataFrame([(float(i % 5), float(i), float("nan") if i % 2 else None, 1.0) for i in range(1000)], "a double, b double, c double, d double")
    few, many, none, one = bf.bin_edges(df, ["a", "b", "c", "d"])
    assert few.tolist() == [0.5, 1.5, 2.5, 3.5] and 100 < len(many) < bf.MAX_BINS and len(none) == len(one) == 0
    assert tr.bin_codes(np.array([[2.5], [2.6], [np.nan], [-1.0]]), [few]).ravel().tolist() == [2, 3, 4, 0]
    empty = bf.binned(df.limit(0).withColumn("count", F.lit(1.0)), ["a", "b"], "count", [bf.View(F.lit(1), F.lit(0))], F.lit(1))
    assert empty.rows == 0 and bf.scores(empty, [bf.Fit(("a",), Settings(2, 0.1, 2))]).count() == 0


def test_histograms_in_stretches_are_the_same(monkeypatch):
    x, y = data(300)
    edges = [np.unique(x[:, c])[:-1] for c in range(3)]
    args = (tr.bin_codes(x, edges), np.log1p(y), np.arange(300), np.ones(300, bool), tr.Layout([len(e) + 1 for e in edges]), Settings(2, bootstrap=True))
    whole = tr.fit(*args)[2]
    monkeypatch.setattr(tr, "CELLS", 500)
    assert (tr.fit(*args)[2] == whole).all()


def test_levels_of_few_rows_are_sorted_not_counted(monkeypatch):
    rng = np.random.default_rng(5)
    layout = tr.Layout([40, 3, 128])
    codes = np.stack([rng.integers(0, k, 200) for k in (40, 3, 128)], axis=1) + layout.starts
    node, g, w = rng.integers(0, 50, 200), rng.normal(size=200), rng.integers(1, 4, 200).astype(float)
    hist = tr.histogram(np.asfortranarray(codes), node, 50, g, w, layout)
    used, sums = tr._cells(codes, node, g, w, layout.total)
    assert used.tolist() == np.flatnonzero(hist[0]).tolist() and (sums == hist.reshape(3, -1)[:, used]).all()
    assert len(tr._cells(codes[:0], node[:0], g[:0], None, layout.total)[0]) == 0
    # a forest's deep levels are sorted
    sorted_levels = []
    cells = tr._cells
    monkeypatch.setattr(tr, "_cells", lambda *given: sorted_levels.append(len(given[1])) or cells(*given))
    tr.fit((codes - layout.starts).astype(np.uint8), g, np.arange(200), np.ones(200, bool), layout, Settings(2, bootstrap=True))
    assert len(sorted_levels) > 2


def test_only_cuts_that_leave_enough_rows_are_scored(monkeypatch):
    rng = np.random.default_rng(11)
    layout = tr.Layout([40, 3, 128])
    codes = np.stack([rng.integers(0, k, 300) for k in (40, 3, 128)], axis=1) + layout.starts
    node, w = rng.integers(0, 60, 300), rng.integers(1, 4, 300).astype(float)
    g = rng.integers(-9, 9, 300) * w                # sums without rounding
    hist = tr.histogram(np.asfortranarray(codes), node, 60, g, w, layout)
    left = sum(int(((n := np.cumsum(hist[0, k, a:b])) >= 2).astype(int) @ ((n[-1] - n >= 2) & (hist[0, k, a:b] > 0)))
               for k in range(60) for a, b in zip(layout.starts, layout.ends))
    s = Settings(1, bootstrap=True, min_rows=2)
    mask = rng.random((60, 3)) < 0.7
    want = [tr._pick_dense(hist.copy(), layout, s, m) for m in (None, mask)]
    scored, gain = [], tr._gain
    monkeypatch.setattr(tr, "_gain", lambda sums, *given: scored.append(sums[0].size) or gain(sums, *given))
    made = [tr.pick(hist, layout, s, m) for m in (None, mask)]
    assert scored[0] == left < np.count_nonzero(hist[0]) and scored[1] < left
    # the same from two arrays in which the nodes stand in another order
    order = rng.permutation(60)
    slot = np.argsort(order)
    sides = (hist[:, order[:20]], hist[:, order[20:]])
    made += [tr._pick_sides(sides, slot, layout, s, m) for m in (None, mask)]
    for got, right in zip(made, want * 2):
        assert all((getattr(got, f) == getattr(right, f)).all() for f in ("column", "cut", "rows", "g", "h")) and np.allclose(got.gain, right.gain)
    some = np.array([7, 3, 59])
    assert (tr.Sides(sides, slot).of(some) == hist[:, some]).all()
    nothing = tr.pick(np.zeros((3, 4, layout.total)), layout, s)
    assert (nothing.column == -1).all() and not nothing.rows.any()


def test_forest_trees_stay_in_their_table(spark, monkeypatch, tmp_path):
    from cadence.operators import explain
    from cadence.operators.learners import ForestFitted, ForestLog
    from cadence.sources import io
    monkeypatch.setattr(bf, "TREES_A_TASK", 2)
    x, y = data(120)
    df = spark.createDataFrame([(*map(float, r), float(c), i // 2) for i, (r, c) in enumerate(zip(x, y))], "x0 double, x1 double, x2 double, count double, twice int")
    est = ForestLog(["x0", "x1", "x2"], n_estimators=5, min_samples_leaf=2)
    key = F.xxhash64("x0", "x1", "x2", "count")
    table = bf.binned(df, est.features, "count", [bf.View(F.lit(1), F.lit(0))], key)
    plain = bf.ensemble(table, bf.Fit(tuple(est.features), est.settings()))
    # the trees never reach the driver as such
    monkeypatch.setattr(bf, "ensemble", None)
    fitted = est.fit(df, "count")
    assert isinstance(fitted, ForestFitted) and fitted.model.trees.count() == 5
    loaded = io.load_fitted(spark, io.save_fitted(fitted, str(tmp_path / "forest")))
    assert isinstance(loaded, ForestFitted)
    want = sorted(zip(x.tolist(), plain.log_score(x[:, :3].astype(float)).tolist()))
    for shares in (bf.TASK_ROWS, 50):
        monkeypatch.setattr(bf, "TASK_ROWS", shares)
        both = loaded.predict(fitted.predict(df, out="a"), out="b")
        assert both.columns == [*df.columns, "a", "log_pred", "b"] or set(both.columns) == {*df.columns, "a", "b", "log_pred"}
        got = both.collect()
        assert all(r["a"] == r["b"] for r in got) and sorted(r["twice"] for r in got) == sorted(i // 2 for i in range(120))
        have = sorted(([r["x0"], r["x1"], r["x2"]], r["log_pred"]) for r in got)
        assert all(a == [*map(float, c)] and abs(b - d) < 1e-12 for (a, b), (c, d) in zip(have, want))
    imp = {r["feature"]: r["importance"] for r in explain.split_importance(fitted, est.features, spark, "random_forest").collect()}
    shares = [np.bincount(t.column[t.column >= 0], t.gain[t.column >= 0], 3) for t in plain.trees]
    assert np.allclose([imp[c] for c in est.features], sum(s / s.sum() for s in shares) / 5)
    empty = fitted.predict(df.limit(0))
    assert empty.count() == 0 and "pred" in empty.columns


@pytest.mark.parametrize("depth", [None, 3])
def test_forests_of_many_rows_stay_in_their_table(spark, monkeypatch, tmp_path, depth):
    """Beyond TASK_ROWS too, trees are put together in tasks and never reach the driver."""
    from cadence.operators import explain
    from cadence.operators.learners import ForestFitted, ForestLog
    from cadence.sources import io
    x, y = data(120)
    df = spark.createDataFrame([(*map(float, r), float(c)) for r, c in zip(x, y)], "x0 double, x1 double, x2 double, count double")
    est = ForestLog(["x0", "x1", "x2"], n_estimators=5, min_samples_leaf=2, max_depth=depth)
    want = est.fit(df, "count")
    monkeypatch.setattr(bf, "TASK_ROWS", 30)
    monkeypatch.setattr(bf, "FOREST_STEP", 2)
    monkeypatch.setattr(bf, "NODES_A_TASK", 40)
    monkeypatch.setattr(bf, "SHARE", 2)
    monkeypatch.setattr(bf, "ensemble", None)
    fitted = est.fit(df, "count")
    assert isinstance(fitted, ForestFitted)
    got, plain = ([bf.tree_of(r) for r in sorted(m.model.trees.collect(), key=lambda r: r["tree"])] for m in (fitted, want))
    assert len(got) == len(plain) == 5
    for a, b in zip(got, plain):
        assert sorted(a.value[a.column < 0].round(9)) == sorted(b.value[b.column < 0].round(9)) and np.isclose(a.gain.sum(), b.gain.sum())
    loaded = io.load_fitted(spark, io.save_fitted(fitted, str(tmp_path / "forest")))
    for model in (fitted, loaded):
        rows = model.predict(want.predict(df, out="a"), out="b").collect()
        assert len(rows) == 120 and all(abs(r["a"] - r["b"]) < 1e-9 for r in rows)
    imp = [{r["feature"]: r["importance"] for r in explain.split_importance(m, est.features, spark, "random_forest").collect()} for m in (fitted, want)]
    assert all(np.isclose(imp[0][c], imp[1][c]) for c in est.features)


def test_bundles_count_what_columns_count(monkeypatch):
    rng = np.random.default_rng(7)
    hour, far = rng.integers(0, 24, 3000), rng.integers(0, 100, 3000)
    codes = np.stack([hour, hour * 5 % 24, far, hour // 12, far // 30, np.zeros(3000, int)], axis=1).astype(np.uint8)
    layout = tr.Layout([24, 24, 100, 2, 4, 1])
    node, g = rng.integers(0, 3, 3000), rng.normal(size=3000)
    numbered = np.asfortranarray(codes.astype(np.int64) + layout.starts)
    for apart in (tr.APART, 30):                     # 30: the bundle of 100 codes is taken apart
        monkeypatch.setattr(tr, "APART", apart)
        bundles = tr.Bundles.of(codes, layout)
        assert sorted(c for b in bundles.groups for c in b) == list(range(6)) and len(bundles.groups) < 6
        packed = bundles.packed(codes)
        for w in (None, rng.integers(1, 4, 3000).astype(float)):
            assert np.allclose(bundles.histogram(packed, node, 3, g, w), tr.histogram(numbered, node, 3, g, w, layout), atol=1e-9)
        tree, leaf = tr.grow(numbered, g, np.ones(3000), layout, Settings(1, max_depth=4), 0)
        assert (tr.Steps(bundles, tree, range(6), layout.starts).leaves(packed) == leaf).all() and (tr.leaves(numbered, tree) == leaf).all()
        monkeypatch.setattr(tr, "SMALL_TREE", 0)
        assert (tr.leaves(numbered, tree) == leaf).all()
    none = tr.Bundles.of(codes[:0], layout)
    assert not none.histogram(none.packed(codes[:0]), node[:0], 1, g[:0], None).any()


def test_boosting_over_the_cluster_takes_a_job_a_level(spark, monkeypatch):
    from pyspark import RDD
    monkeypatch.setattr(bf, "REFRESH", 2)
    monkeypatch.setattr(bf, "CHECKPOINT", 4)
    monkeypatch.setattr(bf, "HELD", 1)              # a fit at a time
    x, y = data()
    table = table_of(spark, x, y)
    jobs = []
    plain = RDD.treeReduce
    monkeypatch.setattr(RDD, "treeReduce", lambda self, *a, **k: jobs.append(1) or plain(self, *a, **k))
    made = bf.ensemble(table, FITS[0], 40)
    assert len(jobs) == 5 * 3                       # rounds x depth, no job for the leaves
    want = bf.ensemble(table, FITS[0])
    assert abs(made.base - want.base) < 1e-12
    for a, b in zip(made.trees, want.trees):
        assert (a.column == b.column).all() and (a.cut == b.cut).all() and np.allclose(a.value, b.value, atol=1e-9)
    whole, parts = collected(bf.scores(table, FITS)), collected(bf.scores(table, FITS, task_rows=40))
    assert whole.keys() == parts.keys() and all(np.allclose(whole[k], parts[k], atol=1e-9) for k in whole)


def test_a_guessed_root_split_saves_a_job(spark, monkeypatch):
    from pyspark import RDD
    monkeypatch.setattr(bf, "REFRESH", 2)
    monkeypatch.setattr(bf, "GUESS_ROWS", 0)
    x, y = data(3000)
    table = table_of(spark, x, y)
    jobs = []
    plain = RDD.treeReduce
    monkeypatch.setattr(RDD, "treeReduce", lambda self, *a, **k: jobs.append(1) or plain(self, *a, **k))

    def jobs_of(fit):
        jobs.clear()
        made, want = bf.ensemble(table, fit, 40), bf.ensemble(table, fit)
        assert len(made.trees) == fit.settings.rounds
        for a, b in zip(made.trees, want.trees):
            assert (a.column == b.column).all() and (a.cut == b.cut).all() and np.allclose(a.value, b.value, atol=1e-9)
        return len(jobs)
    columns = ("x0", "x1", "x2")
    assert 12 < jobs_of(bf.Fit(columns, Settings(6, 0.1, 3), fold=3)) < 18     # rounds x 2 and one for the first root
    assert jobs_of(bf.Fit(columns, Settings(4, 0.1, 1), fold=3)) == 4
    assert jobs_of(bf.Fit(columns, Settings(5, 0.1, 2, row_share=0.9), fold=3)) <= 10
    # wrong guesses cost no more than none, and change nothing
    monkeypatch.setattr(tr, "likely", lambda hist, layout, *rest: [(1, int(layout.starts[1]) + 7), (2, int(layout.starts[2]) + 1)])
    assert jobs_of(bf.Fit(columns, Settings(4, 0.1, 3, row_share=0.9), fold=3)) == 12


def test_guesses_change_no_scores(spark, monkeypatch):
    monkeypatch.setattr(bf, "GUESS_ROWS", 0)
    x, y = data()
    table = table_of(spark, x, y)
    whole, parts = collected(bf.scores(table, FITS)), collected(bf.scores(table, FITS, task_rows=40))
    assert whole.keys() == parts.keys() and all(np.allclose(whole[k], parts[k], atol=1e-9) for k in whole)


def test_likely_splits_begin_with_the_picked_one():
    rng = np.random.default_rng(3)
    layout = tr.Layout([5, 1, 30])
    codes = np.asfortranarray(np.stack([rng.integers(0, k, 400) for k in (5, 1, 30)], axis=1) + layout.starts)
    hist = tr.histogram(codes, np.zeros(400, int), 1, rng.normal(size=400), None, layout)
    s = Settings(1, max_depth=3)
    p, got = tr.pick(hist, layout, s), tr.likely(hist, layout, s, None, 6)
    assert got[0] == (p.column[0], p.cut[0]) and len(set(got)) == 6 and all(layout.column[k] == c for c, k in got)
    assert tr.likely(hist, layout, s, np.array([[False, False, True]]), 6)[0][0] == 2
    assert tr.likely(np.zeros_like(hist), layout, s, None, 6) == [] and tr.likely(np.zeros((2, 1, 0)), tr.Layout([]), s, None, 6) == []
