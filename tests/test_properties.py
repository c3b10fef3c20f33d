"""Randomized properties of the distributed rank and quantile operators: for any
data, skew and partition count they equal the single-machine answer."""
import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from cadence.operators.order import exact_quantiles, ordered_positions


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(n=st.integers(1, 400), groups=st.integers(1, 4), hot=st.floats(0.0, 0.9),
       parts=st.integers(1, 7), seed=st.integers(0, 10_000))
def test_positions_match_sorted_order(spark, n, groups, hot, parts, seed):
    rng = np.random.default_rng(seed)
    g = np.where(rng.random(n) < hot, 0, rng.integers(0, groups, n))      # a hot group
    v = rng.integers(0, 5, n).astype(float)                               # heavy ties
    rows = [(int(i), int(a), float(b)) for i, (a, b) in enumerate(zip(g, v))]
    df = spark.createDataFrame(rows, "id long, g int, v double").repartition(parts)
    got = {r["id"]: (r["r"], r["n"]) for r in
           ordered_positions(df, ["v", "id"], ["g"], rank_col="r", size_col="n", num_partitions=parts).collect()}
    for grp in set(g.tolist()):
        idx = [i for i in range(n) if g[i] == grp]
        order = sorted(idx, key=lambda i: (v[i], i))
        for pos, i in enumerate(order):
            assert got[i] == (pos, len(idx))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(n=st.integers(1, 300), parts=st.integers(1, 6), seed=st.integers(0, 10_000))
def test_quantiles_match_numpy(spark, n, parts, seed):
    rng = np.random.default_rng(seed)
    v = np.round(rng.normal(size=n) * 10, 1)
    df = spark.createDataFrame([(float(x),) for x in v], "v double").repartition(parts)
    probs = [0.0, 0.2, 0.5, 0.8, 1.0]
    got = {r["p"]: r["q"] for r in exact_quantiles(df, "v", probs, num_partitions=parts).collect()}
    for p in probs:
        assert abs(got[p] - np.percentile(v, p * 100)) < 1e-9


def test_empty_input(spark):
    df = spark.createDataFrame([], "id long, v double")
    assert ordered_positions(df, ["v", "id"]).count() == 0
    assert exact_quantiles(df, "v", [0.5]).count() == 0
