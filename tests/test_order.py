"""Distributed exact positions and quantiles against single-machine references."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cadence.operators.order import cut_expr, exact_quantiles, ordered_positions, quantile_edges


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(7)
    n = 3000
    g = rng.choice([0, 1, 2], size=n, p=[0.6, 0.3, 0.1])          # one hot group
    v = np.round(rng.normal(size=n), 1)                           # many ties
    rows = [(int(i), int(a), float(b)) for i, a, b in zip(range(n), g, v)]
    return spark.createDataFrame(rows, "id long, g int, v double").repartition(5)


def test_global_positions_equal_row_number(spark, data):
    got = ordered_positions(data, ["v", "id"], rank_col="r").select("id", "r")
    ref = data.select("id", (F.row_number().over(Window.orderBy("v", "id")) - 1).alias("r0"))
    assert got.join(ref, "id").filter(F.col("r") != F.col("r0")).count() == 0


def test_group_positions_equal_row_number(spark, data):
    got = ordered_positions(data, ["v", "id"], ["g"], rank_col="r", size_col="n").select("id", "r", "n")
    w = Window.partitionBy("g").orderBy("v", "id")
    ref = data.select("id", (F.row_number().over(w) - 1).alias("r0"), F.count("*").over(Window.partitionBy("g")).alias("n0"))
    bad = got.join(ref, "id").filter((F.col("r") != F.col("r0")) | (F.col("n") != F.col("n0"))).count()
    assert bad == 0


def test_rows_never_pass_a_single_partition_exchange(spark, data):
    """The only single-partition exchange carries the per-partition count table
    (one row per partition), never the rows themselves."""
    plan = ordered_positions(data, ["v", "id"], rank_col="r")._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    for k, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            assert "HashAggregate(keys=[__op_pid" in lines[k + 1], lines[k + 1]


def test_exact_quantiles_match_numpy(spark, data):
    probs = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
    got = {(r["g"], r["p"]): r["q"] for r in exact_quantiles(data, "v", probs, ["g"]).collect()}
    pdf = data.toPandas()
    for g, sub in pdf.groupby("g"):
        for p in probs:
            assert got[(g, p)] == pytest.approx(np.percentile(sub["v"], p * 100), abs=1e-12)


def test_qcut_semantics_with_ties(spark):
    vals = [1.0] * 8 + [2.0, 3.0]                 # five bins collapse
    df = spark.createDataFrame([(v,) for v in vals], "v double")
    edges = quantile_edges(df, "v", 5)
    ref = pd.qcut(pd.Series(vals), 5, duplicates="drop")
    assert edges == pytest.approx(list(ref.cat.categories.right.insert(0, min(vals))))
    got = [r["b"]["idx"] for r in df.select(cut_expr(F.col("v"), edges).alias("b")).collect()]
    assert got == [c + 1 for c in ref.cat.codes.tolist()]
