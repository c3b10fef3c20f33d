"""Profile reports against their single-machine definitions."""
import numpy as np
import pandas as pd
import pytest

from cadence.operators import profile as pr


@pytest.fixture(scope="module")
def frame(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": rng.integers(1, 4, 500), "x": np.round(rng.gamma(2.0, 30.0, 500), 2),
                        "z": rng.normal(size=500)})
    pdf.loc[:5, "x"] = 400.0                                # outliers
    return pdf, spark.createDataFrame(pdf)


def test_histogram_equals_numpy(frame):
    pdf, df = frame
    cnt, edges = np.histogram(pdf["x"], bins=60)
    got = {r["bin"]: (r["n"], r["lo"], r["hi"]) for r in pr.histogram(df, "x", 60).collect()}
    for k, c in enumerate(cnt):
        if c:
            assert got[k][0] == c and got[k][1] == pytest.approx(edges[k]) and got[k][2] == pytest.approx(edges[k + 1])
    assert sum(n for n, _, _ in got.values()) == len(pdf)


def test_adjusted_skew_equals_pandas(frame, spark):
    pdf, df = frame
    got = df.agg(pr.adjusted_skew(df["x"]).alias("s")).first()["s"]
    assert got == pytest.approx(pdf["x"].skew())


def test_five_number_summary_equals_pandas(frame):
    pdf, df = frame
    got = {r["g"]: r for r in pr.five_number_summary(df, "g", "x").collect()}
    for g, sub in pdf.groupby("g"):
        q1, q3 = sub["x"].quantile(0.25), sub["x"].quantile(0.75)
        lo, hi = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
        inside = sub["x"][(sub["x"] >= lo) & (sub["x"] <= hi)]
        r = got[g]
        assert r["median"] == pytest.approx(sub["x"].median()) and r["q1"] == pytest.approx(q1)
        assert r["n_outliers"] == int(((sub["x"] < lo) | (sub["x"] > hi)).sum())
        assert r["whisker_hi"] == pytest.approx(inside.max())


def test_pearson_matrix_equals_pandas(frame):
    pdf, df = frame
    got = {(r["col_a"], r["col_b"]): r["r"] for r in pr.pearson_matrix(df, ["x", "z", "g"]).collect()}
    ref = pdf[["x", "z", "g"]].corr()
    for a in ["x", "z", "g"]:
        for b in ["x", "z", "g"]:
            assert got[(a, b)] == pytest.approx(ref.loc[a, b])


def test_constant_column_correlation_is_null(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0), (1.0, 5.0)], "c double, y double")
    assert pr.pearson_with_target(df, ["c"], "y").first()["r"] is None


def test_level_shares_absent_level_is_zero(spark):
    a = spark.createDataFrame([(1,), (1,), (2,)], "w int")
    b = spark.createDataFrame([(1,), (3,)], "w int")
    got = {r["level"]: (r["train_share"], r["test_share"]) for r in pr.level_shares(a, b, ["w"]).collect()}
    assert got == {"1": (pytest.approx(2 / 3), 0.5), "2": (pytest.approx(1 / 3), 0.0), "3": (0.0, 0.5)}


def test_binned_kde_close_to_exact(frame):
    pdf, df = frame
    x = pdf["z"].to_numpy()
    got = pr.kde_binned(df, "z").toPandas().sort_values("point")
    h = x.std(ddof=1) * len(x) ** (-1 / 5)
    grid = got["x"].to_numpy()
    exact = np.exp(-0.5 * ((grid[:, None] - x[None, :]) / h) ** 2).sum(1) / (np.sqrt(2 * np.pi) * h * len(x))
    assert np.max(np.abs(got["density"].to_numpy() - exact)) < 0.01 * exact.max()
    assert np.trapezoid(got["density"], grid) == pytest.approx(1.0, abs=0.01)
