"""Physical-plan properties: pushdown, pruning, no Python on row paths."""
from cadence.functions import features as fx
from cadence.plans.registry import QUERIES, load_all
from cadence.sources.fixtures import demand_rows, labeled

from .conftest import SF001

load_all()


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_feature_projection_prunes_and_pushes(spark):
    df = fx.build_features(labeled(demand_rows(spark, SF001))).select("row_id", "hour_sin")
    plan = _plan(df)
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
    assert "user_id" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_no_python_udf_in_registered_row_paths(spark):
    for name in ("b08_build_features", "e11_pearson_matrix", "m13_holdout_hourly_mean", "e16_error_by_demand_fifth"):
        plan = _plan(QUERIES[name](spark, SF001))
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_holdout_hour_table_is_broadcast(spark):
    plan = _plan(QUERIES["m02_hourly_mean_baseline"](spark, SF001))
    assert "BroadcastHashJoin" in plan or "BroadcastExchange" in plan


def test_day_split_reaches_parquet_scan(spark, tmp_path):
    from cadence.operators.splits import split_holdout
    from cadence.sources import io
    path = io.write_processed(labeled(demand_rows(spark, SF001)), str(tmp_path / "p"))
    _, hold = split_holdout(io.read_processed(spark, path))
    plan = _plan(hold)
    assert "GreaterThanOrEqual(day,16)" in plan.replace(" ", "")


def test_sizing_for_100tb():
    from cadence.session import sizing_conf
    conf = sizing_conf(100 * 2 ** 40, 8000)
    assert int(conf["spark.sql.shuffle.partitions"]) == 102400
    assert int(sizing_conf(10 * 2 ** 20, 8)["spark.sql.shuffle.partitions"]) == 16
