"""Registered queries against their DuckDB oracles on the smallest tables, and at
two partition counts (results must not depend on partitioning)."""
import pytest

from cadence.plans.check import compare, duckdb_conn, frame_hash
from cadence.plans.registry import ORACLES, QUERIES, load_all

from .conftest import SF001

load_all()


@pytest.fixture(scope="module")
def con():
    return duckdb_conn(SF001)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, con, name):
    res = compare(name, spark, SF001, con)
    assert res["status"] == "ok", res


@pytest.mark.parametrize("name", ["c03_chronological_order", "e19_box_count_by_weather", "m12_cv_hourly_mean",
                                  "e14_quantile_cut", "e11_pearson_matrix", "e09_level_shares",
                                  "m13_holdout_hourly_mean", "e16_error_by_demand_fifth", "m27_peak_overall",
                                  "d06_fold_membership", "e20_histogram_count"])
def test_partition_count_invariance(spark, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = frame_hash(QUERIES[name](spark, SF001).toPandas())
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        b = frame_hash(QUERIES[name](spark, SF001).toPandas())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b


def test_every_query_has_a_known_section():
    assert all(q[0] in "abcdefmsw" for q in QUERIES)
