"""The README's workflow snippet runs as written (paths pointed at scratch copies of
the test tables, ridge in place of boosting for speed)."""
import os

from cadence.session import scratch_path
from cadence.sources import io
from cadence.sources.fixtures import demand_rows, labeled, unlabeled

from .conftest import SF001

README = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "README.md")


def test_readme_workflow_runs(spark):
    src = open(README).read()
    code = src.split("## The four workflows")[1].split("```python")[1].split("```")[0]
    base = scratch_path(spark, "readme")
    io.write_raw_csv(labeled(demand_rows(spark, SF001)), base + "/train.csv")
    io.write_raw_csv(unlabeled(demand_rows(spark, SF001), drop=("casual", "registered", "count")),
                     base + "/test.csv", io.UNLABELED_SCHEMA)
    code = code.replace("hdfs:///demand", base).replace(
        'get_model("gradient_boosting", cfg.params["gradient_boosting"])', 'get_model("ridge", cfg.params["ridge"])')
    scope: dict = {}
    exec(code, scope)
    assert scope["per_fold"].count() == 5
    assert spark.read.csv(base + "/submission", header=True).columns == ["datetime", "count"]
