"""Benchmark: run the headline queries on $BENCH_SF_DIR with local[$BENCH_CPUS] and
print one JSON line. Each query is fully executed (``noop`` sink: every row is
produced, nothing is collected to the driver); fits and checkpoints that a query
performs while being built are inside its timing."""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    ("features_lineitem", "b08_build_features_lineitem"),
    ("chrono_rank_lineitem", "w01_chronological_position"),
    ("pearson_lineitem", "e12_pearson_with_target"),
    ("pearson_matrix", "e11_pearson_matrix"),
    ("level_shares", "e09_level_shares"),
    ("quantile_cut", "e14_quantile_cut"),
    ("box_by_weather", "e19_box_count_by_weather"),
    ("histogram", "e20_histogram_count"),
    ("kde", "e22_kde_temp"),
    ("holdout_hourly_mean", "m13_holdout_hourly_mean"),
    ("cv_hourly_mean_one_pass", "m12_cv_hourly_mean"),
    ("fold_boundaries", "c05_fold_boundaries"),
    ("fitted_transforms", "m17_fitted_transforms"),
    ("smearing", "m27_peak_overall"),
    ("permutation_importance", "m20_permutation_importance"),
    ("ridge_holdout", "m06_ridge"),
    ("gbt_holdout", "m10_gradient_boosting"),
    ("dual_target", "m19_dual_target_evaluate"),
    ("stream_hourly", "s01_stream_hourly_demand"),
]


def eventlog_summary(log_dir: str) -> dict:
    """Per query (job group): jobs, stages, summed executor run time (ms) and shuffle
    bytes written, from the Spark event log."""
    out: dict = {}
    stage_group: dict = {}
    paths = [os.path.join(d, f) for d, _, fs in os.walk(log_dir) for f in fs
             if not f.startswith(".") and not f.startswith("appstatus")]
    for path in paths:
        with open(path) as fh:
            for line in fh:
                ev = json.loads(line)
                kind = ev.get("Event")
                if kind == "SparkListenerJobStart":
                    g = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                    if not g:
                        continue
                    d = out.setdefault(g, {"jobs": 0, "stages": 0, "task_ms": 0, "shuffle_write_bytes": 0})
                    d["jobs"] += 1
                    d["stages"] += len(ev.get("Stage IDs", []))
                    for sid in ev.get("Stage IDs", []):
                        stage_group[sid] = g
                elif kind == "SparkListenerTaskEnd":
                    g = stage_group.get(ev.get("Stage ID"))
                    m = ev.get("Task Metrics") or {}
                    if g:
                        out[g]["task_ms"] += int(m.get("Executor Run Time", 0))
                        out[g]["shuffle_write_bytes"] += int((m.get("Shuffle Write Metrics") or {}).get(
                            "Shuffle Bytes Written", 0))
    return out


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = set(sys.argv[1:])
    log_dir, extra = None, {}
    if os.environ.get("BENCH_EVENTLOG"):
        # opt-in: Spark's event log in a fresh scratch folder (no UI, no server)
        import tempfile
        log_dir = tempfile.mkdtemp(prefix="cadence-eventlog-", dir="/tmp")
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": log_dir,
                 "spark.eventLog.compress": "false", "spark.eventLog.rolling.enabled": "false"}
    from cadence.session import get_session
    spark = get_session(f"local[{cpus}]", partitions=cpus, app="cadence-bench", extra_conf=extra)
    from cadence.plans.registry import QUERIES, load_all
    load_all()
    # warm the JVM (class loading, codegen caches) outside the timings
    QUERIES["e04_global_mean"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    times: dict[str, float] = {}
    for key, name in HEADLINE:
        if only and key not in only:
            continue
        spark.sparkContext.setJobGroup(key, key)
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[key] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    result = {"metric": "headline_total_sec", "value": round(sum(times.values()), 3), "unit": "sec",
              "queries": times, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}
    if log_dir:
        spark.stop()
        try:
            result["eventlog"] = {"dir": log_dir, "per_query": eventlog_summary(log_dir)}
        except Exception as exc:  # the timings stand on their own
            result["eventlog"] = {"dir": log_dir, "error": repr(exc)}
    print(json.dumps(result))


if __name__ == "__main__":
    main()
