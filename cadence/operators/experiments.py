"""Experiment harnesses (M22-M26) and decision gates.

Every fit of a search or sweep (arm x model x draw x fold, and the holdout) is declared
first; then all tree fits run together on one binned table (``batchfit``) and all ridge
fits come from one scan (``ridge``). Scores of every fit's validation rows are one
DataFrame, its metrics one aggregation. Results are small DataFrames: one row per
(arm, model) or draw.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import random
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.config import (CANDIDATE_NUMERIC, FEATURE_GROUPS, NO_REGRESSION_GAIN, PROMOTION_BOOSTED_GAIN,
                            PROMOTION_RIDGE_GAIN, PROMOTION_TREE_TOLERANCE, SEED, Config)
from cadence.functions.features import fill_zero, from_log1p, linear2
from cadence.functions.metrics import report
from cadence.operators import batchfit
from cadence.operators import validate as va
from cadence.operators.fitted import AtempRecalibrator, WindspeedZeroImputer
from cadence.operators.learners import RidgeLog, get_model
from cadence.operators.ridge import GramTable, RidgeFit
from cadence.operators.splits import fold_columns, fold_plan, holdout_flag, ranked_with_folds, split_holdout
from cadence.sources.io import path_exists

FIT_THREADS = 3   # small jobs (a fold's fitted transforms) that run at the same time

RESULT_SCHEMA = ("arm string, model string, holdout_rmsle double, holdout_rmse double, holdout_mae double, "
                 "holdout_r2 double, cv_rmsle double")


@dataclass
class Frame:
    """Ranked rows with the views that fits are validated on: one per gap of the folds,
    and last, if wanted, the holdout (fold 1 of its view)."""

    rows: DataFrame
    views: list[batchfit.View]
    folds: int
    holdout: int | None
    versions: dict[tuple[int, int], tuple[tuple[str, str], ...]] = field(default_factory=dict)

    def parts(self, view: int) -> list[tuple[int, int]]:
        return [(view, f) for f in ([1] if view == self.holdout else range(1, self.folds + 1))]


def validation_frame(df: DataFrame, cfg: Config = Config(), gaps: Sequence[int] | None = None, holdout: bool = True) -> Frame:
    tagged, plan = ranked_with_folds(df, cfg)
    views = []
    for gap in gaps if gaps is not None else (cfg.gap,):
        cols = fold_columns(F.col("rank"), fold_plan(plan[-1].val_end, cfg.n_splits, gap))
        views.append(batchfit.View(cols["train_seg"], cols["val_fold"]))
    if holdout:
        held = holdout_flag(F.col(cfg.datetime_col))
        views.append(batchfit.View(F.when(held, 2).otherwise(1), F.when(held, 1).otherwise(0)))
    return Frame(tagged.drop("val_fold", "train_seg"), views, len(plan), len(views) - 1 if holdout else None)


@dataclass(frozen=True)
class Job:
    """A model to be validated: its parameters, extra columns, and whether it reads the
    weather columns as rebuilt from each fold's training rows."""

    name: str
    params: dict
    extra: tuple[str, ...] = ()
    rebuilt: bool = False


def _rebuild(frame: Frame) -> None:
    """Adds windspeed and atemp as rebuilt by transforms fitted on every part's training
    rows (M17): one pair of columns a part."""
    parts = [p for v in range(len(frame.views)) for p in frame.parts(v)]

    def fitted(part):
        first = frame.views[part[0]].train_from
        train = frame.rows.filter((first > 0) & (first <= part[1]))
        wind = WindspeedZeroImputer().fit(train)
        return wind, AtempRecalibrator().fit(wind.transform(train))
    with ThreadPoolExecutor(max_workers=FIT_THREADS) as pool:
        made = list(pool.map(fitted, parts))
    cols = {}
    for (view, fold), (wind, atemp) in zip(parts, made):
        names = tuple((c, f"{c}__{view}_{fold}") for c in (wind.col, atemp.col))
        cols[names[0][1]] = fill_zero(F.col(wind.col), wind.fill_value_)
        cols[names[1][1]] = linear2(*atemp.coef_, *[F.col(c) for c in atemp.FEATURES])
        frame.versions[view, fold] = names
    frame.rows = frame.rows.withColumns(cols)


#: Fits that one job of a sweep with a ledger runs: what a lost driver loses at most.
LEDGER_FITS = 250
LEDGER_SCHEMA = "fit string, rmsle double, rmse double, mae double, r2 double, n bigint"


class Ledger:
    """Metrics of finished fits in a shared folder, one row a fit, so that a sweep that is
    started again runs only what is missing. A fit is known by its model, settings,
    columns, view and fold and by the content of its input, so a changed table or setting
    finds nothing of the old one."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def known(self, keys: Sequence[str]) -> dict[str, dict]:
        if not path_exists(self.spark, self.path):
            return {}
        rows = self.spark.read.schema(LEDGER_SCHEMA).parquet(self.path).join(
            self.spark.createDataFrame([(k,) for k in keys], "fit string"), "fit").dropDuplicates(["fit"]).collect()
        return {r["fit"]: r.asDict() for r in rows}

    def add(self, rows: Sequence[dict]) -> None:
        names = [x.split()[0] for x in LEDGER_SCHEMA.split(", ")]
        self.spark.createDataFrame([tuple(r[n] for n in names) for r in rows], LEDGER_SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    @staticmethod
    def content(frame: Frame, cfg: Config) -> str:
        """Rows and hash sum of a frame's columns, whatever their order."""
        r = frame.rows.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64(*sorted(frame.rows.columns)).cast("decimal(38,0)")).alias("h")).first()
        return f"{sorted(frame.rows.dtypes)}:{cfg.target}:{r['n']}:{r['h']}"


def validate(frame: Frame, jobs: Sequence[Job], cfg: Config = Config(), views: Sequence[int] | None = None,
             ledger: Ledger | None = None) -> list[dict]:
    """Metrics of every (job, view, fold), all fits together: rows with job, view, fold,
    rmsle, rmse, mae, r2 and n. With a ledger, fits that it holds are not run again."""
    if any(j.rebuilt for j in jobs) and not frame.versions:
        _rebuild(frame)
    trees, linear = [], []
    for k, job in enumerate(jobs):
        num = tuple(c for c in job.extra if c in CANDIDATE_NUMERIC)
        passed = tuple(c for c in job.extra if c not in CANDIDATE_NUMERIC)
        est = get_model(job.name, job.params, extra_numeric=num, extra_passthrough=passed, extra_tree=job.extra)
        for part in (p for v in (views if views is not None else range(len(frame.views))) for p in frame.parts(v)):
            renamed = dict(frame.versions[part]) if job.rebuilt else {}
            if isinstance(est, RidgeLog):
                linear.append(((k, *part), RidgeFit(est.spec, est.alpha, *part, tuple(renamed.items()))))
            else:
                trees.append(((k, *part), batchfit.Fit(tuple(renamed.get(c, c) for c in est.features), est.settings(), *part)))
    found = []
    content = Ledger.content(frame, cfg) if ledger else ""
    for made, scores in ((trees, _tree_scores), (linear, _ridge_scores)):
        names = [hashlib.sha256(f"{content}|{f!r}|{frame.views[at[1]].train_from}|{frame.views[at[1]].validates}".encode()).hexdigest() for at, f in made]
        have = ledger.known(names) if ledger and made else {}
        todo = list(dict.fromkeys(k for k, name in enumerate(names) if name not in have))
        step = LEDGER_FITS if ledger else max(1, len(todo))
        for batch in (todo[a:a + step] for a in range(0, len(todo), step)):
            scored = scores(frame, [made[k][1] for k in batch], cfg)
            scored = scored.select("fit", F.expm1("y").alias("y"), from_log1p(F.col("log_pred")).alias("pred"))
            rows = [{**r.asDict(), "fit": names[batch[r["fit"]]]} for r in report(scored, "y", "pred", by=["fit"]).collect()]
            have.update((r["fit"], r) for r in rows)
            if ledger:
                ledger.add(rows)
        for name, ((job, view, fold), _) in zip(names, made):
            if name in have:
                found.append({"job": job, "view": view, "fold": fold, **{m: have[name][m] for m in ("rmsle", "rmse", "mae", "r2", "n")}})
    return found


def _tree_scores(frame: Frame, fits: list[batchfit.Fit], cfg: Config) -> DataFrame:
    columns = list(dict.fromkeys(c for f in fits for c in f.columns))
    return batchfit.scores(batchfit.binned(frame.rows, columns, cfg.target, frame.views, F.col("rank")), fits)


def _ridge_scores(frame: Frame, fits: list[RidgeFit], cfg: Config) -> DataFrame:
    return GramTable(frame.rows, fits, cfg.target, frame.views, F.col("rank")).scores(fits)


def _mean(found: list[dict], job: int, view: int) -> float:
    own = [r["rmsle"] for r in sorted(found, key=lambda r: r["fold"]) if (r["job"], r["view"]) == (job, view)]
    return sum(own) / len(own)


def both_views(frame: Frame, jobs: Sequence[Job], cfg: Config = Config(), ledger: Ledger | None = None) -> list[dict]:
    """Holdout metrics and CV-mean RMSLE of every job."""
    found = validate(frame, jobs, cfg, ledger=ledger)
    held = {r["job"]: r for r in found if r["view"] == frame.holdout}
    return [{**{f"holdout_{m}": held[k][m] for m in ("rmsle", "rmse", "mae", "r2")}, "cv_rmsle": _mean(found, k, 0)} for k in range(len(jobs))]


REPORT_DIGITS = 4   # experiment records keep 4 places (B26), half-even like the records


def _results(spark: SparkSession, rows: list[dict]) -> DataFrame:
    """Experiment result rows, rounded as recorded; improvements are computed from
    the rounded values (D5)."""
    df = spark.createDataFrame([(r["arm"], r["model"], r["holdout_rmsle"], r["holdout_rmse"], r["holdout_mae"],
                                 r["holdout_r2"], r["cv_rmsle"]) for r in rows], RESULT_SCHEMA)
    metrics = ["holdout_rmsle", "holdout_rmse", "holdout_mae", "holdout_r2", "cv_rmsle"]
    return df.withColumns({m: F.bround(m, REPORT_DIGITS) for m in metrics})


def feature_sweep(df: DataFrame, models: Sequence[str], cfg: Config = Config(),
                  groups: dict[str, Sequence[str]] | None = None, ledger: Ledger | None = None) -> DataFrame:
    """Baseline arm plus one arm per candidate group, for each model.
    ``df`` must carry the candidate columns (B16). Ridge routes numeric candidates to
    the scaler and the rest to pass-through; trees take them as extra features."""
    groups = groups if groups is not None else FEATURE_GROUPS
    arms = {"baseline": (), **groups}
    jobs = [(arm, Job(m, cfg.params.get(m, {}), tuple(cols))) for arm, cols in arms.items() for m in models]
    got = both_views(validation_frame(df, cfg), [j for _, j in jobs], cfg, ledger)
    return _results(df.sparkSession, [{"arm": arm, "model": j.name, **r} for (arm, j), r in zip(jobs, got)])


def env_experiment(df: DataFrame, models: Sequence[str], cfg: Config = Config(), ledger: Ledger | None = None) -> DataFrame:
    """Baseline, comfort (+ comfort index), recalib (zero-wind fill and atemp
    rebuild fitted inside every fold), all (both)."""
    arms = {"baseline": ((), False), "comfort": (("comfort_index",), False), "recalib": ((), True),
            "all": (("comfort_index",), True)}
    jobs = [(arm, Job(m, cfg.params.get(m, {}), extra, rebuilt)) for arm, (extra, rebuilt) in arms.items() for m in models]
    got = both_views(validation_frame(df, cfg), [j for _, j in jobs], cfg, ledger)
    return _results(df.sparkSession, [{"arm": arm, "model": j.name, **r} for (arm, j), r in zip(jobs, got)])


def gap_diagnostic(df: DataFrame, models: Sequence[str], cfg: Config = Config(), gaps: tuple[int, int] = (0, 48)) -> DataFrame:
    """CV RMSLE of each model with either gap, and their difference."""
    found = validate(validation_frame(df, cfg, gaps, holdout=False), [Job(m, cfg.params.get(m, {})) for m in models], cfg)
    rows = [(m, a, b, b - a) for k, m in enumerate(models) for a, b in [(_mean(found, k, 0), _mean(found, k, 1))]]
    return df.sparkSession.createDataFrame(rows, f"model string, cv_rmsle_gap{gaps[0]} double, cv_rmsle_gap{gaps[1]} double, delta double")


def cross_validation(df: DataFrame, job: Job, cfg: Config = Config()) -> DataFrame:
    """M12 for a learner: the four metrics and row count of every fold."""
    found = validate(validation_frame(df, cfg, holdout=False), [job], cfg)
    return df.sparkSession.createDataFrame([(r["fold"], r["rmsle"], r["rmse"], r["mae"], r["r2"], r["n"]) for r in sorted(found, key=lambda r: r["fold"])],
                                           "fold int, rmsle double, rmse double, mae double, r2 double, n bigint")


def compare_with_baseline(results: DataFrame, baseline_arm: str = "baseline") -> DataFrame:
    """improvement = baseline holdout RMSLE - arm holdout RMSLE, per model."""
    base = results.filter(F.col("arm") == baseline_arm).select(
        "model", F.col("holdout_rmsle").alias("baseline_rmsle"))
    return results.filter(F.col("arm") != baseline_arm).join(base, "model").withColumn(
        "improvement", F.col("baseline_rmsle") - F.col("holdout_rmsle"))


def promotion_gate(comparison: DataFrame, boosted=("gradient_boosting", "xgboost"), linear="ridge",
                   trees=("random_forest", "gradient_boosting", "xgboost")) -> DataFrame:
    """M29 (an arm without results of every tree model can't show that no tree loses):
    an arm qualifies when a boosted model gains >= 0.01, or ridge gains
    >= 0.03 while no tree loses more than 0.005. Among qualifiers, an arm where no
    model loses at all is preferred, then the larger best gain."""
    imp = F.round(F.col("improvement"), 4)
    per = comparison.groupBy("arm").agg(
        F.max(F.when(F.col("model").isin(*boosted), imp)).alias("best_boosted_gain"),
        F.max(F.when(F.col("model") == linear, imp)).alias("ridge_gain"),
        F.when(F.count_distinct(F.when(F.col("model").isin(*trees) & imp.isNotNull(), F.col("model"))) == len(trees),
               F.min(F.when(F.col("model").isin(*trees), imp))).alias("worst_tree_gain"),
        F.min(imp).alias("worst_gain"), F.max(imp).alias("best_gain"))
    qualifies = ((F.coalesce(F.col("best_boosted_gain"), F.lit(-1.0)) >= PROMOTION_BOOSTED_GAIN)
                 | ((F.coalesce(F.col("ridge_gain"), F.lit(-1.0)) >= PROMOTION_RIDGE_GAIN)
                    & (F.coalesce(F.col("worst_tree_gain"), F.lit(-1.0)) >= -PROMOTION_TREE_TOLERANCE)))
    return per.withColumn("qualifies", qualifies.cast("int")).withColumn(
        "no_loss", (F.col("worst_gain") >= 0).cast("int"))


def promotion_winner(gate: DataFrame) -> DataFrame:
    """The preferred qualifying arm (no loss first, then best gain)."""
    return gate.filter(F.col("qualifies") == 1).orderBy(F.desc("no_loss"), F.desc("best_gain"), "arm").limit(1)


def no_regression_gate(base: DataFrame, arm: DataFrame, keys: Sequence[str] = ("model",)) -> DataFrame:
    """The arm passes when RMSLE gains >= 0.01 and RMSE, MAE and R2 are not worse."""
    b = base.select(*keys, *[F.col(m).alias(f"b_{m}") for m in ("rmsle", "rmse", "mae", "r2")])
    j = arm.join(b, list(keys))
    gain = F.col("b_rmsle") - F.col("rmsle")
    ok = ((gain >= NO_REGRESSION_GAIN) & (F.col("rmse") <= F.col("b_rmse")) & (F.col("mae") <= F.col("b_mae"))
          & (F.col("r2") >= F.col("b_r2")))
    return j.select(*keys, gain.alias("rmsle_gain"), ok.cast("int").alias("passes"))


def leaderboard(results: DataFrame, metric: str = "rmsle") -> DataFrame:
    """Models sorted by holdout metric."""
    return results.orderBy(metric, "model")


def best_model(results: DataFrame, metric: str = "rmsle") -> DataFrame:
    """The first row of the leaderboard as one aggregate (``min_by``)."""
    return results.agg(F.min_by("model", F.struct(F.col(metric), F.col("model"))).alias("best_model"),
                       F.min(metric).alias(f"best_{metric}"))


# --- M22, M23 random search ---------------------------------------------------------------------
def draw_params(space: dict[str, list], n: int, seed: int = SEED) -> list[dict]:
    """Seeded draws without replacement from the full grid of listed values."""
    keys = sorted(space)
    grid = list(itertools.product(*[space[k] for k in keys]))
    rng = random.Random(seed)
    picks = rng.sample(range(len(grid)), min(n, len(grid)))
    return [dict(zip(keys, grid[i])) for i in picks]


def random_search(df: DataFrame, model: str, space: dict[str, list], n_draws: int, cfg: Config = Config(),
                  ledger: Ledger | None = None) -> DataFrame:
    """Score each draw by CV-mean RMSLE on the search rows (days 1-15, folded
    inside); no refit."""
    search_rows, _ = split_holdout(df, cfg)
    draws = draw_params(space, n_draws, cfg.seed)
    found = validate(validation_frame(search_rows, cfg, holdout=False), [Job(model, p) for p in draws], cfg, ledger=ledger)
    out = [(k, model, json.dumps(p, sort_keys=True), cv, -cv) for k, p in enumerate(draws) for cv in [_mean(found, k, 0)]]
    return df.sparkSession.createDataFrame(out, "draw int, model string, params string, cv_rmsle double, score double")


def tuned_against_baseline(df: DataFrame, searches: dict[str, DataFrame], cfg: Config = Config(),
                           ledger: Ledger | None = None) -> DataFrame:
    """Refit the best draw of each model and its published settings on both views;
    improvement on holdout."""
    best = {m: s.orderBy("cv_rmsle", "draw").first() for m, s in searches.items()}
    jobs = [(arm, Job(m, p)) for m, row in best.items() for arm, p in (("baseline", cfg.params[m]), ("tuned", json.loads(row["params"])))]
    got = both_views(validation_frame(df, cfg), [j for _, j in jobs], cfg, ledger)
    res = _results(df.sparkSession, [{"arm": arm, "model": j.name, **r} for (arm, j), r in zip(jobs, got)])
    found = df.sparkSession.createDataFrame([(m, row["cv_rmsle"]) for m, row in best.items()], "model string, search_best_cv_rmsle double")
    return compare_with_baseline(res).join(found, "model")


def holdout_results(df: DataFrame, predictors: dict, cfg: Config = Config()) -> DataFrame:
    """Holdout report of several named predictors (one row each)."""
    parts = []
    for name, pred in predictors.items():
        parts.append(va.evaluate_holdout(pred, df, cfg).withColumn("model", F.lit(name)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def holdout_rows(df: DataFrame, predictor, cfg: Config = Config()) -> DataFrame:
    """Holdout rows with actual, prediction and residual."""
    pred = va.holdout_predictions(predictor, df, cfg)
    return pred.withColumn("actual", F.col(cfg.target).cast("double")).withColumn(
        "residual", F.col("pred") - F.col("actual"))


def report_of(pred: DataFrame, cfg: Config = Config()) -> DataFrame:
    return report(pred, cfg.target, "pred")
