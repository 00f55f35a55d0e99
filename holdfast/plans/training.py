"""Cross-validation, comparison, search, and the whole training job."""

from __future__ import annotations

import json
import random
import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.cleaning import CATEGORY_ALIASES, ROW_KEY, clean
from holdfast.operators.importance import permutation_importance
from holdfast.operators.metrics import (
    fold_summary, metrics_at_threshold, ranking_metrics, select_threshold, with_expected_cost,
)
from holdfast.operators.models import (
    FEATURES, LABEL, PATIENCE, Candidate, ScoringModel, assemble, candidate, candidates,
    fit_candidate,
)
from holdfast.operators.quality import CUSTOMER_RULES, QualityRules, quality_gate, require_target
from holdfast.operators.search import Dimension, propose
from holdfast.operators.splitting import holdout_split, stratified_folds
from holdfast.plans.prepare import PreparedSplits, prepare_model_splits
from holdfast.plans.records import run_record
from holdfast.plans.results import results_table
from holdfast.session import stage_table
from holdfast.sources.bundles import RunBundle, new_run_id, save_bundle

FOLD, PROBABILITY = "fold", "probability"


def _run_all(spark: SparkSession, tasks: Sequence, parallelism: int) -> list:
    """Independent fits share the cluster from a few driver threads."""
    if parallelism <= 1 or len(tasks) <= 1:
        return [task() for task in tasks]
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        return pool.map(lambda task: inheritable_thread_target(spark)(task)(), tasks)


def folded_rows(rows: DataFrame, cv: int, seed: int) -> DataFrame:
    """Assembled rows with their fold, kept for the fits."""
    return stratified_folds(rows, ROW_KEY, LABEL, cv, seed, name=FOLD).persist()


def _inner_rows(folded: DataFrame, fold: int, seed: int) -> DataFrame:
    """The rows outside the fold with their part of the inner split, kept for the fits; the split is seeded per fold."""
    return holdout_split(
        folded.filter(F.col(FOLD) != fold), ROW_KEY, LABEL, 0.2, seed + fold, name="__part", held="held", rest="fit"
    ).persist()


def _fold_task(chosen: Candidate, folded: DataFrame, fold: int, seed: int, rounds: int,
               calibrate: str | None, early_stopping: bool, shared: DataFrame | None = None):
    """Fit without the fold, score the fold. The fold is never seen by the fit, the early stopping
    or the calibrator. ``shared`` has the inner split where several models use the same one."""
    def task() -> DataFrame:
        others = folded.filter(F.col(FOLD) != fold)
        if early_stopping or calibrate not in (None, "none"):
            inner = _inner_rows(folded, fold, seed) if shared is None else shared
            train = inner.filter(F.col("__part") == "fit").drop("__part")
            held = inner.filter(F.col("__part") == "held").drop("__part")
        else:
            inner, train, held = None, others, others
        try:
            model, calibrator, _ = fit_candidate(
                chosen, train, held, seed=seed, rounds=rounds, calibrate=calibrate,
                early_stopping=early_stopping,
            )
        finally:
            if inner is not None and shared is None:
                inner.unpersist()
        scored = ScoringModel(PipelineModel([model]), calibrator).score(
            folded.filter(F.col(FOLD) == fold), PROBABILITY
        )
        return scored.select(ROW_KEY, FOLD, LABEL, F.col(PROBABILITY).cast("double"))
    return task


def _timed(task):
    def run():
        started = time.monotonic()
        return task(), time.monotonic() - started
    return run


def _union(frames: Sequence[DataFrame]) -> DataFrame:
    out = frames[0]
    for frame in frames[1:]:
        out = out.unionByName(frame)
    return out


@dataclass(frozen=True)
class OutOfFold:
    """``rows``: (row_key, fold, label, probability); ``stats``: one row of means and deviations."""

    rows: DataFrame
    fold_scores: DataFrame
    stats: DataFrame


def cross_val_oof(
    rows: DataFrame,
    chosen: Candidate,
    *,
    cv: int = 5,
    rounds: int = PATIENCE,
    seed: int = 42,
    calibrate: str | None = None,
    parallelism: int = 8,
) -> OutOfFold:
    """Every row scored by a model that never saw it; ``rows`` are assembled rows."""
    folded = folded_rows(rows, cv, seed)
    try:
        tasks = [
            _fold_task(chosen, folded, f, seed, rounds, calibrate, True) for f in range(cv)
        ]
        scored = _union(_run_all(rows.sparkSession, tasks, parallelism))
        oof = stage_table(scored, "oof")
    finally:
        folded.unpersist()
    scores = ranking_metrics(oof, LABEL, PROBABILITY, by=[FOLD], groups=cv)
    return OutOfFold(oof, scores, fold_summary(scores))


def compare_models(
    rows: DataFrame,
    *,
    models: Sequence[Candidate] | None = None,
    threshold_metric: str = "cost",
    fn_fp_ratio: float = 10.0,
    cv: int = 5,
    rounds: int = PATIENCE,
    seed: int = 42,
    parallelism: int = 8,
) -> DataFrame:
    """Candidates on the same folds, ranked by mean PR-AUC, then ROC-AUC; ``cv_time`` adds up the
    seconds of a model's folds, which run side by side, after the splits that all models share.

    The predictions of all models form one table (model, fold, label, probability), and grouped
    aggregates give all scores, thresholds and operating points at once.
    """
    chosen = list(candidates() if models is None else models)
    spark = rows.sparkSession
    folded, inner = folded_rows(rows, cv, seed), []
    try:
        inner += _run_all(spark, [lambda f=f: _inner_rows(folded, f, seed) for f in range(cv)], parallelism)
        tasks = [
            _timed(_fold_task(c, folded, f, seed, rounds, None, True, inner[f]))
            for c in chosen for f in range(cv)
        ]
        frames, seconds = [], {c.name: 0.0 for c in chosen}
        for i, (frame, took) in enumerate(_run_all(spark, tasks, parallelism)):
            name = chosen[i // cv].name
            frames.append(frame.withColumn("model", F.lit(name)))
            seconds[name] += took
        scored = stage_table(_union(frames), "comparison")
    finally:
        for part in [folded, *inner]:
            part.unpersist()
    scores = fold_summary(
        ranking_metrics(
            scored, LABEL, PROBABILITY, by=["model", FOLD], groups=cv * len(chosen)
        ),
        by=["model"],
    )
    thresholds = select_threshold(
        scored, threshold_metric, fn_fp_ratio, LABEL, PROBABILITY, by=["model"]
    ).drop("objective")
    cut = F.col("threshold")
    operating = with_expected_cost(
        metrics_at_threshold(
            scored.join(F.broadcast(thresholds), "model"), cut, LABEL, PROBABILITY,
            by=["model", "threshold"],
        ),
        fn_fp_ratio,
    )
    took = None
    for name, value in seconds.items():
        same = F.col("model") == name
        took = F.when(same, F.lit(value)) if took is None else took.when(same, F.lit(value))
    return (
        scores.join(operating, "model")
        .select(
            "model",
            F.col("pr_auc_mean").alias("cv_pr_auc"), F.col("pr_auc_std").alias("cv_pr_std"),
            F.col("roc_auc_mean").alias("cv_roc_auc"), F.col("roc_auc_std").alias("cv_roc_std"),
            "threshold", "precision", "recall", "f1", F.col("cost").alias("oof_cost"),
            took.alias("cv_time"),
        )
        .orderBy(F.desc("cv_pr_auc"), F.desc("cv_roc_auc"), "model")
    )


#: The ranges that a search looks at.
_SHARED = {
    "maxIter": Dimension(300, 1500, "int"), "stepSize": Dimension(0.01, 0.2, "log"),
    "subsamplingRate": Dimension(0.5, 1.0), "featureShare": Dimension(0.5, 1.0),
    "regAlpha": Dimension(1e-8, 10.0, "log"), "regLambda": Dimension(1e-8, 10.0, "log"),
}
SPACES = {
    "boosted_sampled": {
        **_SHARED, "maxDepth": Dimension(3, 10, "int"), "minChildWeight": Dimension(1, 10, "int"),
    },
    "boosted_balanced": {
        **_SHARED, "maxLeaves": Dimension(15, 255, "int"), "minInstancesPerNode": Dimension(5, 100, "int"),
        "subsamplingFreq": Dimension(1, 7, "int"),
    },
}


@dataclass(frozen=True)
class SearchResult:
    """``trials``: (trial, score) as a table; ``best``: the parameters of the best trial."""

    trials: DataFrame
    params: list[dict[str, object]]
    best: dict[str, object]


def tune_model(
    rows: DataFrame,
    name: str = "boosted_sampled",
    *,
    scoring: str = "pr_auc",
    n_trials: int = 20,
    cv: int = 5,
    seed: int = 42,
    parallelism: int = 8,
    batch: int = 4,
    overrides: Mapping[str, object] | None = None,
) -> SearchResult:
    """Seeded search by cross-validated ``scoring`` (pr_auc or roc_auc) that learns from its trials.

    ``batch`` points are proposed at a time from the trials before (see ``search.propose``), fitted side by side
    and scored by one grouped aggregate. ``overrides`` pins parameters, for instance a
    smaller ``maxIter`` for a quick search.
    """
    if scoring not in ("pr_auc", "roc_auc"):
        raise ValueError(f"unknown scoring '{scoring}'; choose pr_auc or roc_auc")
    if name not in SPACES:
        raise ValueError(f"no search for '{name}'; choose {' or '.join(sorted(SPACES))}")
    pinned = dict(overrides or {})
    space = {k: d for k, d in SPACES[name].items() if k not in pinned}
    rng, spark = random.Random(seed), rows.sparkSession
    tried: list[tuple[dict[str, object], float]] = []
    folded = folded_rows(rows, cv, seed)
    try:
        while len(tried) < n_trials:
            points = [propose(space, tried, rng) for _ in range(min(batch, n_trials - len(tried)))]
            tasks = [
                _fold_task(candidate(name).with_params(**p, **pinned), folded, f, seed, PATIENCE, None, False)
                for p in points for f in range(cv)
            ]
            parts = _run_all(spark, tasks, parallelism)
            scored = stage_table(
                _union([part.withColumn("trial", F.lit(i // cv)) for i, part in enumerate(parts)]), "search",
            )
            scores = {r["trial"]: r["score"] for r in ranking_metrics(
                scored, LABEL, PROBABILITY, by=["trial", FOLD], groups=cv * len(points)
            ).groupBy("trial").agg(F.avg(scoring).alias("score")).collect()}
            tried += [(p, scores[i]) for i, p in enumerate(points)]
    finally:
        folded.unpersist()
    trials = spark.createDataFrame(
        [(i, float(score)) for i, (_, score) in enumerate(tried)], "trial int, score double")
    params = [{**p, **pinned} for p, _ in tried]
    return SearchResult(trials, params, params[max(range(n_trials), key=lambda i: (tried[i][1], -i))])


def tuned_candidate(name: str, best: Mapping[str, object]) -> Candidate:
    """The candidate rebuilt with the parameters a search found; forests have no search."""
    if name == "random_forest":
        raise ValueError("random_forest has no boosting search; tune a boosted candidate")
    return candidate(name).with_params(**best)


@dataclass(frozen=True)
class FinalModel:
    model: ScoringModel
    best_iteration: int | None
    train_seconds: float


def fit_final(
    prepared: PreparedSplits, chosen: Candidate, *, calibrate: str | None = "isotonic",
    rounds: int = PATIENCE, seed: int = 42,
) -> FinalModel:
    """Train on train; validation decides the number of trees and fits the calibrator."""
    features = prepared.feature_columns
    train = assemble(prepared.part("train"), features, prepared.target, ROW_KEY).persist()
    val = assemble(prepared.part("val"), features, prepared.target, ROW_KEY).persist()
    try:
        started = time.monotonic()
        model, calibrator, best = fit_candidate(
            chosen, train, val, seed=seed, rounds=rounds, calibrate=calibrate
        )
        took = time.monotonic() - started
    finally:
        train.unpersist()
        val.unpersist()
    vectors = VectorAssembler(inputCols=features, outputCol=FEATURES)
    return FinalModel(ScoringModel(PipelineModel([vectors, model]), calibrator), best, took)


@dataclass(frozen=True)
class TrainingResult:
    bundle: RunBundle
    results: DataFrame
    comparison: DataFrame | None
    importance: DataFrame
    oof: OutOfFold
    test_scores: DataFrame
    prepared: PreparedSplits
    record: DataFrame


def train(
    raw: DataFrame,
    *,
    target: str = "Churn",
    model: str = "boosted_balanced",
    threshold: float | None = None,
    threshold_metric: str = "cost",
    fn_fp_ratio: float = 10.0,
    test_size: float = 0.2,
    val_size: float = 0.2,
    calibrate: str | None = "isotonic",
    compare: bool = False,
    tune: bool = False,
    tune_metric: str = "pr_auc",
    tune_trials: int = 20,
    rules: QualityRules = CUSTOMER_RULES,
    skip_validation: bool = False,
    aliases: Mapping[str, Mapping[str, str]] = CATEGORY_ALIASES,
    cv: int = 5,
    rounds: int = PATIENCE,
    importance_repeats: int = 10,
    params: Mapping[str, object] | None = None,
    bundle_root: str | None = None,
    seed: int = 42,
    parallelism: int = 8,
) -> TrainingResult:
    """The whole job: check, clean, split, compare, tune, cross-validate, fit, calibrate, choose the
    threshold on out-of-fold rows, evaluate once on the test split, and store the bundle.

    ``params`` overrides parameters of the final candidate, such as ``maxIter`` or ``numTrees``.
    """
    spark = raw.sparkSession
    quality_gate(raw, rules, skip=skip_validation)
    require_target(raw, target)
    cleaned = stage_table(clean(raw, target, aliases=aliases), "cleaned")
    prepared = prepare_model_splits(cleaned, target, test_size, val_size, seed)
    frame = stage_table(prepared.frame, "encoded")
    prepared = PreparedSplits(frame, target, prepared.schema, prepared.medians)
    features = prepared.feature_columns
    trainval = assemble(prepared.trainval, features, target, ROW_KEY)

    comparison = None
    if compare:
        comparison = compare_models(
            trainval,
            models=[c.with_params(**(params or {})) if c.name == model else c
                    for c in candidates()],
            threshold_metric=threshold_metric, fn_fp_ratio=fn_fp_ratio,
            cv=cv, rounds=rounds, seed=seed, parallelism=parallelism,
        )
    chosen = candidate(model)
    if tune:
        if model == "random_forest":
            raise ValueError("random_forest has no boosting search; tune a boosted candidate")
        train_rows = assemble(prepared.part("train"), features, target, ROW_KEY)
        found = tune_model(
            train_rows, model, scoring=tune_metric, n_trials=tune_trials, cv=cv, seed=seed,
            parallelism=parallelism, overrides=params,
        )
        chosen = tuned_candidate(model, found.best)
    elif params:
        chosen = chosen.with_params(**params)

    oof = cross_val_oof(
        trainval, chosen, cv=cv, rounds=rounds, seed=seed, calibrate=calibrate,
        parallelism=parallelism,
    )
    final = fit_final(prepared, chosen, calibrate=calibrate, rounds=rounds, seed=seed)
    cut = select_threshold(
        oof.rows, threshold_metric, fn_fp_ratio, LABEL, PROBABILITY, fixed=threshold
    ).first()["threshold"]

    test = prepared.part("test")
    scoring_started = time.monotonic()
    scores = stage_table(
        final.model.score(test, PROBABILITY).select(
            ROW_KEY, F.col(target).cast("int").alias(LABEL), PROBABILITY
        ),
        "test-scores",
    )
    scoring_seconds = time.monotonic() - scoring_started
    assembled = assemble(test, features, target, ROW_KEY)
    bare = ScoringModel(
        PipelineModel(final.model.pipeline.stages[1:]), final.model.calibrator
    )
    importance = stage_table(
        permutation_importance(
            bare, assembled, features, ROW_KEY, repeats=importance_repeats, seed=seed
        ),
        "importance",
    )
    bundle = RunBundle(
        new_run_id(), model, final.model, prepared.schema, prepared.medians, float(cut)
    )
    results = results_table(
        raw=raw, cleaned=cleaned, target=target, test_scores=scores, oof=oof.rows,
        threshold=float(cut), fn_fp_ratio=fn_fp_ratio, cv_stats=oof.stats,
        comparison=comparison, importance=importance,
        run={"best_iteration": final.best_iteration, "train_seconds": final.train_seconds},
    )
    n_scored = scores.count()
    record = stage_table(run_record(
        bundle.run_id, results, raw=raw, test_scores=scores, threshold=float(cut), comparison=comparison,
        importance=importance, facts={
            "model": model, "target": target, "threshold_metric": threshold_metric, "calibrate": calibrate,
            "parameters": json.dumps(chosen.params, sort_keys=True, default=str), "seed": seed, "cv": cv,
            "tuned": tune, "compared": compare, "gate_skipped": skip_validation,
            "n_features": len(features), "scored_rows": n_scored, "scoring_seconds": scoring_seconds,
            "rows_per_second": n_scored / max(scoring_seconds, 1e-9),
        }), "record")
    if bundle_root is not None:
        save_bundle(spark, bundle_root, bundle, record=record)
    return TrainingResult(bundle, results, comparison, importance, oof, scores, prepared, record)
