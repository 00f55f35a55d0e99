"""Candidate models and how one of them is fitted."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier, RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.operators.boosting import HistogramBooster
from holdfast.operators.calibration import RAW, Calibrator, fit_calibrator
from holdfast.operators.splitting import balanced_weights, class_counts, with_class_weight

LABEL, FEATURES, WEIGHT = "label", "features", "weight"
PATIENCE = 50


class _TreesOnRequest:
    """``trees`` as a plain property. As a cached property it is evaluated when the parameters of a
    fresh model are listed, which fetches every tree to the driver one call at a time."""

    @property
    def trees(self):
        return super().trees


class ForestModel(_TreesOnRequest, RandomForestClassificationModel):
    pass


class Forest(RandomForestClassifier):
    def _create_model(self, java_model):
        return ForestModel(java_model)


def _positive_ratio(counts: Mapping[object, int]) -> dict[object, float]:
    return {0: 1.0, 1: counts.get(0, 0) / max(counts.get(1, 0), 1)}


@dataclass(frozen=True)
class Candidate:
    """A model by name: how to build it, and how its classes are weighted."""

    name: str
    build: Callable[[int], Estimator]
    class_weights: Callable[[Mapping[object, int]], dict[object, float]]
    params: Mapping[str, object] = field(default_factory=dict)

    def estimator(self, seed: int = 42) -> Estimator:
        made = self.build(seed)
        return made.copy({made.getParam(k): v for k, v in self.params.items()})

    def with_params(self, **params: object) -> Candidate:
        return Candidate(
            self.name, self.build, self.class_weights, {**self.params, **params}
        )


def _forest(seed: int) -> Estimator:
    return Forest(
        featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, seed=seed,
        numTrees=400, maxDepth=30, featureSubsetStrategy="sqrt",
    )


def _boosted(seed: int, **params: object) -> Estimator:
    return HistogramBooster(
        featuresCol=FEATURES, labelCol=LABEL, weightCol=WEIGHT, seed=seed, maxIter=2000, stepSize=0.05, **params,
    )


def candidates() -> list[Candidate]:
    """The three candidates; for the boosted ones ``maxIter`` is a ceiling, not a choice.

    The balanced one grows its trees by leaves, the other by levels with a penalty on large values.
    """
    return [
        Candidate("random_forest", _forest, balanced_weights),
        Candidate("boosted_balanced", lambda s: _boosted(s, maxLeaves=31), balanced_weights),
        Candidate(
            "boosted_sampled",
            lambda s: _boosted(
                s, maxLeaves=0, maxDepth=6, subsamplingRate=0.8, featureShare=0.8, regLambda=1.0,
                minInstancesPerNode=1.0, minChildWeight=1.0,
            ),
            _positive_ratio,
        ),
    ]


def candidate(name: str) -> Candidate:
    known = {c.name: c for c in candidates()}
    if name not in known:
        raise ValueError(f"unknown model '{name}'; choose one of {', '.join(known)}")
    return known[name]


def assemble(df: DataFrame, features: Sequence[str], target: str, key: str) -> DataFrame:
    """(key, label, features) with the columns in one vector."""
    vectors = VectorAssembler(inputCols=list(features), outputCol=FEATURES)
    return vectors.transform(df).select(key, F.col(target).cast("int").alias(LABEL), FEATURES)


def positive_probability(df: DataFrame) -> Column:
    """The positive class's probability from whatever the model left: a probability vector, a
    margin, or a bare prediction."""
    if "probability" in df.columns:
        return vector_to_array("probability")[1]
    if "rawPrediction" in df.columns:
        margin = vector_to_array("rawPrediction")[1]
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))
    return F.col("prediction").cast("double")


def raw_scores(model: Model, df: DataFrame, out: str = RAW) -> DataFrame:
    """The rows with the model's probability, and without its other output columns."""
    work = model.transform(df)
    extra = [c for c in ("probability", "rawPrediction", "prediction") if c in work.columns]
    return work.withColumn(out, positive_probability(work)).drop(*extra)


@dataclass(frozen=True)
class ScoringModel:
    """A fitted pipeline and the calibrator that belongs to it."""

    pipeline: PipelineModel
    calibrator: Calibrator | None = None

    def score(self, df: DataFrame, out: str = "churn_probability") -> DataFrame:
        scored = raw_scores(self.pipeline, df)
        if self.calibrator is None:
            return scored.withColumnRenamed(RAW, out)
        return self.calibrator.apply(scored, RAW, out).drop(RAW)


def best_iteration(losses: Sequence[float], rounds: int) -> tuple[int, bool]:
    """1-based iteration of the lowest loss before ``rounds`` iterations pass without a better one,
    and whether that stop was reached."""
    best, at = math.inf, 0
    for i, loss in enumerate(losses, start=1):
        if loss < best:
            best, at = loss, i
        elif i - at >= rounds:
            return at, True
    return at, False


def fit_with_early_stopping(
    estimator: Estimator, train: DataFrame, held: DataFrame, rounds: int = PATIENCE
) -> tuple[Model, int | None]:
    """Fit; for boosted trees the held-out loss decides how many.

    The histogram booster watches the loss as it goes and keeps its first trees. With Spark's own, which
    always starts with the same trees for a seed, a modest number is fitted
    first and doubled only while the loss is still falling, and the last fit stops at the best
    iteration. Forests are fitted as they are.
    """
    if isinstance(estimator, HistogramBooster):
        model, best, _, _ = estimator.fit_stopped(train, held, rounds)
        return model, best
    if not isinstance(estimator, GBTClassifier):
        return estimator.fit(train), None
    ceiling = estimator.getMaxIter()
    budget = min(ceiling, 2 * rounds)
    while True:
        model = estimator.copy({estimator.maxIter: budget}).fit(train)
        best, stopped = best_iteration(model.evaluateEachIteration(held), rounds)
        if stopped or budget == ceiling:
            break
        budget = min(ceiling, 2 * budget)
    best = max(best, 1)
    if best < budget:
        model = estimator.copy({estimator.maxIter: best}).fit(train)
    return model, best


def fit_candidate(
    chosen: Candidate,
    train: DataFrame,
    held: DataFrame,
    *,
    seed: int = 42,
    rounds: int = PATIENCE,
    calibrate: str | None = None,
    early_stopping: bool = True,
) -> tuple[Model, Calibrator | None, int | None]:
    """Weight the classes as the candidate wants, fit with early stopping, calibrate on ``held``."""
    weights = chosen.class_weights(class_counts(train, LABEL))
    weighted = with_class_weight(train, LABEL, weights, WEIGHT)
    estimator = chosen.estimator(seed)
    if early_stopping:
        unweighted = held.withColumn(WEIGHT, F.lit(1.0))
        model, best = fit_with_early_stopping(estimator, weighted, unweighted, rounds)
    else:
        model, best = estimator.fit(weighted), None
    calibrator = None
    if calibrate not in (None, "none"):
        calibrator = fit_calibrator(raw_scores(model, held), calibrate, RAW, LABEL)
    return model, calibrator, best
