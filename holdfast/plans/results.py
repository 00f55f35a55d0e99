"""The results of a run as one long table (section, item, metric, value)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.operators.importance import top_drivers
from holdfast.operators.metrics import (
    calibration_alarm, calibration_report, metrics_at_threshold, ranking_metrics,
    with_expected_cost,
)


def to_metrics(df: DataFrame, section: str, columns: Sequence[str], item: str | None = None
               ) -> DataFrame:
    """The named columns of each row as (section, item, metric, value) rows."""
    pairs = [
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("double").alias("value"))
        for c in columns
    ]
    label = F.col(item).cast("string") if item else F.lit("")
    return df.select(
        F.lit(section).alias("section"), label.alias("item"),
        F.explode(F.array(*pairs)).alias("m"),
    ).select("section", "item", "m.*")


def data_provenance(raw: DataFrame, cleaned: DataFrame, target: str) -> DataFrame:
    """One row: raw rows, rows after cleaning, churn rate."""
    n_raw = raw.agg(F.count(F.lit(1)).alias("n"))
    return cleaned.agg(
        F.count(F.lit(1)).alias("clean_rows"),
        F.avg((F.col(target) == 1).cast("double")).alias("churn_rate"),
    ).select(n_raw.scalar().alias("raw_rows"), "clean_rows", "churn_rate")


def split_profile(marked: DataFrame, target: str, split: str = "split") -> DataFrame:
    """(split, n_rows, n_positive, n_negative)."""
    return marked.groupBy(split).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count(F.when(F.col(target) == 1, 1)).alias("n_positive"),
        F.count(F.when(F.col(target) == 0, 1)).alias("n_negative"),
    )


def evaluation_metrics(scores: DataFrame, threshold: float, fn_fp_ratio: float,
                       label: str = "label", score: str = "probability") -> DataFrame:
    """One row of everything that is reported about held-out scores."""
    operating = with_expected_cost(
        metrics_at_threshold(scores, threshold, label, score), fn_fp_ratio
    )
    ranking = ranking_metrics(scores, label, score).select(F.struct("roc_auc", "pr_auc"))
    calibration = calibration_alarm(calibration_report(scores, label, score)).select(
        F.struct("brier", "ece", "alarm")
    )
    size = F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")
    return (
        operating.withColumns({"r": ranking.scalar(), "c": calibration.scalar()})
        .select(
            size.alias("n_rows"), (F.col("tp") + F.col("fn")).alias("n_positive"),
            (F.col("tn") + F.col("fp")).alias("n_negative"), "r.*",
            "precision", "recall", "f1", "tn", "fp", "fn", "tp", "cost", "c.*",
        )
    )


def results_table(
    *,
    raw: DataFrame,
    cleaned: DataFrame,
    target: str,
    test_scores: DataFrame,
    oof: DataFrame | None,
    threshold: float,
    fn_fp_ratio: float = 10.0,
    cv_stats: DataFrame | None = None,
    comparison: DataFrame | None = None,
    importance: DataFrame | None = None,
    run: Mapping[str, float | None] | None = None,
    label: str = "label",
    score: str = "probability",
) -> DataFrame:
    """Provenance, test metrics, and where given: out-of-fold calibration, cross-validation,
    comparison, strongest drivers and run facts."""
    provenance = data_provenance(raw, cleaned, target)
    test = evaluation_metrics(test_scores, threshold, fn_fp_ratio, label, score)
    settings = {"threshold": float(threshold), "fn_fp_ratio": float(fn_fp_ratio)}
    settings.update({k: float(v) for k, v in (run or {}).items() if v is not None})
    parts = [
        to_metrics(provenance, "provenance", provenance.columns),
        to_metrics(test, "test", test.columns),
        to_metrics(provenance.select(*[F.lit(v).alias(k) for k, v in settings.items()]),
                   "run", list(settings)),
    ]
    if oof is not None:
        report = calibration_alarm(calibration_report(oof, label, score))
        parts.append(to_metrics(report, "out_of_fold", report.columns))
    if cv_stats is not None:
        parts.append(to_metrics(cv_stats, "cross_validation", cv_stats.columns))
    if comparison is not None:
        columns = [c for c in comparison.columns if c != "model"]
        parts.append(to_metrics(comparison, "comparison", columns, "model"))
    if importance is not None:
        drivers = top_drivers(importance)
        parts.append(
            to_metrics(drivers, "drivers", ["importance_mean", "importance_std"], "feature")
        )
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out
