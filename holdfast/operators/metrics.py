"""Evaluation of probabilities: ranking quality, operating points, thresholds, calibration.

Everything takes a long table of labels and probabilities, optionally with group columns (model,
fold, feature, ...), and answers for all groups in one job. Rows with equal scores are combined
before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.arithmetic import edges_below, ratio_or_zero, round_half_even
from holdfast.operators.ranking import bounded_broadcast, bucket_count, quantile_edges

OBJECTIVES = ("cost", "precision", "recall", "f1")
CALIBRATION_ALARM = 0.05


def _positives(label: str) -> Column:
    return F.count(F.when(F.col(label) == 1, 1))


def score_points(
    df: DataFrame, label: str = "label", score: str = "probability", by: Sequence[str] = ()
) -> DataFrame:
    """(by, score, pos, neg): rows of equal score combined."""
    return df.groupBy(*by, F.col(score).alias("score")).agg(
        _positives(label).alias("pos"),
        (F.count(F.lit(1)) - _positives(label)).alias("neg"),
    )


def score_curve(points: DataFrame, by: Sequence[str] = (), groups: int | None = None
                ) -> DataFrame:
    """Add tp, fp, total_pos and total_neg to score points.

    ``tp`` and ``fp`` count the rows scored at least as high. They are running totals over the
    whole table: totals per bucket of scores, a running sum over the buckets, and windows inside
    them. The points are read three times.
    """
    groups = groups if by else 1
    n = bucket_count(points.sparkSession, groups)
    work = points.withColumn("__v", -F.col("score"))
    edges = quantile_edges(work, F.col("__v"), n)
    work = work.withColumn("__b", edges_below(edges, F.col("__v"), n - 1).cast("int"))
    ordered = Window.partitionBy(*by).orderBy("__b")
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    offsets = (
        work.groupBy(*by, "__b")
        .agg(F.sum("pos").alias("p"), F.sum("neg").alias("q"))
        .select(
            *by, "__b",
            F.coalesce(F.sum("p").over(before), F.lit(0)).alias("__tp"),
            F.coalesce(F.sum("q").over(before), F.lit(0)).alias("__fp"),
            F.sum("p").over(whole).alias("total_pos"),
            F.sum("q").over(whole).alias("total_neg"),
        )
    )
    inside = (
        Window.partitionBy(*by, "__b").orderBy("__v")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return work.join(bounded_broadcast(offsets, groups), [*by, "__b"], "left").select(
        *by, "score", "pos", "neg",
        (F.col("__tp") + F.sum("pos").over(inside)).alias("tp"),
        (F.col("__fp") + F.sum("neg").over(inside)).alias("fp"),
        "total_pos", "total_neg",
    )


def ranking_metrics(
    df: DataFrame, label: str = "label", score: str = "probability", by: Sequence[str] = (),
    groups: int | None = None,
) -> DataFrame:
    """(by, roc_auc, pr_auc), exact and tie-aware; the scores should be stored.

    PR-AUC is average precision, the step sum over distinct scores. ROC-AUC is null when a class is
    missing; average precision is 0 without positives.
    """
    return curve_areas(score_curve(score_points(df, label, score, by), by, groups), by)


def curve_areas(curve: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, roc_auc, pr_auc) of a score curve."""
    pos, neg, tp, fp = (F.col(c).cast("double") for c in ("pos", "neg", "tp", "fp"))
    area = F.sum(neg * (tp - pos / F.lit(2.0)))
    total_pos = F.max("total_pos").cast("double")
    total_neg = F.max("total_neg").cast("double")
    return curve.groupBy(*by).agg(
        F.try_divide(area, total_pos * total_neg).alias("roc_auc"),
        F.coalesce(F.try_divide(F.sum(pos * tp / (tp + fp)), total_pos), F.lit(0.0))
        .alias("pr_auc"),
    )


def confusion_counts(
    df: DataFrame, threshold: Column | float, label: str = "label", score: str = "probability",
    by: Sequence[str] = (),
) -> DataFrame:
    """(by, tn, fp, fn, tp) where a row is positive if its unrounded score reaches the threshold."""
    cut = threshold if isinstance(threshold, Column) else F.lit(float(threshold))
    flagged = F.col(score) >= cut
    churned = F.col(label) == 1
    return df.groupBy(*by).agg(
        F.count(F.when(~flagged & ~churned, 1)).alias("tn"),
        F.count(F.when(flagged & ~churned, 1)).alias("fp"),
        F.count(F.when(~flagged & churned, 1)).alias("fn"),
        F.count(F.when(flagged & churned, 1)).alias("tp"),
    )


def operating_rates(counts: DataFrame) -> DataFrame:
    """Add precision, recall and f1 to confusion counts; a zero denominator gives 0."""
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counts.withColumns({
        "precision": ratio_or_zero(tp, tp + fp),
        "recall": ratio_or_zero(tp, tp + fn),
        "f1": ratio_or_zero(2 * tp, 2 * tp + fp + fn),
    })


def with_expected_cost(counts: DataFrame, fn_fp_ratio: float = 10.0) -> DataFrame:
    """Add the cost in false positives: a missed churner counts ``fn_fp_ratio``."""
    return counts.withColumn(
        "cost", F.lit(float(fn_fp_ratio)) * F.col("fn") + F.col("fp")
    )


def metrics_at_threshold(
    df: DataFrame, threshold: Column | float, label: str = "label", score: str = "probability",
    by: Sequence[str] = (),
) -> DataFrame:
    return operating_rates(confusion_counts(df, threshold, label, score, by))


def threshold_curve(
    df: DataFrame, label: str = "label", score: str = "probability", by: Sequence[str] = ()
) -> DataFrame:
    """(by, threshold, tp, fp, fn) at every distinct score rounded to 4 places, ties to even.

    At most 10,001 rows per group, whatever the size of the input; the window runs over those.
    """
    points = df.groupBy(*by, round_half_even(F.col(score), 4).alias("threshold")).agg(
        _positives(label).alias("pos"), F.count(F.lit(1)).alias("n")
    )
    upward = (
        Window.partitionBy(*by).orderBy(F.col("threshold").desc())
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    whole = Window.partitionBy(*by)
    tp, n = F.sum("pos").over(upward), F.sum("n").over(upward)
    return points.select(
        *by, "threshold", tp.alias("tp"), (n - tp).alias("fp"),
        (F.sum("pos").over(whole) - tp).alias("fn"),
    )


def with_objective(curve: DataFrame, metric: str = "cost", fn_fp_ratio: float = 10.0) -> DataFrame:
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    if metric == "cost":
        objective = -(F.lit(float(fn_fp_ratio)) * fn + fp)
    elif metric == "precision":
        objective = ratio_or_zero(tp, tp + fp)
    elif metric == "recall":
        objective = ratio_or_zero(tp, tp + fn)
    elif metric == "f1":
        objective = ratio_or_zero(2 * tp, 2 * tp + fp + fn)
    else:
        raise ValueError(f"unknown threshold metric '{metric}'; choose one of {OBJECTIVES}")
    return curve.withColumn("objective", objective.cast("double"))


def select_threshold(
    df: DataFrame, metric: str = "cost", fn_fp_ratio: float = 10.0, label: str = "label",
    score: str = "probability", by: Sequence[str] = (), *, fixed: float | None = None,
) -> DataFrame:
    """(by, threshold, objective) of the best cut; among equals the smallest threshold wins.

    ``fixed`` replaces the search: that threshold, with its objective on the unrounded scores.
    Without rows, and without groups, the answer is (0.5, -infinity).
    """
    if fixed is not None:
        counts = confusion_counts(df, fixed, label, score, by)
        return with_objective(counts, metric, fn_fp_ratio).select(
            *by, F.lit(float(fixed)).alias("threshold"), "objective"
        )
    curve = with_objective(threshold_curve(df, label, score, by), metric, fn_fp_ratio)
    best = curve.groupBy(*by).agg(
        F.max(F.struct("objective", (-F.col("threshold")).alias("down"))).alias("best")
    )
    return best.select(
        *by,
        F.coalesce(-F.col("best.down"), F.lit(0.5)).alias("threshold"),
        F.coalesce(F.col("best.objective"), F.lit(float("-inf"))).alias("objective"),
    )


def brier_score(
    df: DataFrame, label: str = "label", score: str = "probability", by: Sequence[str] = ()
) -> DataFrame:
    gap = F.col(score) - F.col(label).cast("double")
    return df.groupBy(*by).agg(F.avg(gap * gap).alias("brier"))


def bin_edges(n_bins: int) -> list[float]:
    """Equally spaced ends in doubles, so edge 3 of 10 is 0.30000000000000004."""
    step = 1.0 / n_bins
    return [i * step for i in range(n_bins)] + [1.0]


def reliability_table(
    df: DataFrame, label: str = "label", score: str = "probability", by: Sequence[str] = (),
    n_bins: int = 10,
) -> DataFrame:
    """(by, bin, bin_low, bin_high, count, mean_predicted, observed_rate), non-empty bins only.

    Bins are closed on the left; 1.0 belongs to the last one.
    """
    edges = bin_edges(n_bins)
    place = F.lit(0)
    for edge in edges[1:-1]:
        place = place + (F.col(score) >= F.lit(edge)).cast("int")
    ends = F.array(*[F.lit(e) for e in edges])
    return (
        df.groupBy(*by, place.alias("bin"))
        .agg(
            F.count(F.lit(1)).alias("count"),
            F.avg(score).alias("mean_predicted"),
            F.avg(F.col(label).cast("double")).alias("observed_rate"),
        )
        .select(
            *by, "bin", F.get(ends, F.col("bin")).alias("bin_low"),
            F.get(ends, F.col("bin") + 1).alias("bin_high"),
            "count", "mean_predicted", "observed_rate",
        )
    )


def calibration_error(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """(by, ece): the bin-weighted gap between predicted and observed rates."""
    n = F.col("count").cast("double")
    gap = F.abs(F.col("observed_rate") - F.col("mean_predicted"))
    return table.groupBy(*by).agg((F.sum(n * gap) / F.sum(n)).alias("ece"))


def calibration_report(
    df: DataFrame, label: str = "label", score: str = "probability", by: Sequence[str] = (),
    n_bins: int = 10,
) -> DataFrame:
    """(by, brier, ece) in one pass: the bins carry what the Brier score needs."""
    gap = F.col(score) - F.col(label).cast("double")
    place = F.lit(0)
    for edge in bin_edges(n_bins)[1:-1]:
        place = place + (F.col(score) >= F.lit(edge)).cast("int")
    bins = df.groupBy(*by, place.alias("bin")).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.sum(gap * gap).alias("squares"),
        F.sum(score).alias("predicted"),
        F.sum(F.col(label).cast("double")).alias("observed"),
    )
    return bins.groupBy(*by).agg(
        (F.sum("squares") / F.sum("n")).alias("brier"),
        (F.sum(F.abs(F.col("observed") - F.col("predicted"))) / F.sum("n")).alias("ece"),
    )


def reliability_rows(table: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The reliability table as text lines: ends with 2 decimals, rates with 4."""
    line = F.format_string(
        "%.2f,%.2f,%d,%.4f,%.4f", "bin_low", "bin_high", "count", "mean_predicted",
        "observed_rate",
    )
    return table.select(*by, "bin", line.alias("line"))


def calibration_alarm(errors: DataFrame, limit: float = CALIBRATION_ALARM) -> DataFrame:
    return errors.withColumn("alarm", F.col("ece") > F.lit(limit))


def classification_report(
    df: DataFrame, threshold: Column | float, label: str = "label", score: str = "probability",
    by: Sequence[str] = (),
) -> DataFrame:
    """(by, row, precision, recall, f1, support) for both classes, accuracy and two averages.

    The accuracy row carries the accuracy in all three metric columns.
    """
    counts = confusion_counts(df, threshold, label, score, by)
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def row(name: str, *values: Column) -> Column:
        names = ("precision", "recall", "f1", "support")
        return F.struct(F.lit(name).alias("row"), *[v.alias(n) for v, n in zip(values, names)])

    neg = (ratio_or_zero(tn, tn + fn), ratio_or_zero(tn, tn + fp),
           ratio_or_zero(2 * tn, 2 * tn + fn + fp), tn + fp)
    pos = (ratio_or_zero(tp, tp + fp), ratio_or_zero(tp, tp + fn),
           ratio_or_zero(2 * tp, 2 * tp + fp + fn), tp + fn)
    total = tn + fp + fn + tp
    accuracy = ratio_or_zero(tn + tp, total)
    macro = [(a + b) / F.lit(2.0) for a, b in zip(neg[:3], pos[:3])]
    weighted = [
        ratio_or_zero(a * neg[3].cast("double") + b * pos[3].cast("double"), total)
        for a, b in zip(neg[:3], pos[:3])
    ]
    rows = F.array(
        row("0", *neg), row("1", *pos), row("accuracy", accuracy, accuracy, accuracy, total),
        row("macro avg", *macro, total), row("weighted avg", *weighted, total),
    )
    return counts.select(*by, F.explode(rows).alias("r")).select(*by, "r.*")


def fold_summary(
    scores: DataFrame, metrics: Sequence[str] = ("pr_auc", "roc_auc"), by: Sequence[str] = ()
) -> DataFrame:
    """Mean and population standard deviation of each metric over the folds."""
    out = []
    for m in metrics:
        out += [F.avg(m).alias(f"{m}_mean"), F.stddev_pop(m).alias(f"{m}_std")]
    return scores.groupBy(*by).agg(*out)
