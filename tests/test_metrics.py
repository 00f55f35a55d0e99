from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.operators import metrics, splitting
from holdfast.operators.models import best_iteration


def frame(spark, pairs, partitions=3):
    return spark.createDataFrame(pairs, "label int, probability double").repartition(partitions)


def brute_ranking(pairs):
    pos = [p for y, p in pairs if y]
    neg = [p for y, p in pairs if not y]
    auc = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    ap = 0.0
    for s in sorted({p for _, p in pairs}):
        at = sum(y for y, p in pairs if p == s)
        above = [y for y, p in pairs if p >= s]
        ap += at / len(pos) * sum(above) / len(above)
    return auc, ap


@pytest.mark.parametrize("kind", ["distinct", "ties", "third"])
def test_ranking_metrics_match_brute_force(spark, kind):
    rng = np.random.default_rng(11)
    n = 400
    scores = {
        "distinct": rng.random(n), "ties": rng.integers(0, 7, n) / 7,
        "third": np.where(np.arange(n) % 3 == 0, 0.4, rng.random(n)),
    }[kind]
    labels = (rng.random(n) < 0.2 + 0.5 * scores).astype(int)
    pairs = [(int(y), float(p)) for y, p in zip(labels, scores)]
    row = metrics.ranking_metrics(frame(spark, pairs)).first()
    assert (row["roc_auc"], row["pr_auc"]) == pytest.approx(brute_ranking(pairs), abs=1e-12)


def test_ranking_metrics_by_group(spark):
    rng = np.random.default_rng(2)
    rows = [(f"m{i % 3}", int(rng.random() < 0.3), float(rng.integers(0, 40) / 40))
            for i in range(600)]
    df = spark.createDataFrame(rows, "model string, label int, probability double")
    for groups in (None, 3):
        got = {r["model"]: (r["roc_auc"], r["pr_auc"]) for r in
               metrics.ranking_metrics(df, by=["model"], groups=groups).collect()}
        for m in ("m0", "m1", "m2"):
            expected = brute_ranking([(y, p) for g, y, p in rows if g == m])
            assert got[m] == pytest.approx(expected, abs=1e-12)


def test_one_class_only(spark):
    row = metrics.ranking_metrics(frame(spark, [(0, 0.1), (0, 0.7)])).first()
    assert row["roc_auc"] is None and row["pr_auc"] == 0.0


PERFECT = [(0, 0.1), (0, 0.4), (1, 0.7), (1, 0.9)]


def test_perfect_ranking(spark):
    df = frame(spark, PERFECT)
    row = metrics.ranking_metrics(df).first()
    assert (row["roc_auc"], row["pr_auc"]) == (1.0, 1.0)
    at = metrics.metrics_at_threshold(df, 0.5).first()
    assert (at["tp"], at["fp"], at["fn"], at["tn"]) == (2, 0, 0, 2)
    best = metrics.select_threshold(df, "f1").first()
    assert 0.4 < best["threshold"] <= 0.7 and best["objective"] == 1.0


def brute_threshold(pairs, metric, ratio=10.0):
    best = (-math.inf, 0.0)
    for t in sorted({float(np.round(p, 4)) for _, p in pairs}, reverse=True):
        flags = [(y, float(np.round(p, 4)) >= t) for y, p in pairs]
        tp = sum(y and f for y, f in flags)
        fp = sum((not y) and f for y, f in flags)
        fn = sum(y and not f for y, f in flags)
        value = {
            "cost": -(ratio * fn + fp), "precision": tp / (tp + fp) if tp + fp else 0,
            "recall": tp / (tp + fn) if tp + fn else 0, "f1": 2 * tp / (2 * tp + fp + fn)
            if 2 * tp + fp + fn else 0,
        }[metric]
        if value >= best[0]:
            best = (value, t)
    return best


@pytest.mark.parametrize("metric", metrics.OBJECTIVES)
def test_threshold_search(spark, metric):
    rng = np.random.default_rng(4)
    pairs = [(int(rng.random() < 0.3), float(rng.random())) for _ in range(200)]
    pairs += [(1, 0.00005), (0, 0.00015), (1, 0.00025)]
    row = metrics.select_threshold(frame(spark, pairs), metric).first()
    value, threshold = brute_threshold(pairs, metric)
    assert (row["objective"], row["threshold"]) == pytest.approx((value, threshold), abs=1e-12)


def test_threshold_ties_take_the_smallest(spark):
    row = metrics.select_threshold(frame(spark, [(1, 0.2), (1, 0.6)]), "precision").first()
    assert row["threshold"] == 0.2


def test_threshold_edge_cases(spark):
    empty = metrics.select_threshold(frame(spark, PERFECT).filter("label = 5")).first()
    assert empty["threshold"] == 0.5 and empty["objective"] == -math.inf
    fixed = metrics.select_threshold(frame(spark, PERFECT), fixed=0.3).first()
    assert (fixed["threshold"], fixed["objective"]) == (0.3, -1.0)
    with pytest.raises(ValueError, match="unknown threshold metric"):
        metrics.select_threshold(frame(spark, PERFECT), "accuracy")


def test_operating_point_uses_unrounded_scores(spark):
    df = frame(spark, [(1, 0.29996), (0, 0.1)])
    threshold = metrics.select_threshold(df).first()["threshold"]
    assert threshold == 0.3
    assert metrics.confusion_counts(df, threshold).first()["fn"] == 1


def test_zero_denominators(spark):
    row = metrics.metrics_at_threshold(frame(spark, [(0, 0.1)]), 0.5).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


def test_calibration_of_perfect_and_wrong_scores(spark):
    good = [(0, 0.0), (0, 0.0), (1, 1.0), (1, 1.0)]
    bad = [(0, 0.9), (0, 0.9), (1, 0.1), (1, 0.1)]
    assert tuple(metrics.calibration_report(frame(spark, good)).first()) == (0.0, 0.0)
    row = metrics.calibration_report(frame(spark, bad)).first()
    assert row["ece"] > 0.5
    assert metrics.calibration_alarm(metrics.calibration_report(frame(spark, bad))).first()["alarm"]


def test_bins_match_digitize(spark):
    values = [0.0, 0.05, 0.1, 0.2, 0.3, 0.30000000000000004, 0.6, 0.7, 0.9999, 1.0]
    edges = np.linspace(0, 1, 11)
    assert metrics.bin_edges(10) == list(edges)
    df = frame(spark, [(1, v) for v in values])
    table = metrics.reliability_table(df).orderBy("bin").collect()
    expected = np.digitize(values, edges[1:-1])
    assert [r["bin"] for r in table] == sorted(set(expected))
    assert [r["count"] for r in table] == [list(expected).count(b) for b in sorted(set(expected))]
    line = metrics.reliability_rows(metrics.reliability_table(df)).orderBy("bin").first()["line"]
    assert line == "0.00,0.10,2,0.0250,1.0000"


def test_ece_two_ways(spark):
    rng = np.random.default_rng(8)
    df = frame(spark, [(int(rng.random() < 0.4), float(rng.random())) for _ in range(300)])
    two_step = metrics.calibration_error(metrics.reliability_table(df)).first()["ece"]
    one_step = metrics.calibration_report(df).first()
    assert one_step["ece"] == pytest.approx(two_step, abs=1e-12)
    assert one_step["brier"] == pytest.approx(metrics.brier_score(df).first()["brier"], abs=1e-12)


def test_classification_report(spark):
    rows = {r["row"]: r for r in metrics.classification_report(
        frame(spark, [(1, 0.9), (1, 0.2), (0, 0.8), (0, 0.1), (0, 0.3)]), 0.5).collect()}
    assert rows["1"]["precision"] == 0.5 and rows["1"]["recall"] == 0.5
    assert rows["0"]["recall"] == pytest.approx(2 / 3) and rows["0"]["support"] == 3
    assert rows["accuracy"]["f1"] == pytest.approx(0.6)
    assert rows["weighted avg"]["recall"] == pytest.approx(0.6)


def test_quota_and_fold_sizes():
    assert splitting.stratified_quota({0: 4232, 1: 841}, 1015) == {0: 847, 1: 168}
    assert splitting.stratified_quota({0: 1, 1: 1, 2: 1}, 1) == {0: 1, 1: 0, 2: 0}
    sizes = splitting.fold_sizes({0: 7, 1: 6}, 5)
    assert [sum(sizes[c][f] for c in sizes) for f in range(5)] == [3, 3, 3, 2, 2]
    assert all(max(s) - min(s) <= 1 for s in sizes.values())


def test_folds_are_balanced_and_stable(spark):
    df = spark.range(103).withColumn("y", (F.col("id") % 3 == 0).cast("int"))
    first = {r["id"]: (r["y"], r["fold"]) for r in
             splitting.stratified_folds(df, "id", "y", 5, 1).collect()}
    again = {r["id"]: (r["y"], r["fold"]) for r in
             splitting.stratified_folds(df.repartition(9), "id", "y", 5, 1).collect()}
    assert first == again
    for y in (0, 1):
        sizes = [list(first.values()).count((y, f)) for f in range(5)]
        assert max(sizes) - min(sizes) <= 1
    other = {r["id"]: r["fold"] for r in
             splitting.stratified_folds(df, "id", "y", 5, 2).collect()}
    assert other != {i: f for i, (_, f) in first.items()}
    with pytest.raises(ValueError):
        splitting.stratified_folds(df, "id", "y", 1, 1)


def test_weights(spark):
    assert splitting.balanced_weights({0: 30, 1: 10}) == {0: 40 / 60, 1: 2.0}
    row = splitting.class_ratio(frame(spark, PERFECT), "label").first()
    assert (row["n_negative"], row["n_positive"], row["ratio"]) == (2, 2, 1.0)
    with pytest.raises(ValueError, match="nulls"):
        splitting.class_counts(spark.createDataFrame([(None,), (1,)], "y int"), "y")


def test_best_iteration():
    assert best_iteration([5, 4, 3, 3.5, 3.4, 3.3], 3) == (3, True)
    assert best_iteration([5, 4, 3], 3) == (3, False)
    assert best_iteration([5, 4, 4.5, 4.2, 1], 2) == (2, True)


def test_fold_summary_uses_population_deviation(spark):
    df = spark.createDataFrame([(0, 0.5, 0.6), (1, 0.7, 0.8)], "fold int, pr_auc double, "
                               "roc_auc double")
    row = metrics.fold_summary(df).first()
    assert (row["pr_auc_mean"], row["pr_auc_std"]) == pytest.approx((0.6, 0.1))
