from __future__ import annotations

import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F
from rows import customer_rows

from holdfast.operators import boosting, calibration, importance, models, search
from holdfast.plans import records, training
from holdfast.plans.records import read_records
from holdfast.plans.scoring import flagged_count, score_batch, score_files
from holdfast.session import staging_path
from holdfast.sources.bundles import RunBundle, load_bundle, runs_table, save_bundle
from holdfast.sources.sinks import write_table
from holdfast.streaming.scoring import score_arrivals


@pytest.fixture(scope="module")
def run(spark, customers):
    root = staging_path(spark, "bundles")
    result = training.train(
        customers, model="random_forest", params={"numTrees": 8, "maxDepth": 4}, cv=3,
        skip_validation=True, importance_repeats=2, bundle_root=root,
    )
    return root, result


def test_training_job(spark, run):
    _, result = run
    values = {(r["section"], r["item"], r["metric"]): r["value"] for r in result.results.collect()}
    assert values["provenance", "", "raw_rows"] == 180
    assert values["test", "", "n_rows"] == 36
    assert values["test", "", "pr_auc"] > 0.8
    assert result.oof.rows.count() == 144
    assert result.oof.rows.select("row_key").distinct().count() == 144
    assert {s for s, _, _ in values} >= {
        "provenance", "test", "run", "out_of_fold", "cross_validation", "drivers"
    }
    top = importance.top_drivers(result.importance, 2).collect()
    assert {r["feature"] for r in top} & {"SatisfactionScore", "Complain"}


def test_bundle_round_trip_scores_alike(spark, customers, run):
    root, result = run
    loaded = load_bundle(spark, root, result.bundle.run_id)
    assert loaded.schema == result.bundle.schema
    assert loaded.threshold == result.bundle.threshold
    batch = customers.drop("Churn")
    scored = [
        {r["CustomerID"]: r["churn_probability"] for r in score_batch(
            batch, b.model, b.schema, b.medians, b.threshold).collect()}
        for b in (loaded, result.bundle)
    ]
    assert scored[0] == scored[1] and len(scored[0]) == 180


def test_latest_finished_final_run_wins(spark, run):
    _, result = run
    root = staging_path(spark, "runs")
    with pytest.raises(LookupError, match="train a model first"):
        load_bundle(spark, root)
    for run_id, kind in (("a", "final"), ("b", "final"), ("c", "comparison")):
        save_bundle(spark, root, replace(result.bundle, run_id=run_id), kind)
    assert load_bundle(spark, root).run_id == "b"
    assert load_bundle(spark, root, "a").run_id == "a"
    with pytest.raises(LookupError, match="'zz'"):
        load_bundle(spark, root, "zz")
    assert runs_table(spark, root).count() == 3


def test_scoring_keeps_every_customer(spark, run):
    _, result = run
    b = result.bundle
    rows, schema = customer_rows(6)
    batch = spark.createDataFrame(
        [r[:2] + ("Nonbinary",) + r[3:4] + ("Crypto",) + r[5:6] + (None,) + r[7:] for r in rows]
        + [rows[0][:1] + (None,) + rows[0][2:]], schema
    ).drop("CashbackAmount")
    with pytest.warns(UserWarning, match="Gender"):
        scored = score_batch(batch, b.model, b.schema, b.medians, b.threshold)
    got = scored.collect()
    assert len(got) == 7
    p = [r["churn_probability"] for r in got]
    assert p == sorted(p, reverse=True) and all(0 <= x <= 1 for x in p)
    assert all(r["churn_prediction"] == int(r["churn_probability"] >= b.threshold) for r in got)
    named = score_batch(batch.withColumnRenamed("CustomerID", "member"), b.model, b.schema,
                        b.medians, b.threshold, "member", check_drift=False)
    assert named.columns[0] == "member" and named.count() == 7
    bare = score_batch(batch.drop("CustomerID"), b.model, b.schema, b.medians, b.threshold,
                       check_drift=False)
    assert bare.columns == ["churn_probability", "churn_prediction"] and bare.count() == 7


def test_absent_feature_is_zero_and_null_is_the_median(spark, run):
    from holdfast.plans.scoring import feature_rows

    b = run[1].bundle
    batch = spark.createDataFrame([(1, None)], "CustomerID long, Tenure double")
    row = feature_rows(batch, b.schema, b.medians).first()
    assert row["Tenure"] == b.medians["Tenure"] and row["Tenure_missing"] == 1.0
    assert row["CashbackAmount"] == 0.0


def test_score_files_and_stream_agree(spark, customers, run, tmp_path):
    root, result = run
    batch, output = str(tmp_path / "batch"), str(tmp_path / "out")
    write_table(customers.drop("Churn"), batch)
    stored = score_files(spark, batch, output, root)
    row = flagged_count(stored).first()
    assert row["n_scored"] == 180 and 0 < row["n_flagged"] < 180
    query = score_arrivals(
        spark, batch, customers.drop("Churn").schema, result.bundle,
        str(tmp_path / "stream"), str(tmp_path / "progress"),
    )
    query.awaitTermination()
    streamed = spark.read.parquet(str(tmp_path / "stream"))
    assert sorted(map(tuple, streamed.collect())) == sorted(map(tuple, stored.collect()))


def test_registry():
    assert [c.name for c in models.candidates()] == [
        "random_forest", "boosted_balanced", "boosted_sampled"
    ]
    assert models.candidate("random_forest").estimator(1).getNumTrees() == 400
    boosted = models.candidate("boosted_sampled").estimator(1)
    assert (boosted.getStepSize(), boosted.getMaxDepth(), boosted.getSubsamplingRate(), boosted.getMaxIter()) == (
        0.05, 6, 0.8, 2000)
    with pytest.raises(ValueError, match="random_forest, boosted_balanced"):
        models.candidate("nope")
    with pytest.raises(ValueError, match="boosting search"):
        training.tuned_candidate("random_forest", {})


def noisy_rows(spark, n, seed):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = (rng.random(n) < 1 / (1 + np.exp(-2 * x[:, 0]))).astype(int)
    df = spark.createDataFrame(
        [(i, int(y[i]), *map(float, x[i])) for i in range(n)],
        "row_key long, Churn int, a double, b double, c double",
    )
    return models.assemble(df, ["a", "b", "c"], "Churn", "row_key")


def test_early_stopping_finds_the_best_iteration(spark):
    train, held = noisy_rows(spark, 400, 1).persist(), noisy_rows(spark, 300, 2).persist()
    one = F.lit(1.0)
    est = GBTClassifier(labelCol="label", weightCol="weight", maxIter=24, stepSize=0.5, seed=3,
                        maxDepth=4)
    train, held = train.withColumn("weight", one), held.withColumn("weight", one)
    full = est.fit(train).evaluateEachIteration(held)
    model, best = models.fit_with_early_stopping(est, train, held, rounds=4)
    assert best == models.best_iteration(full, 4)[0] == model.getNumTrees
    assert model.evaluateEachIteration(held)[-1] == pytest.approx(full[best - 1])


def own_boosting(x, y, w, rounds, step, max_leaves, max_depth, least, l1, l2):
    """(margins after each round, splits): leaf by leaf, every leaf looked at anew before each split."""
    base = np.log((w * y).sum() / (w * (1 - y)).sum())
    margin, after, made = np.full(len(y), base), [], []

    def score(g, h):
        return max(abs(g) - l1, 0) ** 2 / (h + l2)

    for k in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        g, h = w * (p - y), w * p * (1 - p)
        leaves, depth = {0: np.arange(len(y))}, {0: 0}
        while len(leaves) < max_leaves:
            found = []
            for node, rows in leaves.items():
                if depth[node] >= max_depth:
                    continue
                for f in range(x.shape[1]):
                    for cut in sorted(set(x[rows, f]))[:-1]:
                        a, b = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                        if min(len(a), len(b)) >= least:
                            gain = (score(g[a].sum(), h[a].sum()) + score(g[b].sum(), h[b].sum())
                                    - score(g[rows].sum(), h[rows].sum()))
                            found.append((-gain, node, f, cut, a, b))
            best = min(found, key=lambda s: (round(s[0], 9), *s[1:4]), default=None)
            if best is None or -best[0] <= 1e-12:
                break
            _, node, f, cut, a, b = best
            new = 2 * len(made_here(made, k)) + 1
            made.append((k, node, f, -best[0], len(a), len(b)))
            leaves.pop(node)
            leaves.update({new: a, new + 1: b})
            depth.update({new: depth[node] + 1, new + 1: depth[node] + 1})
        for rows in leaves.values():
            total = g[rows].sum()
            margin[rows] -= step * np.sign(total) * max(abs(total) - l1, 0) / (h[rows].sum() + l2)
        after.append(margin.copy())
    return after, made


def made_here(made, k):
    return [m for m in made if m[0] == k]


@pytest.mark.parametrize("leaves, depth, l1, l2", [(5, 0, 0.0, 0.0), (0, 2, 0.5, 1.0), (12, 4, 0.0, 2.0)])
def test_boosting_is_brute_force(spark, leaves, depth, l1, l2):
    rng = np.random.default_rng(leaves)
    x = rng.integers(0, 7, (300, 3)).astype(float)
    y = (rng.random(300) < 1 / (1 + np.exp(1 - x[:, 0] * (x[:, 1] > 2)))).astype(int)
    w = np.where(y == 1, 2.0, 1.0)
    rows = spark.createDataFrame([(int(b), float(c), *map(float, a)) for a, b, c in zip(x, y, w)],
                                 "label int, weight double, a double, b double, c double").repartition(3)
    vectors = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(rows)
    booster = boosting.HistogramBooster(
        weightCol="weight", maxIter=4, stepSize=0.3, maxLeaves=leaves, maxDepth=depth, minInstancesPerNode=5.0,
        regAlpha=l1, regLambda=l2)
    model, n, _, splits = booster.fit_stopped(vectors)
    margins, made = own_boosting(x, y, w, 4, 0.3, leaves or 10**6, depth or 10**6, 5, l1, l2)
    assert n == 4 and [(k, node, s.feature, s.left[2], s.right[2]) for k, node, s in splits] == [
        (k, node, f, a, b) for k, node, f, _, a, b in made]
    assert [s.gain for _, _, s in splits] == pytest.approx([m[3] for m in made])
    wanted = {tuple(a): 1 / (1 + np.exp(-m)) for a, m in zip(x, margins[-1])}
    for r in model.transform(vectors).collect():
        assert r["prediction"] == pytest.approx(wanted[r["a"], r["b"], r["c"]])


def test_boosting_stops_without_a_refit(spark, monkeypatch):
    train, held = noisy_rows(spark, 400, 1).persist(), noisy_rows(spark, 300, 2).persist()
    monkeypatch.setattr(boosting, "STORE_EVERY", 2)
    booster = boosting.HistogramBooster(maxIter=40, stepSize=0.4, maxLeaves=4, maxDepth=0, subsamplingRate=0.7,
                                        featureShare=0.5, subsamplingFreq=2)
    model, best, losses, _ = booster.fit_stopped(train, held, 4)
    assert best == model.getNumTrees == int(np.argmin(losses)) and len(losses) == best + 5
    scored = model.transform(held).select("label", "prediction").collect()
    assert losses[best] == pytest.approx(-np.mean([np.log(p if y else 1 - p) for y, p in scored]))
    monkeypatch.setattr(boosting, "STORE_EVERY", 16)
    prefix, _, _, _ = booster.copy({booster.maxIter: best}).fit_stopped(train)
    again = prefix.transform(held).select("prediction").collect()
    assert [r[0] for r in again] == pytest.approx([p for _, p in scored])


def test_boosting_of_few_rows(spark):
    rows = noisy_rows(spark, 30, 3)
    empty = rows.filter("label > 1")
    for part, wanted in ((empty, 0.5), (rows.filter("label = 1"), 1.0)):
        model = boosting.HistogramBooster(maxIter=3).fit(part)
        assert {round(r["prediction"], 6) for r in model.transform(rows).collect()} == {wanted}
    assert boosting.HistogramBooster().fit(rows).transform(empty).collect() == []


def test_search_learns(spark):
    space = {"a": search.Dimension(0.0, 1.0), "b": search.Dimension(1e-4, 10.0, "log"), "c": search.Dimension(1, 40, "int")}

    def score(p):
        return -((p["a"] - 0.7) ** 2) - (np.log10(p["b"]) / 5 + 0.3) ** 2 - ((p["c"] - 9) / 40) ** 2

    better = 0
    for seed in range(12):
        rng, trials = random.Random(seed), []
        for _ in range(15):
            trials += [(p, score(p)) for p in [search.propose(space, trials, rng) for _ in range(4)]]
        assert all(1 <= p["c"] <= 40 and isinstance(p["c"], int) and 1e-4 <= p["b"] <= 10 for p, _ in trials)
        drawn = [{k: d.from_unit(rng.random()) for k, d in space.items()} for _ in range(60)]
        better += max(s for _, s in trials) > max(map(score, drawn))
    assert better >= 10
    assert search.propose(space, [], random.Random(3)) == search.propose(space, [], random.Random(3))


def test_isotonic_matches_pool_adjacent_violators(spark):
    rng = np.random.default_rng(6)
    p = np.round(rng.random(300), 2)
    y = (rng.random(300) < p).astype(int)
    df = spark.createDataFrame(
        [(float(a), int(b)) for a, b in zip(p, y)], "raw_probability double, label int"
    )
    fitted = calibration.fit_calibrator(df, "isotonic")
    grid = sorted(set(p))
    blocks = []
    for v in grid:
        blocks.append([float(y[p == v].sum()), float((p == v).sum()), [v]])
        while len(blocks) > 1 and blocks[-2][0] / blocks[-2][1] >= blocks[-1][0] / blocks[-1][1]:
            last = blocks.pop()
            blocks[-1] = [blocks[-1][0] + last[0], blocks[-1][1] + last[1],
                          blocks[-1][2] + last[2]]
    expected = {v: s / n for s, n, vs in blocks for v in vs}
    got = fitted.apply(
        spark.createDataFrame([(float(v),) for v in grid], "raw_probability double")).collect()
    for r in got:
        assert r["churn_probability"] == pytest.approx(expected[r["raw_probability"]], abs=1e-9)
    beyond = fitted.apply(spark.createDataFrame([(-1.0,), (2.0,)], "raw_probability double"))
    assert [r["churn_probability"] for r in beyond.collect()] == pytest.approx(
        [expected[grid[0]], expected[grid[-1]]])


def test_isotonic_of_many_scores(spark):
    """Every score its own, more ranges than steps in some, and steps that span ranges."""
    rng = np.random.default_rng(11)
    p = rng.random(60_000)
    y = (rng.random(60_000) < np.where(p < 0.5, 0.3, p)).astype(int)
    rows = spark.createDataFrame([(float(a), 1.0, float(b)) for a, b in zip(p, y)], "raw double, n double, positives double")
    steps = sorted(map(tuple, calibration.isotonic_blocks(rows.repartition(7), "raw").collect()))
    order = np.argsort(p)
    wanted = []
    for x, label in zip(p[order], y[order]):
        wanted.append([x, x, 1, label])
        while len(wanted) > 1 and wanted[-2][3] / wanted[-2][2] >= wanted[-1][3] / wanted[-1][2]:
            low, high = wanted[-2], wanted.pop()
            wanted[-1] = [low[0], high[1], low[2] + high[2], low[3] + high[3]]
    assert steps == [tuple(map(float, w)) for w in wanted]
    odd = spark.createDataFrame([(None, 1.0, 1.0), (float("nan"), 1.0, 0.0)], "raw double, n double, positives double")
    assert calibration.isotonic_blocks(odd, "raw").collect() == []


def test_sigmoid_minimizes_the_smoothed_loss(spark):
    rng = np.random.default_rng(9)
    p = rng.random(400)
    y = (rng.random(400) < 1 / (1 + np.exp(-(3 * p - 1)))).astype(int)
    df = spark.createDataFrame(
        [(float(a), int(b)) for a, b in zip(p, y)], "raw_probability double, label int"
    )
    model = calibration.fit_calibrator(df, "sigmoid").model
    a, b = float(model.coefficients[0]), float(model.intercept)
    target = np.where(y == 1, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    q = 1 / (1 + np.exp(-(a * p + b)))
    assert abs((q - target).mean()) < 1e-4 and abs(((q - target) * p).mean()) < 1e-4
    assert calibration.fit_calibrator(df, "none") is None
    with pytest.raises(ValueError, match="unknown calibration"):
        calibration.fit_calibrator(df, "spline")


def test_probability_from_what_the_model_leaves(spark):
    from pyspark.ml.linalg import Vectors

    df = spark.createDataFrame([(Vectors.dense(-1.0, 1.0), 1.0)], ["rawPrediction", "prediction"])
    got = df.select(models.positive_probability(df).alias("p")).first()["p"]
    assert got == pytest.approx(1 / (1 + np.exp(-1)))
    bare = df.drop("rawPrediction")
    assert bare.select(models.positive_probability(bare).alias("p")).first()["p"] == 1.0


def test_out_of_fold_rows_are_repeatable(spark):
    rows = noisy_rows(spark, 200, 4)
    chosen = models.candidate("random_forest").with_params(numTrees=4, maxDepth=3)
    runs = [
        {r["row_key"]: (r["fold"], r["probability"]) for r in training.cross_val_oof(
            rows, chosen, cv=3, calibrate=c, parallelism=p).rows.collect()}
        for c, p in (("sigmoid", 1), ("sigmoid", 3))
    ]
    assert runs[0] == runs[1] and len(runs[0]) == 200


def test_comparison_and_search(spark):
    rows = noisy_rows(spark, 240, 5)
    short = [models.candidate(n).with_params(**p) for n, p in (
        ("random_forest", {"numTrees": 4, "maxDepth": 3}),
        ("boosted_balanced", {"maxIter": 3, "maxDepth": 2}))]
    table = training.compare_models(rows, models=short, cv=2, rounds=2).collect()
    assert {r["model"] for r in table} == {"random_forest", "boosted_balanced"}
    assert table[0]["cv_pr_auc"] >= table[1]["cv_pr_auc"] and table[0]["cv_pr_auc"] > 0.6
    found = training.tune_model(rows, "boosted_sampled", n_trials=2, cv=2,
                                overrides={"maxIter": 2, "maxDepth": 2})
    scores = {r["trial"]: r["score"] for r in found.trials.collect()}
    assert found.best == found.params[max(scores, key=lambda t: (scores[t], -t))]
    space = {k: d for k, d in training.SPACES["boosted_sampled"].items() if k not in ("maxIter", "maxDepth")}
    again = search.propose(space, [], random.Random(42))
    assert again == {k: v for k, v in found.params[0].items() if k in space}
    assert training.tuned_candidate("boosted_sampled", found.best).estimator().getMaxIter() == 2
    with pytest.raises(ValueError, match="scoring"):
        training.tune_model(rows, scoring="recall")
    with pytest.raises(ValueError, match="no search"):
        training.tune_model(rows, "random_forest", n_trials=1)


def test_every_row_donates_once_per_repeat(spark):
    df = spark.range(300).select(
        F.col("id").alias("row_key"), F.array(F.col("id").cast("double")).alias("values"))
    rows = importance.with_donors(df, "row_key", "values", 3, 1).collect()
    orders = []
    for repeat in (1, 2, 3):
        donors = {r["row_key"]: int(r["donor"][0]) for r in rows if r["repeat"] == repeat}
        assert sorted(donors.values()) == list(range(300))
        assert all(k != d for k, d in donors.items())
        orders.append(donors)
    assert orders[0] != orders[1] != orders[2]


def test_importance_finds_the_signal(spark):
    rows = noisy_rows(spark, 500, 8).persist()
    model, _, _ = models.fit_candidate(
        models.candidate("random_forest").with_params(numTrees=10, maxDepth=4), rows, rows)
    table = importance.permutation_importance(
        models.ScoringModel(PipelineModel([model])), rows, ["a", "b", "c"], "row_key", repeats=3)
    got = {r["feature"]: r["importance_mean"] for r in table.collect()}
    assert got["a"] > 0.1 and got["a"] > 3 * max(got["b"], got["c"])


def test_bundle_without_calibrator(spark, run):
    b = run[1].bundle
    plain = RunBundle("plain", b.model_name, models.ScoringModel(b.model.pipeline), b.schema,
                      b.medians, 0.5)
    root = staging_path(spark, "plain")
    save_bundle(spark, root, plain)
    assert load_bundle(spark, root).model.calibrator is None


def test_record_of_a_run_is_stored_with_it(spark, run):
    root, result = run
    rows = read_records(spark, root, result.bundle.run_id).collect()
    found = {(r["section"], r["item"], r["metric"]): (r["number"], r["text"]) for r in rows}
    assert len(found) == len(rows) and {r["run_id"] for r in rows} == {result.bundle.run_id}
    assert found["run", "", "model"] == (None, "random_forest")
    assert found["run", "", "parameters"] == (None, '{"maxDepth": 4, "numTrees": 8}')
    assert found["run", "", "gate_skipped"] == (1.0, None)
    assert found["run", "", "scored_rows"] == (36.0, None) and found["run", "", "rows_per_second"][0] > 0
    assert found["class_report", "accuracy", "support"] == (36.0, None)
    assert found["input", "", "n_rows"][0] == 180 and "-" in found["input", "", "digest"][1]
    features = {item for section, item, _ in found if section == "importance"}
    assert features == set(result.bundle.schema.feature_columns)
    for r in result.results.collect():
        assert found[r["section"], r["item"], r["metric"]][0] == pytest.approx(r["value"], nan_ok=True)


def test_records_are_seen_with_their_run_only(spark, run):
    _, result = run
    root = staging_path(spark, "bundles")
    assert read_records(spark, root).collect() == []
    record = records.fact_rows(spark, "run", {"a": 1, "b": "x", "c": None, "d": True}).selectExpr("'one' AS run_id", "*")
    save_bundle(spark, root, replace(result.bundle, run_id="one"), record=record)
    save_bundle(spark, root, replace(result.bundle, run_id="two"))
    record.write.parquet(f"{root}/three/record")  # a run that was stopped before it was finished
    assert {tuple(r)[3:] for r in read_records(spark, root).collect()} == {
        ("a", 1.0, None), ("b", None, "x"), ("c", None, None), ("d", 1.0, None)}
    assert read_records(spark, root, "two").collect() == []


def test_blocks_are_read_one_at_a_time():
    """Whole batches were copied to Python, and one was kept while the next was read."""
    import pyarrow as pa

    held = []

    def batches():
        start = pa.total_allocated_bytes()
        for _ in range(4):
            held.append(pa.total_allocated_bytes() - start)
            values = pa.array([bytes(1 << 18)] * 4, pa.binary())
            batch = pa.RecordBatch.from_arrays([pa.array([0, 1, 2, 3]), values], names=["block", "bins"])
            del values
            yield batch
            del batch

    assert [block["block"] for block in boosting._one_by_one(batches())] == [0, 1, 2, 3] * 4
    assert held == [0] * 4


def test_models_share_the_inner_splits(spark, monkeypatch):
    """Every model split the rows outside each fold anew."""
    from pyspark.ml.feature import SQLTransformer

    made, split = [], training.holdout_split

    def counted(*arguments, **options):
        made.append(arguments[4])
        return split(*arguments, **options)

    def constant(chosen, train, held, **options):
        assert train.columns == held.columns and train.count() > held.count() > 0
        return SQLTransformer(statement="SELECT *, 0.5D AS prediction FROM __THIS__"), None, None

    monkeypatch.setattr(training, "holdout_split", counted)
    monkeypatch.setattr(training, "fit_candidate", constant)
    rows = VectorAssembler(inputCols=["x"], outputCol="features").transform(
        spark.range(60).selectExpr("id AS row_key", "CAST(id % 3 = 0 AS INT) AS label", "id * 1.0D AS x")).drop("x")
    assert training.compare_models(rows, cv=2, rounds=2).count() == 3
    assert sorted(made) == [42, 43]


def test_registered_comparison_is_the_whole_job(spark, small, monkeypatch):
    """It compared 20 trees of depth 6 and 8 rounds with a patience of 4, in 2 folds."""
    from pyspark.ml.feature import SQLTransformer

    from holdfast.catalog import QUERIES

    fits = []

    def constant(chosen, train, held, *, rounds, early_stopping, **options):
        made = chosen.estimator()
        size = (made.getNumTrees(), made.getMaxDepth()) if chosen.name == "random_forest" else (made.getMaxIter(), rounds)
        fits.append((chosen.name, size, early_stopping))
        return SQLTransformer(statement="SELECT *, 0.5D AS prediction FROM __THIS__"), None, None

    monkeypatch.setattr(training, "fit_candidate", constant)
    table = QUERIES["f11_compare_models"](spark, small).collect()
    assert {r["model"] for r in table} == {c.name for c in models.candidates()}
    assert sorted(fits) == sorted(5 * [
        ("boosted_balanced", (2000, 50), True), ("boosted_sampled", (2000, 50), True), ("random_forest", (400, 30), True)])


def test_boosting_in_one_task_and_by_passes_is_the_same(spark, monkeypatch):
    """Every round of a small table took about fifteen jobs."""
    train, held = noisy_rows(spark, 400, 11).repartition(3), noisy_rows(spark, 150, 12)
    booster = boosting.HistogramBooster(
        maxIter=30, stepSize=0.3, maxLeaves=6, subsamplingRate=0.7, subsamplingFreq=2, featureShare=0.7, regAlpha=0.01)

    def by_passes(blocks, cuts, options):
        return boosting._boosted(boosting._Spread(boosting._together(blocks, 1), cuts, options), len(cuts), options)

    asked = []
    with monkeypatch.context() as patch:
        patch.setattr(boosting, "_pass", lambda *a: asked.append(a))
        alone = booster.fit_stopped(train, held, 5)
        whole = booster.copy({booster.maxIter: 6}).fit_stopped(train)
    assert not asked
    monkeypatch.setattr(boosting, "STORE_EVERY", 3)
    monkeypatch.setattr(boosting, "_boosted_alone", by_passes)
    for got, wanted in ((alone, booster.fit_stopped(train, held, 5)), (whole, booster.copy({booster.maxIter: 6}).fit_stopped(train))):
        assert got[1] == wanted[1] and got[2] == pytest.approx(wanted[2])
        assert [(k, node, s.feature, s.cut, s.left[2]) for k, node, s in got[3]] == [
            (k, node, s.feature, s.cut, s.left[2]) for k, node, s in wanted[3]]
        assert [s.gain for _, _, s in got[3]] == pytest.approx([s.gain for _, _, s in wanted[3]])
        own, other = ([v for t in model._parts()[2] for v in t.value] for model in (got[0], wanted[0]))
        assert own == pytest.approx(other)
