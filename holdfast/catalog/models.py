"""Model jobs: candidates, calibration, cross-validation, search, training, bundles, scoring.

The fits are kept short by parameters, but not those of the comparison; the rows are whole tables.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.catalog.evaluation import THREE_WAY_SNAPSHOT
from holdfast.catalog.inputs import (
    ALIASES, REGIONS, SNAPSHOT_RULES, rounded, scores, snapshot, with_scores, with_snapshot,
)
from holdfast.catalog.registry import query
from holdfast.operators import calibration, cleaning, importance, models
from holdfast.operators.boosting import HistogramBooster
from holdfast.operators.cleaning import ROW_KEY
from holdfast.operators.models import LABEL
from holdfast.plans import training
from holdfast.plans.prepare import PreparedSplits, prepare_model_splits
from holdfast.plans.records import read_records
from holdfast.plans.results import evaluation_metrics
from holdfast.plans.scoring import flagged_count, score_batch, score_files
from holdfast.session import stage_table, staging_path
from holdfast.sources.bundles import RunBundle, load_bundle, new_run_id, runs_table, save_bundle
from holdfast.sources.sinks import write_table


@dataclass(frozen=True)
class RecencyModel:
    """A model that SQL can repeat: d / (d + 365), less a little for every order.

    It reads the feature vector, so it stands wherever a fitted model stands.
    """

    days: int
    orders: int

    def score(self, df: DataFrame, out: str = "churn_probability") -> DataFrame:
        vector = vector_to_array(models.FEATURES)
        d, n = F.get(vector, F.lit(self.days)), F.get(vector, F.lit(self.orders))
        return df.withColumn(out, d / (d + F.lit(365.0)) / (F.lit(1.0) + n / F.lit(100.0)))


@dataclass(frozen=True)
class AssembledRecencyModel:
    """The same on separate columns, as scoring gives them."""

    def score(self, df: DataFrame, out: str = "churn_probability") -> DataFrame:
        vectors = VectorAssembler(
            inputCols=["DaySinceLastOrder", "OrderCount"], outputCol=models.FEATURES
        )
        return RecencyModel(0, 1).score(vectors.transform(df), out)


SHORT_FOREST = {"numTrees": 20, "maxDepth": 6}
SHORT_BOOST = {"maxIter": 8}
ROUNDS = 4


def _prepared(spark, folder) -> PreparedSplits:
    raw = stage_table(snapshot(spark, folder), "raw")
    cleaned = stage_table(cleaning.clean(raw, "Churn", aliases=ALIASES), "cleaned")
    prepared = prepare_model_splits(cleaned, "Churn")
    return PreparedSplits(
        stage_table(prepared.frame, "encoded"), "Churn", prepared.schema, prepared.medians
    )


def _rows(prepared: PreparedSplits, *parts: str):
    return models.assemble(
        prepared.part(*parts), prepared.feature_columns, prepared.target, ROW_KEY
    )


def _short(name: str) -> models.Candidate:
    return models.candidate(name).with_params(
        **(SHORT_FOREST if name == "random_forest" else SHORT_BOOST)
    )


def _in_range(column: str):
    """Whether a probability is one; SQL cannot repeat the fit but knows the answer."""
    return F.col(column).between(0.0, 1.0).alias("valid")


_TEST_SQL = with_snapshot("""
SELECT CustomerID AS row_key, Churn AS label, true AS valid FROM marked WHERE split = 'test'""",
    *THREE_WAY_SNAPSHOT)


def _tested(spark, folder, name):
    """Fit on train, stop on validation, report on test."""
    prepared = _prepared(spark, folder)
    final = training.fit_final(prepared, _short(name), calibrate=None, rounds=ROUNDS)
    scored = final.model.score(prepared.part("test"), "probability")
    rows = stage_table(scored.select(F.col("Churn").alias("label"), "probability"), "tested")
    return evaluation_metrics(rows, 0.5, 10.0)


@query("f1_random_forest")
def _(spark, folder):
    return _tested(spark, folder, "random_forest")


@query("f2_boosted_balanced")
def _(spark, folder):
    return _tested(spark, folder, "boosted_balanced")


_SPLIT_FEATURES = ("l_quantity", "l_discount", "l_tax", "l_linenumber")
_LEAVES, _ROUNDS, _STEP = 4, 2, 0.3


def _splits_sql() -> str:
    """Boosting step by step: each split looks at every value of every feature of every leaf."""
    some = ", ".join(f"CAST({c} AS DOUBLE) AS f{i}" for i, c in enumerate(_SPLIT_FEATURES))
    parts = [f"""r0 AS MATERIALIZED (SELECT *, ln(avg(y) OVER () / (1 - avg(y) OVER ())) AS m
  FROM (SELECT {some}, CAST(l_returnflag = 'R' AS INTEGER)::DOUBLE AS y FROM lineitem))"""]
    asked = " ".join(f"WHEN {i} THEN f{i}" for i in range(len(_SPLIT_FEATURES)))
    found = []
    for k in range(_ROUNDS):
        parts.append(f"""s{k}_0 AS MATERIALIZED (SELECT *, p - y AS g, p * (1 - p) AS h, 0 AS node
  FROM (SELECT *, 1 / (1 + exp(-m)) AS p FROM r{k}))""")
        for i in range(1, _LEAVES):
            old, values = f"s{k}_{i - 1}", " UNION ALL ".join(
                f"SELECT node, {f} AS feature, f{f} AS x, sum(g) AS g, sum(h) AS h, count(*) AS c FROM s{k}_{i - 1} GROUP BY ALL"
                for f in range(len(_SPLIT_FEATURES)))
            parts.append(f"""b{k}_{i} AS MATERIALIZED (SELECT *, gl * gl / (hl + 1) + (ga - gl) * (ga - gl) / (ha - hl + 1)
    - ga * ga / (ha + 1) AS gain
  FROM (SELECT node, feature, x, sum(g) OVER w AS gl, sum(h) OVER w AS hl, sum(c) OVER w AS cl, sum(g) OVER a AS ga,
    sum(h) OVER a AS ha, sum(c) OVER a AS ca FROM ({values})
    WINDOW w AS (PARTITION BY node, feature ORDER BY x), a AS (PARTITION BY node, feature))
  WHERE cl >= 20 AND ca - cl >= 20 AND hl >= 1e-3 AND ha - hl >= 1e-3
  ORDER BY gain DESC, node, feature, x LIMIT 1)""")
            parts.append(f"""s{k}_{i} AS MATERIALIZED (SELECT o.* REPLACE (CASE WHEN o.node <> b.node THEN o.node
    WHEN CASE b.feature {asked} END <= b.x THEN {2 * i - 1} ELSE {2 * i} END AS node) FROM {old} o, b{k}_{i} b)""")
            found.append(f"SELECT {k} AS round, node, feature, x, gain, cl, ca FROM b{k}_{i}")
        parts.append(f"""r{k + 1} AS MATERIALIZED (SELECT y, {", ".join(f"f{f}" for f in range(len(_SPLIT_FEATURES)))},
    m - {_STEP} * sum(g) OVER l / (sum(h) OVER l + 1) AS m FROM s{k}_{_LEAVES - 1} WINDOW l AS (PARTITION BY node))""")
    shape = """CAST(round AS INTEGER) AS round, CAST(node AS INTEGER) AS node, CAST(feature AS INTEGER) AS feature,
  x AS cut, round(gain, 5) AS gain, CAST(cl AS BIGINT) AS n_left, CAST(ca - cl AS BIGINT) AS n_right"""
    loss = f"""(SELECT round(avg(greatest(m, 0) - y * m + ln(1 + exp(-abs(m)))), 9) FROM r{_ROUNDS}) AS loss"""
    return f"WITH {', '.join(parts)} SELECT {shape}, {loss} FROM ({' UNION ALL '.join(found)})"


@query("f2_boosted_splits", _splits_sql())
def _(spark, folder):
    """Every split of the first trees, and the loss after them, over all lines."""
    lines = spark.read.parquet(f"{folder}/lineitem.parquet").select(
        (F.col("l_returnflag") == "R").cast("int").alias("label"), *[F.col(c).cast("double") for c in _SPLIT_FEATURES])
    rows = VectorAssembler(inputCols=list(_SPLIT_FEATURES), outputCol=models.FEATURES).transform(lines)
    booster = HistogramBooster(maxIter=_ROUNDS, stepSize=_STEP, maxLeaves=_LEAVES, regLambda=1.0)
    model, _, losses, splits = booster.fit_stopped(rows, rows, rounds=_ROUNDS + 1)
    cuts = model.cuts
    return spark.createDataFrame(
        [(k, node, s.feature, cuts[s.feature][s.cut], round(s.gain, 5), int(s.left[2]), int(s.right[2]),
          round(losses[_ROUNDS], 9)) for k, node, s in splits],
        "round int, node int, feature int, cut double, gain double, n_left long, n_right long, loss double")


@query("f3_boosted_sampled")
def _(spark, folder):
    return _tested(spark, folder, "boosted_sampled")


def _fitted(prepared: PreparedSplits, name: str = "random_forest"):
    return models.fit_candidate(
        _short(name), _rows(prepared, "train"), _rows(prepared, "val"), rounds=ROUNDS
    )


@query("f5_early_stopping")
def _(spark, folder):
    prepared = _prepared(spark, folder)
    _, _, best = models.fit_candidate(
        models.candidate("boosted_balanced").with_params(maxIter=16),
        _rows(prepared, "train"), _rows(prepared, "val"), rounds=ROUNDS,
    )
    return _rows(prepared, "train").agg(
        F.count(F.lit(1)).alias("n_train"), F.lit(best).alias("best_iteration")
    )


@query("f6_positive_probability", _TEST_SQL)
def _(spark, folder):
    prepared = _prepared(spark, folder)
    model, _, _ = _fitted(prepared)
    return models.raw_scores(model, _rows(prepared, "test"), "probability_of_churn").select(
        ROW_KEY, LABEL, _in_range("probability_of_churn")
    )


_ISOTONIC_SQL = with_scores("""
SELECT CustomerID, round(fit, 6) AS calibrated
FROM scores JOIN iso ON churn_probability = probability""", """
pts AS (SELECT probability, row_number() OVER (ORDER BY probability) AS i,
  sum(sum(label)) OVER (ORDER BY probability) AS p, sum(count(*)) OVER (ORDER BY probability) AS n
  FROM lp GROUP BY probability)""", """
means AS (SELECT a.i AS a, b.i AS b,
  (b.p - coalesce(z.p, 0))::DOUBLE / (b.n - coalesce(z.n, 0)) AS m
  FROM pts a JOIN pts b ON b.i >= a.i LEFT JOIN pts z ON z.i = a.i - 1)""", """
lows AS (SELECT a, b AS i, min(m) OVER (PARTITION BY a ORDER BY b DESC) AS low FROM means)""", """
iso AS (SELECT probability, fit FROM pts JOIN (SELECT i, max(low) AS fit FROM lows GROUP BY i)
  USING (i))""")


@query("f7_isotonic_calibration", _ISOTONIC_SQL)
def _(spark, folder):
    df = stage_table(scores(spark, folder), "scores")
    fitted = calibration.fit_calibrator(df, "isotonic", "churn_probability", "Churn")
    out = fitted.apply(df, "churn_probability", "calibrated").select("CustomerID", "calibrated")
    return rounded(out, "calibrated")


@query("f8_sigmoid_calibration", with_scores("""
SELECT count(*) AS n_rows, 0.0::DOUBLE AS mean_gap, 0.0::DOUBLE AS mean_weighted_gap FROM scores"""))
def _(spark, folder):
    """At the best sigmoid the smoothed targets and the fit agree on average, also when weighted by
    the score."""
    df = stage_table(scores(spark, folder), "scores")
    fitted = calibration.fit_calibrator(df, "sigmoid", "churn_probability", "Churn")
    n = df.agg(
        F.sum(F.col("Churn").cast("double")).alias("p"), F.count(F.lit(1)).alias("n")
    ).first()
    target = F.when(F.col("Churn") == 1, (n["p"] + 1) / (n["p"] + 2)).otherwise(
        1 / (n["n"] - n["p"] + 2)
    )
    gap = target - F.col("calibrated")
    return fitted.apply(df, "churn_probability", "calibrated").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.round(F.abs(F.avg(gap)), 4).alias("mean_gap"),
        F.round(F.abs(F.avg(gap * F.col("churn_probability"))), 4).alias("mean_weighted_gap"),
    )


@query("f9_no_calibration", with_scores("""
SELECT CustomerID, churn_probability AS calibrated FROM scores"""))
def _(spark, folder):
    df = scores(spark, folder)
    if calibration.fit_calibrator(df, "none") is None:
        return df.select("CustomerID", F.col("churn_probability").alias("calibrated"))
    raise AssertionError("no calibrator was asked for")


@query("f10_out_of_fold", with_snapshot("""
SELECT CustomerID AS row_key, CAST(min(fold) AS INTEGER) AS fold, tvr.Churn AS label, true AS valid
FROM tvr JOIN tve ON tvr.Churn = tve.Churn AND r <= upto GROUP BY CustomerID, tvr.Churn""",
    *THREE_WAY_SNAPSHOT, """
tv AS (SELECT CustomerID, Churn FROM marked WHERE split <> 'test'),
tvr AS (SELECT *, row_number() OVER (PARTITION BY Churn ORDER BY
  md5(concat_ws(':', CAST(CustomerID AS VARCHAR), 'fold', '42')), CustomerID) AS r FROM tv),
tvs AS (SELECT Churn, coalesce(sum(n) OVER (ORDER BY Churn ROWS BETWEEN UNBOUNDED PRECEDING
  AND 1 PRECEDING), 0) AS s FROM (SELECT Churn, count(*) AS n FROM tv GROUP BY Churn)),
tvz AS (SELECT Churn, (s + r - 1) % 3 AS fold, count(*) AS m FROM tvr JOIN tvs USING (Churn)
  GROUP BY ALL),
tve AS (SELECT Churn, fold, sum(m) OVER (PARTITION BY Churn ORDER BY fold) AS upto FROM tvz)"""))
def _(spark, folder):
    prepared = _prepared(spark, folder)
    oof = training.cross_val_oof(
        _rows(prepared, "train", "val"), _short("random_forest"), cv=3, calibrate="isotonic"
    )
    return oof.rows.select(ROW_KEY, "fold", "label", _in_range("probability"))


@query("f11_compare_models")
def _(spark, folder):
    """The whole comparison: every candidate at its own size, all folds, the full patience."""
    return training.compare_models(_rows(_prepared(spark, folder), "train", "val"))


@query("f12_random_search")
def _(spark, folder):
    prepared = _prepared(spark, folder)
    return training.tune_model(
        _rows(prepared, "train"), "boosted_sampled", n_trials=3, cv=2,
        overrides={"maxIter": 4, "maxDepth": 4},
    ).trials


@query("f13_tuned_candidate")
def _(spark, folder):
    prepared = _prepared(spark, folder)
    found = training.tune_model(
        _rows(prepared, "train"), "boosted_balanced", n_trials=2, cv=2,
        overrides={"maxIter": 4, "maxDepth": 4},
    )
    chosen = training.tuned_candidate("boosted_balanced", found.best)
    final = training.fit_final(prepared, chosen, calibrate=None, rounds=ROUNDS)
    scored = final.model.score(prepared.part("test"), "probability")
    return evaluation_metrics(
        stage_table(scored.select(F.col("Churn").alias("label"), "probability"), "tested"),
        0.5, 10.0,
    )


@query("f14_final_fit", _TEST_SQL)
def _(spark, folder):
    prepared = _prepared(spark, folder)
    final = training.fit_final(prepared, _short("boosted_balanced"), rounds=ROUNDS)
    scored = final.model.score(prepared.part("test"), "probability")
    return scored.select(ROW_KEY, F.col("Churn").alias("label"), _in_range("probability"))


# Unlike the rules of the checks, these hold on the given customers: the gate lets them pass.
TRAINING_RULES = replace(
    SNAPSHOT_RULES, value_sets={**SNAPSHOT_RULES.value_sets, "Region": REGIONS},
    ranges={"Tenure": (0, None, None), "DaySinceLastOrder": (0, None, None)}, not_null=("CustomerID", "Churn"),
)


def _train(spark, folder, **options):
    raw = stage_table(snapshot(spark, folder), "raw")
    return raw, training.train(
        raw, model="random_forest", params=SHORT_FOREST, cv=3, rounds=ROUNDS, aliases=ALIASES,
        rules=TRAINING_RULES, importance_repeats=2, **options,
    )


@query("f15_training_job")
def _(spark, folder):
    """The job with its gate; what it stored with the run is read back by the run's id."""
    root = staging_path(spark, "runs")
    _, result = _train(spark, folder, bundle_root=root)
    return read_records(spark, root, result.bundle.run_id).drop("run_id")


@query("g18_permutation_importance")
def _(spark, folder):
    prepared = _prepared(spark, folder)
    model, _, _ = _fitted(prepared)
    return importance.permutation_importance(
        models.ScoringModel(PipelineModel([model])), _rows(prepared, "test"),
        prepared.feature_columns, ROW_KEY, repeats=3,
    )


_FILLED = """
filled AS (SELECT CustomerID, Churn AS y, coalesce(DaySinceLastOrder, m.d) AS d,
  coalesce(CAST(OrderCount AS DOUBLE), m.n) AS n FROM snap, (
    SELECT median(DaySinceLastOrder) AS d, median(CAST(OrderCount AS DOUBLE)) AS n FROM snap) m)"""
_MODEL_SQL = "{d} / ({d} + 365.0::DOUBLE) / (1.0::DOUBLE + {n} / 100.0::DOUBLE)"


@query("g18_importance_of_recency", with_snapshot("""
SELECT feature, round(avg(base.ap - shuffled.ap), 6) AS importance_mean,
  round(stddev_pop(base.ap - shuffled.ap), 6) AS importance_std
FROM (SELECT feature, repeat, sum(pos::DOUBLE * tp / cnt) / max(np) AS ap FROM (
    SELECT feature, repeat, p, sum(y) AS pos, sum(sum(y)) OVER w AS tp,
      sum(count(*)) OVER w AS cnt, sum(sum(y)) OVER (PARTITION BY feature, repeat) AS np
    FROM scored WHERE repeat > 0 GROUP BY feature, repeat, p
    WINDOW w AS (PARTITION BY feature, repeat ORDER BY p DESC)) GROUP BY feature, repeat)
    AS shuffled,
  (SELECT sum(pos::DOUBLE * tp / cnt) / max(np) AS ap FROM (
    SELECT p, sum(y) AS pos, sum(sum(y)) OVER w AS tp, sum(count(*)) OVER w AS cnt,
      sum(sum(y)) OVER () AS np FROM scored WHERE repeat = 0 GROUP BY p
    WINDOW w AS (ORDER BY p DESC))) AS base
GROUP BY feature""", _FILLED, """
circle AS (SELECT *, row_number() OVER w AS i,
    coalesce(lead(d) OVER w, first_value(d) OVER w) AS d2,
    coalesce(lead(n) OVER w, first_value(n) OVER w) AS n2
  FROM (SELECT *, md5(concat_ws(':', CAST(CustomerID AS VARCHAR), 'shuffle',
      CAST(repeat AS VARCHAR), '42')) AS h FROM filled, generate_series(1, 3) g(repeat))
  WINDOW w AS (PARTITION BY repeat ORDER BY h, CustomerID)),
scored AS (
  SELECT 'DaySinceLastOrder' AS feature, repeat, y, """ + _MODEL_SQL.format(d="d2", n="n") + """
    AS p FROM circle
  UNION ALL SELECT 'OrderCount', repeat, y, """ + _MODEL_SQL.format(d="d", n="n2") + """
    FROM circle
  UNION ALL SELECT '', 0, y, """ + _MODEL_SQL.format(d="d", n="n") + " FROM filled)"))
def _(spark, folder):
    features = ["DaySinceLastOrder", "OrderCount"]
    df = stage_table(
        snapshot(spark, folder).select("CustomerID", "Churn", *features), "recency"
    )
    filled = cleaning.apply_medians(df, cleaning.fit_medians(df, features))
    rows = stage_table(models.assemble(filled, features, "Churn", "CustomerID"), "rows")
    table = importance.permutation_importance(
        RecencyModel(0, 1), rows, features, "CustomerID", repeats=3
    )
    return rounded(table, "importance_mean", "importance_std")


@query("h1_score_with_recency", with_snapshot(f"""
SELECT CustomerID, round(p, 6) AS churn_probability, CAST(p >= 0.2::DOUBLE AS INTEGER)
  AS churn_prediction
FROM (SELECT CustomerID, {_MODEL_SQL.format(d="d", n="n")} AS p FROM (
  SELECT CustomerID, coalesce(DaySinceLastOrder, m.d) AS d,
    coalesce(CAST(OrderCount AS DOUBLE), m.n) AS n
  FROM snap, (SELECT median(DaySinceLastOrder) AS d, median(CAST(OrderCount AS DOUBLE)) AS n
    FROM marked WHERE split = 'train') m))""", *THREE_WAY_SNAPSHOT))
def _(spark, folder):
    raw = stage_table(snapshot(spark, folder), "raw")
    prepared = prepare_model_splits(cleaning.clean(raw, "Churn", aliases=ALIASES), "Churn")
    scored = score_batch(
        raw.drop("Churn"), AssembledRecencyModel(), prepared.schema, prepared.medians, 0.2,
        aliases=ALIASES,
    )
    return rounded(scored, "churn_probability")


@query("g19_top_drivers")
def _(spark, folder):
    prepared = _prepared(spark, folder)
    model, _, _ = _fitted(prepared)
    return importance.top_drivers(importance.permutation_importance(
        models.ScoringModel(PipelineModel([model])), _rows(prepared, "test"),
        prepared.feature_columns, ROW_KEY, repeats=1,
    ))


def _saved(spark, folder):
    """A bundle of a short forest, stored; returns the raw table, the folder and the bundle."""
    raw = stage_table(snapshot(spark, folder), "raw")
    cleaned = stage_table(cleaning.clean(raw, "Churn", aliases=ALIASES), "cleaned")
    prepared = prepare_model_splits(cleaned, "Churn")
    final = training.fit_final(prepared, _short("random_forest"), rounds=ROUNDS)
    bundle = RunBundle(
        new_run_id(), "random_forest", final.model, prepared.schema, prepared.medians, 0.25
    )
    root = staging_path(spark, "bundles")
    save_bundle(spark, root, bundle)
    return raw, root, bundle


@query("a7_save_bundle", """
SELECT 'final' AS kind, 'FINISHED' AS status, 'random_forest' AS model, 0.25::DOUBLE AS threshold, 'Churn' AS target""")
def _(spark, folder):
    _, root, _ = _saved(spark, folder)
    return runs_table(spark, root).select("kind", "status", "model", "threshold", "target")


@query("a8_load_bundle", with_snapshot("""
SELECT count(*) AS n_rows, 'random_forest' AS model, 0.25::DOUBLE AS threshold,
  CAST(6 + 3 + 4 + 4 + (SELECT count(*) FROM (
    SELECT count(*) - count(Tenure) AS gaps FROM snap
    UNION ALL SELECT count(*) - count(DaySinceLastOrder) FROM snap
    UNION ALL SELECT count(*) - count(DaySinceLastUrgent) FROM snap
    UNION ALL SELECT count(*) - count(OrderCount) FROM snap
    UNION ALL SELECT count(*) - count(CashbackAmount) FROM snap) WHERE gaps > 0) AS INTEGER)
  AS n_features FROM snap"""))
def _(spark, folder):
    raw, root, _ = _saved(spark, folder)
    bundle = load_bundle(spark, root)
    return raw.agg(
        F.count(F.lit(1)).alias("n_rows"), F.lit(bundle.model_name).alias("model"),
        F.lit(bundle.threshold).alias("threshold"),
        F.lit(len(bundle.schema.feature_columns)).alias("n_features"),
    )


@query("h1_score_batch", with_snapshot(
    "SELECT CustomerID, true AS valid, true AS decided FROM snap"))
def _(spark, folder):
    raw, _, bundle = _saved(spark, folder)
    scored = score_batch(
        raw.drop("Churn"), bundle.model, bundle.schema, bundle.medians, bundle.threshold,
        aliases=ALIASES,
    )
    flagged = F.col("churn_probability") >= F.lit(bundle.threshold)
    return scored.select(
        "CustomerID", _in_range("churn_probability"),
        (flagged.cast("int") == F.col("churn_prediction")).alias("decided"),
    )


@query("h6_score_files")
def _(spark, folder):
    raw, root, _ = _saved(spark, folder)
    batch, output = staging_path(spark, "batch"), staging_path(spark, "contacts")
    write_table(raw.drop("Churn"), batch)
    return flagged_count(score_files(spark, batch, output, root, aliases=ALIASES))
