"""Splits, folds, weights and evaluation aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdfast.catalog.inputs import (
    ALIASES, document_scores, labelled, rounded, scores, snapshot, stored_scores, stored_snapshot,
    with_documents, with_scores, with_snapshot,
)
from holdfast.catalog.registry import ORACLES, query
from holdfast.operators import class_tables, cleaning, metrics, splitting
from holdfast.plans.prepare import prepare_model_splits
from holdfast.plans.records import run_record
from holdfast.plans.results import data_provenance, results_table, split_profile
from holdfast.session import stage_table
from holdfast.sources.snapshot import table

# --- splits --------------------------------------------------------------------------------------


def _ranked(purpose: str, source: str = "scores") -> str:
    return f"""
ranked AS (SELECT *, row_number() OVER (PARTITION BY Churn
  ORDER BY md5(concat_ws(':', CAST(CustomerID AS VARCHAR), {purpose})), CustomerID) AS r
  FROM {source}),
cls AS (SELECT Churn, count(*) AS n FROM {source} GROUP BY Churn)"""


def _quota(name: str, classes: str, fraction: str) -> str:
    """Largest-remainder shares of ceil(fraction * rows) among the rows of ``classes``."""
    return f"""
{name}_x AS (SELECT Churn, n, d, CAST(d AS DOUBLE) * n / t AS x FROM (
  SELECT *, sum(n) OVER () AS t, ceil(({fraction}) * CAST(sum(n) OVER () AS DOUBLE)) AS d
  FROM {classes})),
{name} AS (SELECT Churn, n, CAST(floor(x) AS BIGINT) + CASE WHEN row_number() OVER (
  ORDER BY x - floor(x) DESC, Churn) <= d - sum(floor(x)) OVER () THEN 1 ELSE 0 END AS q
  FROM {name}_x)"""


@query("e1_stratified_holdout", with_scores("""
SELECT CustomerID, ranked.Churn, CASE WHEN r <= q THEN 'test' ELSE 'train' END AS split
FROM ranked JOIN quota USING (Churn)""",
    _ranked("'42'"), _quota("quota", "cls", "CAST(0.2 AS DOUBLE)")))
def _(spark, folder):
    df = stored_scores(spark, folder).select("CustomerID", "Churn")
    return splitting.holdout_split(df, "CustomerID", "Churn", 0.2, 42)


_THREE_WAY = (
    _ranked("'42'"), _quota("quota", "cls", "CAST(0.2 AS DOUBLE)"),
    "left_over AS (SELECT Churn, n - q AS n, q FROM quota)",
    _quota("second", "left_over", "CAST(0.2 AS DOUBLE) / (1.0::DOUBLE - CAST(0.2 AS DOUBLE))"),
    """marked AS (SELECT ranked.*, CASE WHEN r <= quota.q THEN 'test'
      WHEN r <= quota.q + second.q THEN 'val' ELSE 'train' END AS split
      FROM ranked JOIN quota USING (Churn) JOIN second USING (Churn))""",
)


THREE_WAY_SNAPSHOT = (_ranked("'42'", "snap"), *_THREE_WAY[1:])


@query("e2_three_way_split", with_scores(
    "SELECT CustomerID, Churn, split FROM marked", *_THREE_WAY))
def _(spark, folder):
    df = stored_scores(spark, folder).select("CustomerID", "Churn")
    return splitting.three_way_split(df, "CustomerID", "Churn", 0.2, 0.2, 42)


_FOLDS = (
    _ranked("'fold', '42'"), """
starts AS (SELECT Churn, n, coalesce(sum(n) OVER (ORDER BY Churn ROWS BETWEEN UNBOUNDED PRECEDING
  AND 1 PRECEDING), 0) AS s FROM cls),
sizes AS (SELECT Churn, (s + r - 1) % 5 AS fold, count(*) AS m
  FROM ranked JOIN starts USING (Churn) GROUP BY ALL),
ends AS (SELECT Churn, fold, sum(m) OVER (PARTITION BY Churn ORDER BY fold) AS upto FROM sizes),
folds AS (SELECT CustomerID, ranked.Churn, CAST(min(fold) AS INTEGER) AS fold
  FROM ranked JOIN ends ON ranked.Churn = ends.Churn AND r <= ends.upto
  GROUP BY CustomerID, ranked.Churn)""",
)


@query("e3_stratified_folds", with_scores("SELECT * FROM folds", *_FOLDS))
def _(spark, folder):
    df = stored_scores(spark, folder).select("CustomerID", "Churn")
    return splitting.stratified_folds(df, "CustomerID", "Churn", 5, 42)


@query("e4_inner_holdout", with_scores("""
SELECT CustomerID, Churn, CASE WHEN place <= q THEN 'held' ELSE 'fit' END AS part
FROM (SELECT *, row_number() OVER (PARTITION BY Churn
  ORDER BY md5(concat_ws(':', CAST(CustomerID AS VARCHAR), '45')), CustomerID) AS place
  FROM folds WHERE fold <> 3) JOIN (SELECT Churn, q FROM quota) USING (Churn)""",
    *_FOLDS, "rest AS (SELECT Churn, count(*) AS n FROM folds WHERE fold <> 3 GROUP BY Churn)",
    _quota("quota", "rest", "CAST(0.2 AS DOUBLE)")))
def _(spark, folder):
    df = stored_scores(spark, folder).select("CustomerID", "Churn")
    others = splitting.stratified_folds(df, "CustomerID", "Churn", 5, 42).filter("fold <> 3")
    return splitting.holdout_split(
        others.drop("fold"), "CustomerID", "Churn", 0.2, 42 + 3, name="part", held="held",
        rest="fit",
    )


@query("e5_class_ratio", with_scores("""
SELECT count(CASE WHEN Churn = 0 THEN 1 END) AS n_negative,
  count(CASE WHEN Churn = 1 THEN 1 END) AS n_positive,
  count(CASE WHEN Churn = 0 THEN 1 END) / count(CASE WHEN Churn = 1 THEN 1 END)::DOUBLE AS ratio
FROM scores"""))
def _(spark, folder):
    return splitting.class_ratio(scores(spark, folder), "Churn")


@query("e6_class_weights", with_scores("""
SELECT CustomerID, Churn, round((SELECT count(*) FROM scores) / (2.0::DOUBLE * n), 6) AS weight
FROM scores JOIN (SELECT Churn, count(*) AS n FROM scores GROUP BY Churn) USING (Churn)"""))
def _(spark, folder):
    df = stored_scores(spark, folder).select("CustomerID", "Churn")
    weights = splitting.balanced_weights(splitting.class_counts(df, "Churn"))
    return rounded(splitting.with_class_weight(df, "Churn", weights), "weight")


_EXACT_QUOTA = """
shares AS (SELECT cls, n, CAST(d AS HUGEINT) * n // t AS q, CAST(d AS HUGEINT) * n % t AS rest, d FROM (
  SELECT cls, n, t, CAST(ceil(CAST(0.2 AS DOUBLE) * CAST(t AS DOUBLE)) AS BIGINT) AS d
  FROM (SELECT *, sum(n) OVER () AS t FROM counts))),
quota AS (SELECT cls, n, q + CASE WHEN row_number() OVER (ORDER BY rest DESC, cls) <= d - sum(q) OVER ()
  THEN 1 ELSE 0 END AS q FROM shares)"""


def _odd_keys_sql(key: str) -> str:
    """Held-out rows per class, and how many rows come back with every key."""
    return f"""
WITH counts AS (SELECT l_returnflag AS cls, count(*) AS n FROM lineitem GROUP BY ALL), {_EXACT_QUOTA}
SELECT 'class' AS kind, cls AS name, CAST(q AS BIGINT) AS n_test, n AS n_rows FROM quota UNION ALL
SELECT 'key', CAST({key} AS VARCHAR), NULL, count(*) FROM lineitem GROUP BY ALL"""


def _odd_keys(spark, folder, key):
    """A split of every order line by a key that repeats or is missing; the quotas are exact all the same."""
    lines = table(spark, folder, "lineitem").withColumn("key", key)
    split = stage_table(
        splitting.holdout_split(lines, "key", "l_returnflag", 0.2, 42, literal_classes=0), "split")
    n_test = F.count(F.when(F.col("split") == "test", 1))
    by_class = split.groupBy(F.lit("class").alias("kind"), F.col("l_returnflag").alias("name")).agg(
        n_test.alias("n_test"), F.count(F.lit(1)).alias("n_rows"))
    by_key = split.groupBy(F.lit("key").alias("kind"), F.col("key").cast("string").alias("name")).agg(
        F.lit(None).cast("long").alias("n_test"), F.count(F.lit(1)).alias("n_rows"))
    return by_class.union(by_key)


@query("e1_repeated_keys", _odd_keys_sql("l_suppkey"))
def _(spark, folder):
    return _odd_keys(spark, folder, F.col("l_suppkey"))


@query("e1_missing_keys", _odd_keys_sql("CASE WHEN l_linenumber <= 2 THEN l_suppkey END"))
def _(spark, folder):
    return _odd_keys(spark, folder, F.when(F.col("l_linenumber") <= 2, F.col("l_suppkey")))


_MANY_CLASSES = """
rows AS (SELECT o_orderkey, o_custkey || ' ' || o_orderpriority AS cls FROM orders),
counts AS (SELECT cls, count(*) AS n FROM rows GROUP BY cls)"""


def _placed(*salt: str) -> str:
    return f"""
placed AS (SELECT *, row_number() OVER (PARTITION BY cls ORDER BY md5(concat_ws(':',
  CAST(o_orderkey AS VARCHAR), {", ".join(f"'{s}'" for s in salt)})), o_orderkey) AS r FROM rows)"""


def _many_classes(spark, folder):
    orders = table(spark, folder, "orders")
    return stage_table(orders.select("o_orderkey", F.concat_ws(
        " ", F.col("o_custkey").cast("string"), "o_orderpriority").alias("cls")), "classes")


@query("e1_many_classes", f"""
WITH {_MANY_CLASSES}, {_placed("42")}, {_EXACT_QUOTA}
SELECT o_orderkey, placed.cls, CASE WHEN r <= q THEN 'test' ELSE 'train' END AS split
FROM placed JOIN quota USING (cls)""")
def _(spark, folder):
    """A class for every customer and priority: cuts by a join."""
    return splitting.holdout_split(
        _many_classes(spark, folder), "o_orderkey", "cls", 0.2, 42, literal_classes=0)


@query("e3_many_classes", f"""
WITH {_MANY_CLASSES}, {_placed("fold", "42")},
starts AS (SELECT cls, coalesce(sum(n) OVER (ORDER BY cls ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
  AS s FROM counts),
sizes AS (SELECT cls, (s + r - 1) % 5 AS fold, count(*) AS m FROM placed JOIN starts USING (cls) GROUP BY ALL),
ends AS (SELECT cls, fold, sum(m) OVER (PARTITION BY cls ORDER BY fold) AS upto FROM sizes)
SELECT o_orderkey, placed.cls, CAST(min(fold) AS INTEGER) AS fold
FROM placed JOIN ends ON placed.cls = ends.cls AND r <= ends.upto GROUP BY ALL""")
def _(spark, folder):
    return splitting.stratified_folds(
        _many_classes(spark, folder), "o_orderkey", "cls", 5, 42, literal_classes=0)


@query("e6_many_classes", f"""
WITH {_MANY_CLASSES}
SELECT o_orderkey, rows.cls, round((SELECT count(*) FROM rows)::DOUBLE
  / ((SELECT count(*) FROM counts)::DOUBLE * n), 6) AS weight FROM rows JOIN counts USING (cls)""")
def _(spark, folder):
    return rounded(class_tables.with_balanced_weight(_many_classes(spark, folder), "cls"), "weight")


def _prepared(spark, folder):
    cleaned = stage_table(
        cleaning.clean(stored_snapshot(spark, folder), "Churn", aliases=ALIASES), "cleaned"
    )
    return prepare_model_splits(cleaned, "Churn", 0.2, 0.2, 42)


@query("e7_split_counts", with_scores("""
SELECT split, count(*) AS n_rows, count(CASE WHEN Churn = 1 THEN 1 END) AS n_positive,
  count(CASE WHEN Churn = 0 THEN 1 END) AS n_negative FROM marked GROUP BY split""", *_THREE_WAY))
def _(spark, folder):
    return split_profile(_prepared(spark, folder).frame, "Churn")


@query("e7_prepared_matrix", with_snapshot("""
SELECT CustomerID AS row_key, Churn, split,
  round(coalesce(Tenure, (SELECT median(Tenure) FROM marked WHERE split = 'train')), 6) AS Tenure,
  CAST(InCredit = 'Yes' AS DOUBLE) AS InCredit,
  CAST(Region = 'ASIA' AS DOUBLE) AS "Region_ASIA"
FROM marked""", *THREE_WAY_SNAPSHOT))
def _(spark, folder):
    return rounded(
        _prepared(spark, folder).frame.select(
            "row_key", "Churn", "split", "Tenure", "InCredit", "Region_ASIA"
        ),
        "Tenure",
    )


# --- ranking quality and operating points --------------------------------------------------------


def _auc_sql(source: str, by: str = "") -> str:
    part = f"PARTITION BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
pts AS (SELECT {lead}probability AS s, sum(label)::BIGINT AS pos, count(*) - sum(label) AS neg
  FROM {source} GROUP BY {lead}s),
cum AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp, sum(pos) OVER ({part}) AS np,
  sum(neg) OVER ({part}) AS nn FROM pts WINDOW w AS ({part} ORDER BY s DESC)),
auc AS (SELECT {lead}
  sum(neg::DOUBLE * (tp - pos / 2.0::DOUBLE)) / nullif(max(np)::DOUBLE * max(nn), 0) AS roc_auc,
  coalesce(sum(pos::DOUBLE * tp / (tp + fp)) / nullif(max(np), 0), 0.0::DOUBLE) AS pr_auc
  FROM cum {group})"""


@query("g1_roc_auc", with_scores("SELECT round(roc_auc, 6) AS roc_auc FROM auc", _auc_sql("lp")))
def _(spark, folder):
    df = metrics.ranking_metrics(labelled(stored_scores(spark, folder)))
    return rounded(df.select("roc_auc"), "roc_auc")


@query("g2_average_precision", with_scores(
    "SELECT round(pr_auc, 6) AS pr_auc FROM auc", _auc_sql("lp")))
def _(spark, folder):
    df = metrics.ranking_metrics(labelled(stored_scores(spark, folder)))
    return rounded(df.select("pr_auc"), "pr_auc")


@query("g2_ranking_by_language", with_documents(
    "SELECT lang, round(roc_auc, 6) AS roc_auc, round(pr_auc, 6) AS pr_auc FROM auc",
    _auc_sql("docs", "lang")))
def _(spark, folder):
    df = metrics.ranking_metrics(document_scores(spark, folder), by=["lang"])
    return rounded(df, "roc_auc", "pr_auc")


_COUNTS_SQL = """
conf AS (SELECT count(CASE WHEN probability < 0.2::DOUBLE AND label = 0 THEN 1 END) AS tn,
  count(CASE WHEN probability >= 0.2::DOUBLE AND label = 0 THEN 1 END) AS fp,
  count(CASE WHEN probability < 0.2::DOUBLE AND label = 1 THEN 1 END) AS fn,
  count(CASE WHEN probability >= 0.2::DOUBLE AND label = 1 THEN 1 END) AS tp FROM lp)"""


@query("g3_confusion_counts", with_scores("SELECT * FROM conf", _COUNTS_SQL))
def _(spark, folder):
    return metrics.confusion_counts(labelled(scores(spark, folder)), 0.2)


@query("g4_operating_rates", with_scores("""
SELECT *, round(coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0), 6) AS precision,
  round(coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0), 6) AS recall,
  round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0), 6) AS f1 FROM conf""",
    _COUNTS_SQL))
def _(spark, folder):
    df = metrics.metrics_at_threshold(labelled(scores(spark, folder)), 0.2)
    return rounded(df, "precision", "recall", "f1")


@query("g5_expected_cost", with_scores(
    "SELECT *, 10.0::DOUBLE * fn + fp AS cost FROM conf", _COUNTS_SQL))
def _(spark, folder):
    counts = metrics.confusion_counts(labelled(scores(spark, folder)), 0.2)
    return metrics.with_expected_cost(counts, 10.0)


_CURVE_SQL = """
curve AS (SELECT t AS threshold, tp, n - tp AS fp, np - tp AS fn FROM (
  SELECT t, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(m) OVER w AS BIGINT) AS n,
    CAST(sum(pos) OVER () AS BIGINT) AS np
  FROM (SELECT round_even(probability * 10000.0::DOUBLE, 0) / 10000.0::DOUBLE AS t,
    sum(label) AS pos, count(*) AS m FROM lp GROUP BY t) WINDOW w AS (ORDER BY t DESC)))"""


@query("g6_threshold_curve", with_scores("SELECT * FROM curve", _CURVE_SQL))
def _(spark, folder):
    return metrics.threshold_curve(labelled(scores(spark, folder)))


def _best(objective: str) -> str:
    return with_scores(f"""
SELECT threshold, round(objective, 6) AS objective
FROM (SELECT *, CAST({objective} AS DOUBLE) AS objective FROM curve)
ORDER BY objective DESC, threshold LIMIT 1""", _CURVE_SQL)


def _select(spark, folder, metric):
    df = metrics.select_threshold(labelled(scores(spark, folder)), metric)
    return rounded(df, "objective")


@query("g7_threshold_by_cost", _best("-(10.0::DOUBLE * fn + fp)"))
def _(spark, folder):
    return _select(spark, folder, "cost")


@query("g8_threshold_by_precision", _best("coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0)"))
def _(spark, folder):
    return _select(spark, folder, "precision")


@query("g9_threshold_by_recall", _best("coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0)"))
def _(spark, folder):
    return _select(spark, folder, "recall")


@query("g10_threshold_by_f1", _best("coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0)"))
def _(spark, folder):
    return _select(spark, folder, "f1")


@query("g11_fixed_threshold", with_scores(
    "SELECT 0.2::DOUBLE AS threshold, -(10.0::DOUBLE * fn + fp) AS objective FROM conf",
    _COUNTS_SQL))
def _(spark, folder):
    return metrics.select_threshold(labelled(scores(spark, folder)), "cost", fixed=0.2)


# --- calibration ---------------------------------------------------------------------------------


@query("g12_brier_score", with_scores("""
SELECT round(avg((probability - label) * (probability - label)), 6) AS brier FROM lp"""))
def _(spark, folder):
    return rounded(metrics.brier_score(labelled(scores(spark, folder))), "brier")


_EDGES = metrics.bin_edges(10)
_BINS_SQL = """
bins AS (SELECT CAST(""" + " + ".join(
    f"(probability >= CAST('{e!r}' AS DOUBLE))::INTEGER" for e in _EDGES[1:-1]) + """ AS INTEGER)
    AS bin, probability, label FROM lp),
table_ AS (SELECT bin, CASE bin """ + " ".join(
    f"WHEN {i} THEN CAST('{e!r}' AS DOUBLE)" for i, e in enumerate(_EDGES[:-1])) + """ END
    AS bin_low, CASE bin """ + " ".join(
    f"WHEN {i} THEN CAST('{e!r}' AS DOUBLE)" for i, e in enumerate(_EDGES[1:])) + """ END
    AS bin_high, count(*) AS "count", avg(probability) AS mean_predicted,
    avg(label::DOUBLE) AS observed_rate FROM bins GROUP BY bin)"""


def _reliability(spark, folder):
    return metrics.reliability_table(labelled(scores(spark, folder)))


@query("g13_reliability_table", with_scores("""
SELECT bin, bin_low, bin_high, "count", round(mean_predicted, 6) AS mean_predicted,
  round(observed_rate, 6) AS observed_rate FROM table_""", _BINS_SQL))
def _(spark, folder):
    return rounded(_reliability(spark, folder), "mean_predicted", "observed_rate")


_ECE_SQL = """
ece AS (SELECT sum("count" * abs(observed_rate - mean_predicted)) / sum("count") AS ece
  FROM table_)"""


@query("g14_calibration_error", with_scores(
    "SELECT round(ece, 6) AS ece FROM ece", _BINS_SQL, _ECE_SQL))
def _(spark, folder):
    return rounded(metrics.calibration_error(_reliability(spark, folder)), "ece")


@query("g14_calibration_by_language", with_documents("""
SELECT lang, round(sum(sq) / sum(n), 6) AS brier, round(sum(abs(o - p)) / sum(n), 6) AS ece FROM (
  SELECT lang, """ + " + ".join(
    f"(probability >= CAST('{e!r}' AS DOUBLE))::INTEGER" for e in _EDGES[1:-1]) + """ AS bin,
    count(*) AS n, sum(label::DOUBLE) AS o, sum(probability) AS p,
    sum((probability - label) * (probability - label)) AS sq FROM docs GROUP BY lang, bin)
GROUP BY lang"""))
def _(spark, folder):
    df = metrics.calibration_report(document_scores(spark, folder), by=["lang"])
    return rounded(df, "brier", "ece")


@query("g15_reliability_rows", with_scores("""
SELECT bin, printf('%.2f,%.2f,%d,%.4f,%.4f', bin_low, bin_high, "count", mean_predicted,
  observed_rate) AS line FROM table_""", _BINS_SQL))
def _(spark, folder):
    return metrics.reliability_rows(_reliability(spark, folder))


@query("g16_calibration_alarm", with_scores(
    "SELECT round(ece, 6) AS ece, ece > 0.05::DOUBLE AS alarm FROM ece", _BINS_SQL, _ECE_SQL))
def _(spark, folder):
    errors = metrics.calibration_error(_reliability(spark, folder))
    return rounded(metrics.calibration_alarm(errors), "ece")


# --- reports -------------------------------------------------------------------------------------


@query("g17_class_report", with_scores("""
SELECT "row", round(p, 6) AS precision, round(r, 6) AS recall, round(f, 6) AS f1, s AS support
FROM (
  SELECT '0' AS "row", p0 AS p, r0 AS r, f0 AS f, tn + fp AS s FROM parts
  UNION ALL SELECT '1', p1, r1, f1_, tp + fn FROM parts
  UNION ALL SELECT 'accuracy', a, a, a, n FROM parts
  UNION ALL SELECT 'macro avg', (p0 + p1) / 2, (r0 + r1) / 2, (f0 + f1_) / 2, n FROM parts
  UNION ALL SELECT 'weighted avg', (p0 * (tn + fp) + p1 * (tp + fn)) / n,
    (r0 * (tn + fp) + r1 * (tp + fn)) / n, (f0 * (tn + fp) + f1_ * (tp + fn)) / n, n FROM parts)""",
    _COUNTS_SQL, """
parts AS (SELECT *, coalesce(tn / nullif(tn + fn, 0)::DOUBLE, 0) AS p0,
  coalesce(tn / nullif(tn + fp, 0)::DOUBLE, 0) AS r0,
  coalesce(2 * tn / nullif(2 * tn + fn + fp, 0)::DOUBLE, 0) AS f0,
  coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0) AS p1,
  coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0) AS r1,
  coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0) AS f1_,
  (tn + tp) / (tn + fp + fn + tp)::DOUBLE AS a, tn + fp + fn + tp AS n FROM conf)"""))
def _(spark, folder):
    df = metrics.classification_report(labelled(scores(spark, folder)), 0.2)
    return rounded(df, "precision", "recall", "f1")


@query("g20_fold_summary", with_documents("""
SELECT round(avg(pr_auc), 6) AS pr_auc_mean, round(stddev_pop(pr_auc), 6) AS pr_auc_std,
  round(avg(roc_auc), 6) AS roc_auc_mean, round(stddev_pop(roc_auc), 6) AS roc_auc_std FROM auc""",
    _auc_sql("docs", "lang")))
def _(spark, folder):
    per_fold = metrics.ranking_metrics(document_scores(spark, folder), by=["lang"])
    summary = metrics.fold_summary(per_fold)
    return rounded(summary, *summary.columns)


def _long_sql(section: str, source: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, '' AS item, '{name}' AS metric, "
        f"round(CAST({value} AS DOUBLE), 6) AS value FROM {source}"
        for name, value in columns.items()
    )


@query("g21_results_table", with_scores(
    _long_sql("provenance", "prov", {
        "raw_rows": "raw_rows", "clean_rows": "clean_rows", "churn_rate": "churn_rate"})
    + " UNION ALL " + _long_sql("test", "conf, auc, ece, brier", {
        "n_rows": "tn + fp + fn + tp", "n_positive": "tp + fn", "n_negative": "tn + fp",
        "roc_auc": "roc_auc", "pr_auc": "pr_auc",
        "precision": "coalesce(tp / nullif(tp + fp, 0)::DOUBLE, 0)",
        "recall": "coalesce(tp / nullif(tp + fn, 0)::DOUBLE, 0)",
        "f1": "coalesce(2 * tp / nullif(2 * tp + fp + fn, 0)::DOUBLE, 0)",
        "tn": "tn", "fp": "fp", "fn": "fn", "tp": "tp", "cost": "10 * fn + fp",
        "brier": "brier", "ece": "ece", "alarm": "ece > 0.05::DOUBLE"})
    + " UNION ALL " + _long_sql("run", "(SELECT 1) AS one", {
        "threshold": "0.2", "fn_fp_ratio": "10"}),
    _auc_sql("lp"), _COUNTS_SQL, _BINS_SQL, _ECE_SQL,
    "brier AS (SELECT avg((probability - label) * (probability - label)) AS brier FROM lp)",
    """prov AS (SELECT (SELECT count(*) FROM scores) AS raw_rows, count(*) AS clean_rows,
      avg(Churn::DOUBLE) AS churn_rate FROM (SELECT DISTINCT churn_probability, Churn
      FROM scores))"""))
def _(spark, folder):
    raw = stage_table(scores(spark, folder), "scores")
    df = results_table(
        raw=raw, cleaned=raw.select("churn_probability", "Churn").dropDuplicates(),
        target="Churn", test_scores=labelled(raw), oof=None, threshold=0.2,
    )
    return rounded(df, "value")


@query("g21_run_record", f"""
SELECT 'run-1' AS run_id, section, item, metric, value AS number, CAST(NULL AS VARCHAR) AS text
FROM ({ORACLES["g21_results_table"]}) UNION ALL
SELECT 'run-1', 'class_report', "row", metric, CAST(number AS DOUBLE), NULL FROM (
  UNPIVOT (SELECT "row", precision, recall, f1, CAST(support AS DOUBLE) AS support
    FROM ({ORACLES["g17_class_report"]})) ON precision, recall, f1, support INTO NAME metric VALUE number)
UNION ALL SELECT 'run-1', 'run', '', 'model', NULL, 'recency' UNION ALL
SELECT 'run-1', 'run', '', 'tuned', 0.0::DOUBLE, NULL UNION ALL
SELECT 'run-1', 'run', '', 'calibrate', NULL, NULL""")
def _(spark, folder):
    raw = stage_table(scores(spark, folder), "scores")
    test = labelled(raw)
    results = results_table(
        raw=raw, cleaned=raw.select("churn_probability", "Churn").dropDuplicates(),
        target="Churn", test_scores=test, oof=None, threshold=0.2,
    )
    return rounded(run_record("run-1", results, test_scores=test, threshold=0.2, facts={
        "model": "recency", "tuned": False, "calibrate": None}), "number")


@query("g22_data_provenance", with_snapshot("""
SELECT (SELECT count(*) FROM snap) AS raw_rows, count(*) AS clean_rows,
  round(avg(Churn::DOUBLE), 6) AS churn_rate
FROM (SELECT DISTINCT Churn, MarketSegment, Region, InCredit, OrderCount FROM snap)"""))
def _(spark, folder):
    raw = stage_table(snapshot(spark, folder).select(
        "CustomerID", "Churn", "MarketSegment", "Region", "InCredit", "OrderCount"
    ), "raw")
    cleaned = cleaning.clean(raw, "Churn", missing_columns=[])
    return rounded(data_provenance(raw, cleaned, "Churn"), "churn_rate")
