"""Scoring decisions, experiment assignment and experiment analysis."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdfast.catalog.inputs import (
    coarse, rounded, scores, stored_scores, with_scores, with_snapshot,
)
from holdfast.catalog.registry import query
from holdfast.operators import assignment, itt, value
from holdfast.operators.cleaning import set_ids_aside
from holdfast.plans.experiment import analysis_record, assign_files
from holdfast.plans.scoring import decide, flagged_count
from holdfast.session import stage_table, staging_path
from holdfast.sources.customers import load_customers
from holdfast.sources.fingerprints import table_fingerprint
from holdfast.sources.sinks import ranked_scores, write_table

# --- scoring decisions ---------------------------------------------------------------------------


def _decided(spark, folder):
    p = F.col("churn_probability")
    return scores(spark, folder).select(
        "CustomerID", "churn_probability", decide(p, 0.2).alias("churn_prediction")
    )


_DECIDED_SQL = """
decided AS (SELECT CustomerID, churn_probability,
  CAST(churn_probability >= 0.2::DOUBLE AS INTEGER) AS churn_prediction FROM scores)"""


@query("h2_carry_id", with_snapshot("SELECT CustomerID AS row_key, Region FROM snap"))
def _(spark, folder):
    return set_ids_aside(coarse(spark, folder)).select("row_key", "Region")


@query("h3_decision", with_scores(
    "SELECT CustomerID, churn_prediction FROM decided", _DECIDED_SQL))
def _(spark, folder):
    return _decided(spark, folder).select("CustomerID", "churn_prediction")


@query("h4_contact_list", with_scores("SELECT * FROM decided", _DECIDED_SQL))
def _(spark, folder):
    return ranked_scores(_decided(spark, folder))


@query("h5_flagged_count", with_scores("""
SELECT count(*) AS n_scored, CAST(sum(churn_prediction) AS BIGINT) AS n_flagged FROM decided""",
    _DECIDED_SQL))
def _(spark, folder):
    return flagged_count(_decided(spark, folder))


# --- assignment ----------------------------------------------------------------------------------


def _hash(*salt: str) -> str:
    return "md5(concat_ws(':', CAST(CustomerID AS VARCHAR), " + ", ".join(
        f"'{s}'" for s in salt) + "))"


def _assign_sql(pool: str = "0.30", treated: str = "0.50", bands: int = 3,
                source: str = "scores") -> str:
    return f"""
ranked AS (SELECT CustomerID, churn_probability, row_number() OVER (
    ORDER BY churn_probability DESC, {_hash('42')}, CustomerID) AS risk_rank,
    count(*) OVER () AS n FROM {source}),
pool AS (SELECT CustomerID, churn_probability, risk_rank,
    CAST(ntile({bands}) OVER (ORDER BY risk_rank) AS INTEGER) AS band
  FROM ranked WHERE risk_rank <= greatest(1, ceil(n * CAST({pool} AS DOUBLE)))),
placed AS (SELECT *, row_number() OVER (PARTITION BY band ORDER BY {_hash('arm', '42')},
    CustomerID) AS place, count(*) OVER (PARTITION BY band) AS m FROM pool),
assigned AS (SELECT CustomerID, churn_probability, risk_rank,
    CASE WHEN band = 1 THEN 'risk_band_1_highest' ELSE 'risk_band_' || band END AS risk_band,
    CASE WHEN CASE WHEN m = 1 THEN
        CAST(('0x' || substr({_hash('coin', '42')}, 1, 12)) AS BIGINT) / 281474976710656.0::DOUBLE
          < CAST({treated} AS DOUBLE)
      ELSE place <= least(greatest(1, round_even(m * CAST({treated} AS DOUBLE), 0)), m - 1) END
      THEN 'treatment' ELSE 'control' END AS treatment_group FROM placed)"""


def _assigned(spark, folder, **options):
    return assignment.assign_experiment(stored_scores(spark, folder), **options)


@query("a5_write_assignments", with_scores("SELECT * FROM assigned", _assign_sql()))
def _(spark, folder):
    source, target = staging_path(spark, "scored"), staging_path(spark, "assigned")
    write_table(scores(spark, folder).drop("Churn"), source)
    return assign_files(spark, source, target)


_OUTCOME_SQL = "outcomes AS (SELECT CustomerID, Churn AS outcome FROM scores)"


def _stored_experiment(spark, folder):
    scored = stored_scores(spark, folder)
    assigned = stage_table(assignment.assign_experiment(scored), "assigned")
    return assigned, scored.select("CustomerID", F.col("Churn").alias("outcome"))


@query("a6_read_experiment", with_scores("""
SELECT treatment_group, count(*) AS n, CAST(sum(outcome) AS BIGINT) AS n_churned
FROM assigned JOIN outcomes USING (CustomerID) GROUP BY treatment_group""",
    _assign_sql(), _OUTCOME_SQL))
def _(spark, folder):
    assigned, outcomes = _stored_experiment(spark, folder)
    paths = staging_path(spark, "assignments"), staging_path(spark, "outcomes")
    write_table(assigned, paths[0])
    write_table(outcomes, paths[1])
    read = itt.join_outcomes(load_customers(spark, paths[0]), load_customers(spark, paths[1]))
    return read.groupBy("treatment_group").agg(
        F.count(F.lit(1)).alias("n"), F.sum("outcome").alias("n_churned")
    )


@query("a10_assignment_record", with_scores("""
SELECT (SELECT count(*) FROM scores) AS input_rows, count(*) AS output_rows,
  count(CASE WHEN treatment_group = 'treatment' THEN 1 END) AS n_treatment,
  count(CASE WHEN treatment_group = 'control' THEN 1 END) AS n_control FROM assigned""",
    _assign_sql()))
def _(spark, folder):
    scored = stored_scores(spark, folder)
    record = assignment.assignment_record(
        assignment.assign_experiment(scored), table_fingerprint(scored), {"random_state": 42}
    )
    return record.select("input_rows", "output_rows", "n_treatment", "n_control")


@query("i1_required_columns", with_scores("SELECT count(*) AS n_rows FROM scores"))
def _(spark, folder):
    n = assignment.check_scored(
        stored_scores(spark, folder), assignment.ID_COLUMN, assignment.PROBABILITY
    )
    return spark.createDataFrame([(n,)], "n_rows long")


@query("i2_duplicate_ids", """
SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 1
ORDER BY o_custkey LIMIT 5""")
def _(spark, folder):
    orders = spark.read.parquet(f"{folder}/orders.parquet")
    return assignment.duplicate_ids(orders, "o_custkey")


@query("i3_probability_profile", with_snapshot("""
SELECT count(*) AS n_rows, count(*) - count(p) AS n_missing,
  count(CASE WHEN p < 0 OR p > 1 THEN 1 END) AS n_outside
FROM (SELECT DaySinceLastUrgent / 1000.0::DOUBLE AS p FROM snap)"""))
def _(spark, folder):
    from holdfast.catalog.inputs import snapshot

    df = snapshot(spark, folder).select(
        (F.col("DaySinceLastUrgent") / F.lit(1000.0)).alias("churn_probability")
    )
    return assignment.probability_profile(df)


@query("i5_empty_input", with_scores(
    "SELECT * FROM assigned WHERE churn_probability < 0", _assign_sql()))
def _(spark, folder):
    return assignment.assign_experiment(
        scores(spark, folder).filter(F.col("churn_probability") < 0)
    )


@query("i6_risk_ranks", with_scores(
    "SELECT CustomerID, churn_probability, risk_rank FROM ranked", _assign_sql()))
def _(spark, folder):
    return assignment.risk_ranks(stored_scores(spark, folder).drop("Churn"))


def _pool(spark, folder):
    scored = stored_scores(spark, folder)
    return assignment.risk_pool(scored, scored.count())


@query("i7_risk_pool", with_scores(
    "SELECT CustomerID, churn_probability, risk_rank FROM pool", _assign_sql()))
def _(spark, folder):
    return _pool(spark, folder).drop("band")


@query("i8_risk_bands", with_scores(
    "SELECT CustomerID, risk_rank, band FROM pool", _assign_sql(bands=7)))
def _(spark, folder):
    scored = stored_scores(spark, folder)
    pool = assignment.risk_pool(scored, scored.count(), n_risk_bands=7)
    return pool.select("CustomerID", "risk_rank", "band")


@query("i9_blocked_randomization", with_scores("SELECT * FROM assigned", _assign_sql()))
def _(spark, folder):
    return _assigned(spark, folder)


@query("i10_one_customer_bands", with_scores(
    "SELECT * FROM assigned", _assign_sql(pool="0.01", treated="0.3", bands=10**6)))
def _(spark, folder):
    return _assigned(
        spark, folder, risk_pool_fraction=0.01, treatment_fraction=0.3, n_risk_bands=10**6
    )


@query("i11_balance", with_scores("""
SELECT risk_band, treatment_group, count(*) AS n_customers,
  round(avg(churn_probability), 6) AS mean_probability
FROM assigned GROUP BY risk_band, treatment_group""", _assign_sql()))
def _(spark, folder):
    return rounded(assignment.summarize_balance(_assigned(spark, folder)), "mean_probability")


# --- analysis ------------------------------------------------------------------------------------

_JOINED_SQL = (
    _assign_sql(), _OUTCOME_SQL,
    "joined AS (SELECT assigned.*, outcome FROM assigned LEFT JOIN outcomes USING (CustomerID))",
)


@query("j1_input_checks", with_scores("""
SELECT count(*) AS n_assigned, CAST(0 AS BIGINT) AS repeated_assignments,
  CAST(0 AS BIGINT) AS repeated_outcomes,
  count(CASE WHEN treatment_group NOT IN ('treatment', 'control') THEN 1 END) AS unknown_group,
  count(*) - count(outcome) AS n_missing,
  count(CASE WHEN outcome NOT IN (0, 1) THEN 1 END) AS n_not_binary,
  count(CASE WHEN treatment_group = 'treatment' THEN 1 END) AS n_treatment,
  count(CASE WHEN treatment_group = 'control' THEN 1 END) AS n_control FROM joined""",
    *_JOINED_SQL))
def _(spark, folder):
    return itt.input_profile(itt.outcome_cells(*_stored_experiment(spark, folder)))


@query("j1_repeated_outcomes", """
SELECT count(*) AS repeated_outcomes FROM (
  SELECT o_custkey FROM orders GROUP BY o_custkey HAVING count(*) > 1)""")
def _(spark, folder):
    assigned, _outcomes = _stored_experiment(spark, folder)
    orders = spark.read.parquet(f"{folder}/orders.parquet").select(
        F.col("o_custkey").alias("CustomerID"), F.lit(1).alias("outcome")
    )
    profile = itt.input_profile(itt.outcome_cells(assigned, orders))
    return profile.select("repeated_outcomes")


@query("j2_join_outcomes", with_scores("SELECT * FROM joined", *_JOINED_SQL))
def _(spark, folder):
    return itt.join_outcomes(*_stored_experiment(spark, folder))


@query("j3_missing_outcomes", with_scores("""
SELECT count(*) AS n_missing FROM assigned
WHERE CustomerID NOT IN (SELECT CustomerID FROM outcomes WHERE outcome = 0)""", *_JOINED_SQL))
def _(spark, folder):
    assigned, outcomes = _stored_experiment(spark, folder)
    heard_of = outcomes.withColumn("outcome", F.when(F.col("outcome") == 0, 0))
    return itt.missing_outcomes(assigned, heard_of)


@query("j4_outcome_values", with_scores("""
SELECT count(CASE WHEN outcome * 2 NOT IN (0, 1) THEN 1 END) AS n_not_binary,
  count(CASE WHEN treatment_group = 'treatment' THEN 1 END) AS n_treatment,
  count(CASE WHEN treatment_group = 'control' THEN 1 END) AS n_control FROM joined""",
    *_JOINED_SQL))
def _(spark, folder):
    assigned, outcomes = _stored_experiment(spark, folder)
    doubled = outcomes.withColumn("outcome", F.col("outcome") * 2)
    return itt.input_profile(itt.outcome_cells(assigned, doubled)).select(
        "n_not_binary", "n_treatment", "n_control"
    )


def _effect_sql(by: str = "") -> str:
    lead = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
effect AS (SELECT *, rate_treatment - rate_control AS difference FROM (SELECT {lead}
  count(CASE WHEN treatment_group = 'treatment' THEN 1 END) AS n_treatment,
  count(CASE WHEN treatment_group = 'control' THEN 1 END) AS n_control,
  avg(CASE WHEN treatment_group = 'treatment' THEN outcome::DOUBLE END) AS rate_treatment,
  avg(CASE WHEN treatment_group = 'control' THEN outcome::DOUBLE END) AS rate_control
  FROM joined {group}))"""


_RATES_SQL = """round(rate_treatment, 6) AS rate_treatment, round(rate_control, 6) AS rate_control,
  round(difference, 6) AS difference"""


@query("j5_overall_effect", with_scores(
    f"SELECT n_treatment, n_control, {_RATES_SQL} FROM effect", *_JOINED_SQL, _effect_sql()))
def _(spark, folder):
    effect = itt.overall_effect(itt.outcome_cells(*_stored_experiment(spark, folder)))
    return rounded(
        effect.select("n_treatment", "n_control", "rate_treatment", "rate_control", "difference"),
        "rate_treatment", "rate_control", "difference",
    )


@query("j6_wald_interval", with_scores("""
SELECT round(difference - z * se, 6) AS ci_low, round(difference + z * se, 6) AS ci_high
FROM (SELECT difference, 1.959963984540054::DOUBLE AS z,
  sqrt(rate_treatment * (1 - rate_treatment) / n_treatment
    + rate_control * (1 - rate_control) / n_control) AS se FROM effect)""",
    *_JOINED_SQL, _effect_sql()))
def _(spark, folder):
    effect = itt.overall_effect(itt.outcome_cells(*_stored_experiment(spark, folder)))
    return rounded(effect.select("ci_low", "ci_high"), "ci_low", "ci_high")


@query("j7_randomization_test")
def _(spark, folder):
    cells = itt.outcome_cells(*_stored_experiment(spark, folder))
    return itt.permutation_p_value(cells, 10_000, 42)


_EXACT_SQL = """
SELECT round(sum(p), 9) AS p_value_exact FROM (
  WITH RECURSIVE dist AS (
    SELECT 0::BIGINT AS b, 0::BIGINT AS k, 1.0::DOUBLE AS p
    UNION ALL
    SELECT d.b + 1, d.k + m.k, sum(d.p * m.p) FROM dist d JOIN chances m ON m.b = d.b + 1 GROUP BY 1, 2)
  SELECT k, p FROM dist WHERE b = (SELECT max(b) FROM chances)), (
  SELECT sum(t) AS nt, sum(n - t) AS nc, sum(pos) AS pos, sum(tp)::DOUBLE / sum(t) - sum(pos - tp)::DOUBLE / sum(n - t) AS d
  FROM bands)
WHERE abs(k::DOUBLE / nt - (pos - k)::DOUBLE / nc) >= abs(d) - 1e-12"""
_BANDS_SQL = """
bands AS (SELECT row_number() OVER (ORDER BY risk_band) AS b, count(*) AS n, sum(outcome)::BIGINT AS pos,
  count(*) FILTER (treatment_group = 'treatment') AS t,
  coalesce(sum(outcome) FILTER (treatment_group = 'treatment'), 0)::BIGINT AS tp FROM joined GROUP BY risk_band)"""
_CHANCES_SQL = """
chances AS (SELECT b, k, exp(lgamma(pos + 1) - lgamma(k + 1) - lgamma(pos - k + 1) + lgamma(n - pos + 1)
    - lgamma(t - k + 1) - lgamma(n - pos - t + k + 1) - lgamma(n + 1) + lgamma(t + 1) + lgamma(n - t + 1)) AS p
  FROM bands, range(greatest(0, t - (n - pos)), least(t, pos) + 1) AS r(k))"""


@query("j7_exact_p_value", with_scores(_EXACT_SQL, *_JOINED_SQL, _BANDS_SQL, _CHANCES_SQL))
def _(spark, folder):
    cells = itt.outcome_cells(*_stored_experiment(spark, folder))
    return spark.createDataFrame([(round(itt.exact_p_value(cells), 9),)], "p_value_exact double")


@query("j8_label_shuffle", with_scores("""
SELECT CAST(permutation AS INTEGER) AS permutation,
  round(avg(CASE WHEN place <= k THEN outcome::DOUBLE END)
    - avg(CASE WHEN place > k THEN outcome::DOUBLE END), 6) AS difference
FROM (SELECT *, row_number() OVER (PARTITION BY permutation, risk_band ORDER BY
    md5(concat_ws(':', CAST(CustomerID AS VARCHAR), 'shuffle', CAST(permutation AS VARCHAR), '42')),
    CustomerID) AS place,
  count(CASE WHEN treatment_group = 'treatment' THEN 1 END) OVER (PARTITION BY permutation,
    risk_band) AS k FROM joined, generate_series(1, 5) AS p(permutation))
GROUP BY permutation""", *_JOINED_SQL))
def _(spark, folder):
    joined = itt.join_outcomes(*_stored_experiment(spark, folder))
    return rounded(itt.shuffled_differences(joined, 5, 42), "difference")


@query("j9_band_effects", with_scores(
    f"SELECT risk_band, n_treatment, n_control, {_RATES_SQL} FROM effect",
    *_JOINED_SQL, _effect_sql("risk_band")))
def _(spark, folder):
    effects = itt.band_effects(itt.outcome_cells(*_stored_experiment(spark, folder)))
    return rounded(effects, "rate_treatment", "rate_control", "difference")


@query("j9_many_bands", with_scores(
    f"SELECT risk_band, n_treatment, n_control, {_RATES_SQL} FROM effect",
    _assign_sql(pool="1.0", treated="0.5", bands=10**6), *_JOINED_SQL[1:], _effect_sql("risk_band")))
def _(spark, folder):
    scored = stored_scores(spark, folder)
    assigned = stage_table(
        assignment.assign_experiment(scored, risk_pool_fraction=1.0, n_risk_bands=10**6), "assigned"
    )
    outcomes = scored.select("CustomerID", F.col("Churn").alias("outcome"))
    report = itt.analyze_experiment(assigned, outcomes)
    return rounded(report.by_band, "rate_treatment", "rate_control", "difference")


@query("j11_analysis_report")
def _(spark, folder):
    report = itt.analyze_experiment(
        *_stored_experiment(spark, folder), n_permutations=10_000, random_state=42
    )
    return report.overall


@query("a11_analysis_record", with_scores(f"""
SELECT n_treatment, n_control, {_RATES_SQL}, (SELECT CAST(count(DISTINCT risk_band) AS INTEGER)
  FROM joined) AS n_bands, (SELECT count(*) FROM joined) AS assignment_rows,
  (SELECT CAST(sum(CAST(('0x' || substr(h, 1, 8)) AS BIGINT)) AS VARCHAR) || '-'
    || CAST(sum(CAST(('0x' || substr(h, 9, 8)) AS BIGINT)) AS VARCHAR)
    FROM (SELECT md5(CustomerID || '|' || outcome) AS h FROM outcomes)) AS outcomes_digest
FROM effect""", *_JOINED_SQL, _effect_sql()))
def _(spark, folder):
    assigned, outcomes = _stored_experiment(spark, folder)
    report = itt.analyze_experiment(assigned, outcomes, n_permutations=10_000)
    record = analysis_record(report, assigned, outcomes, "outcome", 42)
    out = record.select(
        *[f"overall.{c}" for c in ("n_treatment", "n_control", "rate_treatment", "rate_control",
                                   "difference")],
        F.size("by_band").alias("n_bands"),
        F.col("metadata.assignments.n_rows").alias("assignment_rows"),
        F.col("metadata.outcomes.digest").alias("outcomes_digest"),
    )
    return rounded(out, "rate_treatment", "rate_control", "difference")


# --- value ---------------------------------------------------------------------------------------


@query("l1_expected_value", with_snapshot("""
SELECT CustomerID, round(p * coalesce(CashbackAmount, 0) * 0.3::DOUBLE - 25.0::DOUBLE, 4)
  AS expected_value
FROM (SELECT *, coalesce(DaySinceLastOrder / (DaySinceLastOrder + 365.0::DOUBLE), 0.5::DOUBLE)
  AS p FROM snap)"""))
def _(spark, folder):
    from holdfast.catalog.inputs import snapshot
    from holdfast.sources.snapshot import recency_score

    df = snapshot(spark, folder).select(
        "CustomerID", recency_score().alias("churn_probability"), "CashbackAmount"
    )
    margin = F.coalesce(F.col("CashbackAmount"), F.lit(0.0))
    ranked = value.rank_by_value(df, margin, success_rate=0.3, offer_cost=25.0)
    return rounded(ranked.select("CustomerID", "expected_value"), "expected_value", places=4)


@query("l2_incremental_profit", with_scores("""
SELECT round(pt, 6) AS profit_treatment, round(pc, 6) AS profit_control,
  round(pt - pc, 6) AS incremental_profit
FROM (SELECT avg(CASE WHEN treatment_group = 'treatment' THEN (1 - outcome) * 100.0::DOUBLE
    - 7.5::DOUBLE END) AS pt,
  avg(CASE WHEN treatment_group = 'control' THEN (1 - outcome) * 100.0::DOUBLE END) AS pc
  FROM joined)""", *_JOINED_SQL))
def _(spark, folder):
    joined = itt.join_outcomes(*_stored_experiment(spark, folder))
    kept = (F.lit(1) - F.col("outcome")) * F.lit(100.0)
    out = itt.profit_effect(joined, kept, F.lit(7.5))
    return rounded(out, *out.columns)
