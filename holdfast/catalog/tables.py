"""Sources, sinks, checks, cleaning and encoding."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from holdfast.catalog.inputs import (
    ALIASES, COARSE, NUMBERS, REGIONS, SEGMENTS, SNAPSHOT_RULES, TYPES, coarse, quoted, rounded,
    scores, snapshot, stored_snapshot, with_scores, with_snapshot,
)
from holdfast.catalog.registry import query
from holdfast.operators import cleaning, encoding, quality
from holdfast.plans.prepare import prepare_table
from holdfast.session import stage_table, staging_path
from holdfast.sources.customers import (
    NA_TOKENS, load_customers, load_with_rescue, rescue_report,
)
from holdfast.sources.fingerprints import table_fingerprint
from holdfast.sources.sinks import write_cleaned, write_ranked, write_table
from holdfast.sources.snapshot import table

# --- sources and sinks ---------------------------------------------------------------------------


@query("a0_customer_snapshot", with_snapshot("SELECT * FROM snap"))
def _(spark, folder):
    return snapshot(spark, folder)


@query("a1_load_customers", f"""
SELECT c_custkey, CASE WHEN c_name NOT IN ({quoted(NA_TOKENS)}) THEN c_name END AS c_name,
  c_nationkey, CASE WHEN NOT isnan(c_acctbal) THEN c_acctbal END AS c_acctbal,
  CASE WHEN c_mktsegment NOT IN ({quoted(NA_TOKENS)}) THEN c_mktsegment END AS c_mktsegment
FROM customer""")
def _(spark, folder):
    return load_customers(spark, f"{folder}/customer.parquet")


_CSV_SQL = """
WITH raw AS (
  SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey, c_acctbal,
    CASE c_custkey % 10 WHEN 3 THEN c_custkey || ' EUR' WHEN 5 THEN 'n/a' END AS odd, c_mktsegment
  FROM customer)"""


def _customer_csv(spark, folder):
    """The customers written as CSV with some balances that are no numbers, read back with what does not fit."""
    path = f"{staging_path(spark, 'customers')}.csv"
    balance = (
        F.when(F.col("c_custkey") % 10 == 3, F.concat(F.col("c_custkey").cast("string"), F.lit(" EUR")))
        .when(F.col("c_custkey") % 10 == 5, "n/a").otherwise(F.col("c_acctbal").cast("string"))
    )
    table(spark, folder, "customer").withColumn("c_acctbal", balance).write.csv(path, header=True, escape='"')
    return load_with_rescue(
        spark, path, "c_custkey bigint, c_name int, c_acctbal double, c_nationkey int, c_phone string")


@query("a1_csv_types", _CSV_SQL + """
SELECT CAST(c_custkey AS BIGINT) AS c_custkey, TRY_CAST(c_name AS INTEGER) AS c_name,
  CASE WHEN odd IS NULL THEN c_acctbal END AS c_acctbal, CAST(c_nationkey AS INTEGER) AS c_nationkey,
  CAST(NULL AS VARCHAR) AS c_phone, CASE WHEN odd <> 'n/a' THEN odd END AS raw_balance, c_name AS raw_name,
  c_mktsegment AS raw_segment
FROM raw""")
def _(spark, folder):
    df = _customer_csv(spark, folder)
    raw = {"raw_balance": "c_acctbal", "raw_name": "c_name", "raw_segment": "c_mktsegment"}
    return df.withColumns({name: F.col("rescued")[c] for name, c in raw.items()}).drop("rescued")


@query("a1_csv_failures", _CSV_SQL + """
SELECT column_name, count(raw) AS n_failed, min(raw) AS first_raw, max(raw) AS last_raw FROM (
  SELECT 'c_acctbal' AS column_name, nullif(odd, 'n/a') AS raw FROM raw UNION ALL
  SELECT 'c_name', c_name FROM raw UNION ALL SELECT 'c_mktsegment', c_mktsegment FROM raw)
WHERE raw IS NOT NULL GROUP BY column_name""")
def _(spark, folder):
    return rescue_report(_customer_csv(spark, folder))


_CLEAN_SQL = """
cleaned AS (
  SELECT Churn, CASE WHEN MarketSegment = 'FURNITURE' THEN 'HOUSEHOLD' ELSE MarketSegment END
      AS MarketSegment,
    Region, InCredit, OrderCount, CAST(OrderCount IS NULL AS INTEGER) AS OrderCount_missing,
    min(CustomerID) AS row_key
  FROM snap GROUP BY ALL
)"""


def _cleaned(spark, folder):
    return cleaning.clean(coarse(spark, folder), "Churn", aliases=ALIASES,
                          missing_columns=["OrderCount"])


@query("a2_write_cleaned", with_snapshot("SELECT * EXCLUDE (row_key) FROM cleaned", _CLEAN_SQL))
def _(spark, folder):
    path = staging_path(spark, "cleaned") + ".csv"
    write_cleaned(_cleaned(spark, folder), path)
    return load_customers(
        spark, path,
        "Churn int, MarketSegment string, Region string, InCredit string, OrderCount long, "
        "OrderCount_missing int",
    )


def _dummies_sql(values, column: str) -> str:
    return ", ".join(
        f"CAST(coalesce({column} = '{v}', false) AS INTEGER) AS \"{column}_{v}\""
        for v in values[1:]
    )


_ENCODED_SQL = ", ".join([
    "CAST(InCredit = 'Yes' AS INTEGER) AS InCredit", *NUMBERS,
    _dummies_sql(SEGMENTS, "MarketSegment"), _dummies_sql(REGIONS, "Region"),
    _dummies_sql(TYPES, "PreferedOrderCat"),
])


def _encoded(spark, folder):
    df = cleaning.set_ids_aside(stored_snapshot(spark, folder))
    return encoding.apply_feature_schema(df, encoding.fit_feature_schema(df, "Churn"))


@query("a3_write_features", with_snapshot(f"SELECT Churn, {_ENCODED_SQL} FROM snap"))
def _(spark, folder):
    path = staging_path(spark, "features")
    write_cleaned(_encoded(spark, folder), path)
    return load_customers(spark, path)


@query("a4_write_ranked_scores",
       with_scores("SELECT CustomerID, churn_probability FROM scores"))
def _(spark, folder):
    path = staging_path(spark, "ranked")
    write_ranked(scores(spark, folder).drop("Churn"), path)
    return load_customers(spark, path)


@query("a9_table_fingerprint", r"""
WITH rows AS (
  SELECT md5(concat_ws('|', CAST(o_orderkey AS VARCHAR), CAST(o_custkey AS VARCHAR),
    replace(replace(o_orderstatus, '\', '\\'), '|', '\|'),
    CAST(CAST(round(o_totalprice * 100) AS BIGINT) AS VARCHAR),
    replace(replace(o_orderpriority, '\', '\\'), '|', '\|'))) AS h FROM orders)
SELECT count(*) AS n_rows,
  CAST(sum(CAST(('0x' || substr(h, 1, 8)) AS BIGINT)) AS VARCHAR) || '-'
  || CAST(sum(CAST(('0x' || substr(h, 9, 8)) AS BIGINT)) AS VARCHAR) AS digest
FROM rows""")
def _(spark, folder):
    cents = F.rint(F.col("o_totalprice") * 100).cast("long").alias("cents")
    return table_fingerprint(table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", cents, "o_orderpriority"
    ))


# --- quality checks ------------------------------------------------------------------------------


def _check_sql() -> str:
    rules, rows = SNAPSHOT_RULES, []

    def add(kind: str, column: str, checked: str, bad: str, mostly: float) -> None:
        rows.append(
            f"SELECT CAST({len(rows) + 1} AS INTEGER) AS check_no, '{kind}' AS check_type, "
            f"'{column}' AS column_name, {checked} AS n_checked, {bad} AS n_bad, "
            f"CAST({mostly} AS DOUBLE) AS mostly FROM snap"
        )

    for c in rules.required:
        add(quality.EXISTS, c, "count(*)", "CAST(0 AS BIGINT)", 1.0)
    for c, values in rules.value_sets.items():
        members = ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)
        add(quality.IN_SET, c, f"count({c})",
            f"count(CASE WHEN {c} NOT IN ({members}) THEN 1 END)", 1.0)
    for c, (low, high, mostly) in rules.ranges.items():
        ends = [f"{c} < {low}"] if low is not None else []
        ends += [f"{c} > {high}"] if high is not None else []
        add(quality.BETWEEN, c, f"count({c})",
            f"count(CASE WHEN {' OR '.join(ends)} THEN 1 END)", mostly or 1.0)
    for c in rules.not_null:
        add(quality.NOT_NULL, c, "count(*)", f"count(*) - count({c})", 1.0)
    return "checks AS (SELECT * EXCLUDE (mostly), CASE WHEN n_checked = 0 THEN true ELSE " \
        "1 - n_bad / n_checked::DOUBLE >= mostly END AS success FROM (" \
        + " UNION ALL ".join(rows) + "))"


def _checks(spark, folder):
    return quality.check_table(snapshot(spark, folder), SNAPSHOT_RULES)


def _checks_of(kind: str) -> str:
    return with_snapshot(f"SELECT * FROM checks WHERE check_type = '{kind}'", _check_sql())


@query("b1_columns_exist", _checks_of(quality.EXISTS))
def _(spark, folder):
    return _checks(spark, folder).filter(F.col("check_type") == quality.EXISTS)


@query("b2_values_in_set", _checks_of(quality.IN_SET))
def _(spark, folder):
    return _checks(spark, folder).filter(F.col("check_type") == quality.IN_SET)


@query("b3_values_between", _checks_of(quality.BETWEEN))
def _(spark, folder):
    return _checks(spark, folder).filter(F.col("check_type") == quality.BETWEEN)


@query("b4_not_null", _checks_of(quality.NOT_NULL))
def _(spark, folder):
    return _checks(spark, folder).filter(F.col("check_type") == quality.NOT_NULL)


_SUMMARY_SQL = with_snapshot("""
SELECT count(*) AS total_checks, count(CASE WHEN success THEN 1 END) AS passed_checks,
  count(CASE WHEN NOT success THEN 1 END) AS failed_checks,
  coalesce(string_agg(CASE WHEN NOT success THEN check_type END, ',' ORDER BY check_no), '')
    AS failures
FROM checks""", _check_sql())


@query("b5_check_summary", _SUMMARY_SQL)
def _(spark, folder):
    return quality.summarize_checks(_checks(spark, folder))


@query("b6_quality_gate", with_snapshot("""
SELECT CAST(bool_and(success) AS INTEGER) AS data_quality_pass,
  count(CASE WHEN NOT success THEN 1 END) AS n_failures FROM checks""", _check_sql()))
def _(spark, folder):
    df = snapshot(spark, folder)
    try:
        passed, n = int(quality.quality_gate(df, SNAPSHOT_RULES)), 0
    except quality.QualityError as error:
        passed, n = 0, len(error.failures)
    return spark.createDataFrame([(passed, n)], "data_quality_pass int, n_failures long")


@query("b7_target_check", with_snapshot("""
SELECT count(*) AS n_rows, count(*) - count(Churn) AS n_null,
  count(CASE WHEN Churn NOT IN (0, 1) THEN 1 END) AS n_not_binary,
  count(*) = count(CASE WHEN Churn IN (0, 1) THEN 1 END) AS target_ok FROM snap"""))
def _(spark, folder):
    return quality.target_profile(snapshot(spark, folder), "Churn")


@query("b8_target_exists", with_snapshot(
    "SELECT count(*) AS n_rows, sum(Churn)::BIGINT AS n_positive FROM snap"))
def _(spark, folder):
    df = snapshot(spark, folder)
    quality.require_target(df, "Churn")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum("Churn").alias("n_positive"))


# --- cleaning ------------------------------------------------------------------------------------


@query("c1_trim_headers", "SELECT c_custkey, c_mktsegment, c_acctbal FROM customer")
def _(spark, folder):
    padded = table(spark, folder, "customer").select(
        F.col("c_custkey").alias("  c_custkey"), F.col("c_mktsegment").alias("c_mktsegment "),
        F.col("c_acctbal").alias("\tc_acctbal "),
    )
    return cleaning.trim_headers(padded)


@query("c2_set_ids_aside", with_snapshot(
    "SELECT * EXCLUDE (CustomerID), CustomerID AS row_key FROM snap"))
def _(spark, folder):
    return cleaning.set_ids_aside(snapshot(spark, folder))


@query("c3_map_target", with_snapshot("""
SELECT CustomerID, CASE trim(answer) WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS answer FROM (
  SELECT CustomerID, CASE Region WHEN 'ASIA' THEN ' ' || InCredit || ' ' WHEN 'AFRICA' THEN 'yes'
    ELSE InCredit END AS answer FROM snap)"""))
def _(spark, folder):
    padded = F.when(F.col("Region") == "ASIA", F.concat(F.lit(" "), "InCredit", F.lit(" ")))
    answer = padded.when(F.col("Region") == "AFRICA", "yes").otherwise(F.col("InCredit"))
    df = snapshot(spark, folder).select("CustomerID", answer.alias("answer"))
    return cleaning.map_target(df, "answer")


@query("c4_collapse_aliases", with_snapshot("""
SELECT CustomerID,
  CASE WHEN MarketSegment = 'FURNITURE' THEN 'HOUSEHOLD' ELSE MarketSegment END AS MarketSegment,
  CASE WHEN PreferedOrderCat = 'SMALL' THEN 'MEDIUM' ELSE PreferedOrderCat END AS PreferedOrderCat
FROM snap"""))
def _(spark, folder):
    return cleaning.collapse_aliases(snapshot(spark, folder), ALIASES).select(
        "CustomerID", "MarketSegment", "PreferedOrderCat"
    )


@query("c5_missing_indicators", with_snapshot("""
SELECT column_name, n_missing FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}_missing' AS column_name, count(*) - count({c}) AS n_missing FROM snap"
    for c in NUMBERS) + ") WHERE n_missing > 0"))
def _(spark, folder):
    df = cleaning.set_ids_aside(stored_snapshot(spark, folder))
    found = cleaning.fit_missing_columns(df, "Churn")
    marked = cleaning.add_missing_indicators(df, found)
    return marked.select(F.explode(F.array(*[
        F.struct(F.lit(f"{c}_missing").alias("column_name"),
                 F.col(f"{c}_missing").cast("long").alias("v")) for c in found
    ])).alias("m")).groupBy("m.column_name").agg(F.sum("m.v").alias("n_missing"))


@query("c6_duplicate_report", with_snapshot("""
SELECT n_before, n_after, n_before - n_after AS n_dropped,
  (n_before - n_after) / n_before::DOUBLE AS dropped_share
FROM (SELECT (SELECT count(*) FROM snap) AS n_before, (SELECT count(*) FROM (
  SELECT DISTINCT MarketSegment, Region, InCredit, OrderCount FROM snap)) AS n_after)"""))
def _(spark, folder):
    return cleaning.duplicate_report(
        coarse(spark, folder), ["MarketSegment", "Region", "InCredit", "OrderCount"]
    )


@query("c7_clean", with_snapshot("SELECT * FROM cleaned", _CLEAN_SQL))
def _(spark, folder):
    return _cleaned(spark, folder)


@query("c8_fit_medians", with_snapshot(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(median(CAST({c} AS DOUBLE)), 6) AS median FROM snap"
    for c in ("Churn", *NUMBERS))))
def _(spark, folder):
    df = stored_snapshot(spark, folder)
    medians = cleaning.fit_medians(df, ["Churn", *NUMBERS])
    return rounded(
        spark.createDataFrame(list(medians.items()), "column_name string, median double"),
        "median",
    )


@query("c8_line_medians", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(median({c}), 6) AS median FROM lineitem"
    for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")))
def _(spark, folder):
    df = table(spark, folder, "lineitem")
    medians = cleaning.fit_medians(
        df, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    )
    return rounded(
        spark.createDataFrame(list(medians.items()), "column_name string, median double"),
        "median",
    )


_MEDIANS_SQL = "med AS (SELECT " + ", ".join(
    f"median(CAST({c} AS DOUBLE)) AS m_{c}" for c in NUMBERS) + " FROM snap)"


@query("c9_impute_numeric", with_snapshot(
    "SELECT CustomerID, " + ", ".join(
        f"round(coalesce(CAST({c} AS DOUBLE), m_{c}), 6) AS {c}" for c in NUMBERS)
    + " FROM snap, med", _MEDIANS_SQL))
def _(spark, folder):
    df = stored_snapshot(spark, folder).select("CustomerID", *NUMBERS)
    imputed, _ = cleaning.impute_numeric(df, skip=("CustomerID",))
    return rounded(imputed, *NUMBERS)


@query("c10_residual_gaps", with_snapshot(
    "SELECT CustomerID, 0.0::DOUBLE AS Unknown, coalesce(Tenure, 0.0::DOUBLE) AS Tenure FROM snap"))
def _(spark, folder):
    df = snapshot(spark, folder).select(
        "CustomerID", F.lit(None).cast("double").alias("Unknown"), "Tenure"
    )
    return cleaning.apply_medians(df, {"Unknown": None, "Tenure": None})


@query("c11_bools_to_ints", with_snapshot(
    "SELECT CustomerID, CAST(InCredit = 'Yes' AS INTEGER) AS credit, "
    "CAST(OrderCount > 10 AS INTEGER) AS busy FROM snap"))
def _(spark, folder):
    return cleaning.bools_to_ints(snapshot(spark, folder).select(
        "CustomerID", (F.col("InCredit") == "Yes").alias("credit"),
        (F.col("OrderCount") > 10).alias("busy"),
    ))


# --- encoding ------------------------------------------------------------------------------------


@query("d1_fit_binary", with_snapshot("""
SELECT 'InCredit' AS column_name, InCredit AS value,
  CAST(row_number() OVER (ORDER BY InCredit) - 1 AS INTEGER) AS code
FROM (SELECT DISTINCT InCredit FROM snap)"""))
def _(spark, folder):
    schema = encoding.fit_feature_schema(stored_snapshot(spark, folder).drop("CustomerID"), "Churn")
    rows = [(c, v, code) for c, m in schema.binary.items() for v, code in m.items()]
    return spark.createDataFrame(rows, "column_name string, value string, code int")


_TEXT = ("MarketSegment", "Region", "PreferedOrderCat")


@query("d2_fit_categories", with_snapshot(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS value, CAST(row_number() OVER (ORDER BY {c}) - 1 "
    f"AS INTEGER) AS position FROM (SELECT DISTINCT {c} FROM snap WHERE {c} IS NOT NULL)"
    for c in _TEXT)))
def _(spark, folder):
    schema = encoding.fit_feature_schema(stored_snapshot(spark, folder).drop("CustomerID"), "Churn")
    rows = [(c, v, i) for c, vs in schema.multi.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "column_name string, value string, position int")


_ORDER = ["InCredit", *NUMBERS] + [
    f"{c}_{v}" for c, vs in
    (("MarketSegment", SEGMENTS), ("Region", REGIONS), ("PreferedOrderCat", TYPES))
    for v in vs[1:]
]


@query("d3_feature_order", with_snapshot(
    "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(_ORDER))
    + ") AS t(position, feature) WHERE feature NOT LIKE '%\\_%' ESCAPE '\\' OR feature IN ("
    + " UNION ALL ".join(
        f"SELECT '{c}_' || {c} FROM snap WHERE {c} IS NOT NULL" for c in _TEXT) + ")"))
def _(spark, folder):
    schema = encoding.fit_feature_schema(stored_snapshot(spark, folder).drop("CustomerID"), "Churn")
    return spark.createDataFrame(list(enumerate(schema.feature_columns)),
                                 "position int, feature string")


@query("d4_encode_binary", with_snapshot("""
SELECT CustomerID, CAST(InCredit = 'Yes' AS INTEGER) AS InCredit,
  CAST(coalesce(answer = 'Yes', false) AS INTEGER) AS answer FROM (
  SELECT *, CASE Region WHEN 'ASIA' THEN NULL WHEN 'AFRICA' THEN 'Maybe' ELSE InCredit END
  AS answer FROM snap)"""))
def _(spark, folder):
    answer = F.when(F.col("Region") == "AFRICA", "Maybe").when(
        F.col("Region") != "ASIA", F.col("InCredit")
    )
    df = snapshot(spark, folder).withColumn("answer", answer)
    codes = {"No": 0, "Yes": 1}
    return df.select(
        "CustomerID", encoding.encode_binary("InCredit", codes).alias("InCredit"),
        encoding.encode_binary("answer", codes).alias("answer"),
    )


@query("d5_unseen_values", with_snapshot("""
SELECT 'InCredit' AS column_name, 'N' AS value, count(*) AS n FROM snap
WHERE InCredit = 'No' HAVING count(*) > 0"""))
def _(spark, folder):
    df = stored_snapshot(spark, folder).drop("CustomerID")
    schema = encoding.fit_feature_schema(df, "Churn")
    drifted = df.replace({"No": "N"}, subset=["InCredit"])
    return encoding.unseen_binary_values(drifted, schema)


@query("d2_many_categories", """
SELECT column_name, row_number() OVER (PARTITION BY column_name ORDER BY value) - 1 AS code, value,
  count(*) OVER (PARTITION BY column_name) AS size
FROM (SELECT DISTINCT 'c_name' AS column_name, c_name AS value FROM customer
  UNION ALL SELECT DISTINCT 'c_mktsegment', c_mktsegment FROM customer)""")
def _(spark, folder):
    df = spark.read.parquet(f"{folder}/customer.parquet")
    return encoding.fit_categories(df, ["c_name", "c_mktsegment"])


@query("d6_sparse_one_hot", """
SELECT c_custkey, column_name, CAST(code - 1 AS INTEGER) AS position, CAST(size - 1 AS INTEGER) AS length
FROM (SELECT c_custkey, 'c_mktsegment' AS column_name, dense_rank() OVER (ORDER BY c_mktsegment) - 1 AS code,
    (SELECT count(DISTINCT c_mktsegment) FROM customer) AS size FROM customer
  UNION ALL SELECT c_custkey, 'c_nationkey', dense_rank() OVER (ORDER BY CAST(c_nationkey AS VARCHAR)) - 1,
    (SELECT count(DISTINCT c_nationkey) FROM customer) FROM customer)
WHERE code > 0""")
def _(spark, folder):
    df = spark.read.parquet(f"{folder}/customer.parquet").select("c_custkey", "c_mktsegment", "c_nationkey")
    columns = ["c_mktsegment", "c_nationkey"]
    rows = encoding.one_hot_vectors(df, encoding.fit_categories(df, columns), columns)
    return rows.select("c_custkey", F.explode(F.array(*[
        F.struct(F.lit(c).alias("column_name"), vector_to_array(f"{c}_vector").alias("v")) for c in columns
    ])).alias("e")).select(
        "c_custkey", "e.column_name", (F.array_position("e.v", 1.0) - 1).cast("int").alias("position"),
        F.size("e.v").alias("length"),
    ).filter("position >= 0")


@query("d6_one_hot", with_snapshot(
    "SELECT CustomerID, " + ", ".join([
        _dummies_sql(SEGMENTS, "MarketSegment"), _dummies_sql(REGIONS, "Region"),
        _dummies_sql(TYPES, "PreferedOrderCat")]) + " FROM snap"))
def _(spark, folder):
    df = stored_snapshot(spark, folder)
    values = encoding.distinct_values(df, list(_TEXT))
    return df.select("CustomerID", *[
        encoding.encode_dummy(c, v).alias(encoding.dummy_name(c, v))
        for c, vs in values.items() for v in vs[1:]
    ])


@query("d7_reindex", with_snapshot(
    "SELECT Churn, CustomerID AS row_key, " + _ENCODED_SQL.replace(
        "CashbackAmount", "CAST(0 AS INTEGER) AS CashbackAmount") + " FROM snap"))
def _(spark, folder):
    df = cleaning.set_ids_aside(stored_snapshot(spark, folder))
    schema = encoding.fit_feature_schema(df, "Churn")
    batch = df.drop("CashbackAmount").withColumn("Extra", F.lit(1))
    return encoding.apply_feature_schema(batch, schema)


@query("d8_encode", with_snapshot(
    f"SELECT CustomerID AS row_key, Churn, {_ENCODED_SQL} FROM snap"))
def _(spark, folder):
    return _encoded(spark, folder)


@query("d9_prepare_table", with_snapshot("""
SELECT row_key, Churn, CAST(InCredit = 'Yes' AS DOUBLE) AS InCredit,
  coalesce(CAST(OrderCount AS DOUBLE), m) AS OrderCount,
  CAST(OrderCount_missing AS DOUBLE) AS OrderCount_missing, """ + ", ".join(
    f"CAST({c} = '{v}' AS INTEGER) AS \"{c}_{v}\""
    for c, vs in (("MarketSegment", ("AUTOMOBILE", "BUILDING", "HOUSEHOLD", "MACHINERY")),
                  ("Region", REGIONS)) for v in vs[1:])
    + " FROM cleaned, (SELECT median(CAST(OrderCount AS DOUBLE)) AS m FROM cleaned)", _CLEAN_SQL))
def _(spark, folder):
    out = prepare_table(stage_table(coarse(spark, folder), "coarse"), "Churn", aliases=ALIASES).features
    flag = F.col("OrderCount_missing") if "OrderCount_missing" in out.columns else F.lit(0.0)
    return out.withColumns({
        "InCredit": F.col("InCredit").cast("double"), "OrderCount_missing": flag
    })
