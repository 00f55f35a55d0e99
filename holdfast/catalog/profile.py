"""Exploratory profile."""

from __future__ import annotations

from pyspark.sql import functions as F

from holdfast.catalog.inputs import ALIASES, NUMBERS, REGIONS, rounded, snapshot, stored_snapshot, with_snapshot
from holdfast.catalog.registry import query
from holdfast.operators import cleaning, encoding, profiling
from holdfast.sources.snapshot import table

_COLUMNS = (
    ("CustomerID", "bigint"), ("Churn", "int"), ("MarketSegment", "string"), ("Region", "string"),
    ("InCredit", "string"), ("PreferedOrderCat", "string"), ("Tenure", "double"),
    ("DaySinceLastOrder", "double"), ("DaySinceLastUrgent", "double"), ("OrderCount", "bigint"),
    ("CashbackAmount", "double"),
)
_TEXT = ("MarketSegment", "Region", "InCredit", "PreferedOrderCat")
_NUMERIC = ("Churn", *NUMBERS)


@query("k1_shape", with_snapshot(
    "SELECT count(*) AS n_rows, CAST(11 AS INTEGER) AS n_columns FROM snap"))
def _(spark, folder):
    return profiling.table_shape(snapshot(spark, folder))


@query("k1_first_rows", with_snapshot("SELECT * FROM snap ORDER BY CustomerID LIMIT 5"))
def _(spark, folder):
    return snapshot(spark, folder).orderBy("CustomerID").limit(5)


@query("k2_column_types", with_snapshot(" UNION ALL ".join(
    f"SELECT CAST({i} AS INTEGER) AS column_no, '{c}' AS column_name, '{t}' AS column_type, "
    f"count({c}) AS non_null FROM snap" for i, (c, t) in enumerate(_COLUMNS))))
def _(spark, folder):
    return profiling.column_types(snapshot(spark, folder))


@query("k3_duplicate_counts", with_snapshot("""
SELECT CAST(0 AS BIGINT) AS duplicates_with_id, (SELECT count(*) FROM snap) - count(*)
  AS duplicates_without_id
FROM (SELECT DISTINCT MarketSegment, Region, InCredit, OrderCount FROM snap)"""))
def _(spark, folder):
    df = snapshot(spark, folder).select(
        "CustomerID", "MarketSegment", "Region", "InCredit", "OrderCount"
    )
    return profiling.duplicate_counts(df, "CustomerID")


@query("k4_distinct_counts", with_snapshot(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM snap"
    for c, _ in _COLUMNS)))
def _(spark, folder):
    return profiling.distinct_counts(snapshot(spark, folder))


_LINE_COLUMNS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus", "l_shipdate",
)


@query("k4_many_columns", " UNION ALL ".join(
    f"SELECT '{c}_{i}' AS column_name, count(DISTINCT {c}) AS n_distinct FROM lineitem"
    for i in range(20) for c in _LINE_COLUMNS))
def _(spark, folder):
    """A table of 220 columns."""
    lines = table(spark, folder, "lineitem")
    return profiling.distinct_counts(
        lines.select(*[F.col(c).alias(f"{c}_{i}") for i in range(20) for c in _LINE_COLUMNS]))


@query("k5_columns_by_kind", with_snapshot(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{'other' if t == 'string' else 'numeric'}' AS kind, "
    f"count({c}) AS non_null FROM snap" for c, t in _COLUMNS)))
def _(spark, folder):
    df = snapshot(spark, folder)
    numeric = profiling.columns_by_kind(df)["numeric"]
    kind = F.when(F.col("column_name").isin(numeric), "numeric").otherwise("other")
    return profiling.column_types(df).select("column_name", kind.alias("kind"), "non_null")


_VALUES_SQL = "vals AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS value, count(*) AS n FROM snap WHERE {c} IS NOT NULL "
    f"GROUP BY {c}" for c in _TEXT) + ")"


@query("k6_describe_text", with_snapshot("""
SELECT column_name, CAST(sum(n) AS BIGINT) AS "count", count(*) AS n_distinct,
  first(value ORDER BY n DESC, value) AS top, max(n) AS freq
FROM vals GROUP BY column_name""", _VALUES_SQL))
def _(spark, folder):
    return profiling.describe_text(snapshot(spark, folder))


@query("k7_value_counts", with_snapshot("SELECT * FROM vals", _VALUES_SQL))
def _(spark, folder):
    return profiling.value_counts(snapshot(spark, folder))


@query("k8_describe_numbers", with_snapshot(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(v) AS \"count\", round(avg(v), 6) AS mean, "
    "round(stddev_samp(v), 6) AS std, round(min(v), 6) AS min, "
    "round(quantile_cont(v, 0.25), 6) AS p25, round(quantile_cont(v, 0.5), 6) AS p50, "
    "round(quantile_cont(v, 0.75), 6) AS p75, round(max(v), 6) AS max "
    f"FROM (SELECT CAST({c} AS DOUBLE) AS v FROM snap)" for c in _NUMERIC)))
def _(spark, folder):
    df = profiling.describe_numbers(stored_snapshot(spark, folder), _NUMERIC)
    return rounded(df, "mean", "std", "min", "p25", "p50", "p75", "max")


@query("k9_profile_recode", with_snapshot("""
SELECT CustomerID, CAST(InCredit = 'Yes' AS INTEGER) AS InCredit,
  CASE WHEN MarketSegment = 'FURNITURE' THEN 'HOUSEHOLD' ELSE MarketSegment END AS MarketSegment, """
    + ", ".join(f"CAST(Region = '{v}' AS INTEGER) AS \"Region_{v}\"" for v in REGIONS[1:])
    + " FROM snap"))
def _(spark, folder):
    df = cleaning.collapse_aliases(snapshot(spark, folder), ALIASES)
    return df.select(
        "CustomerID", encoding.encode_binary("InCredit", {"No": 0, "Yes": 1}).alias("InCredit"),
        "MarketSegment",
        *[encoding.encode_dummy("Region", v).alias(encoding.dummy_name("Region", v))
          for v in REGIONS[1:]],
    )


def _corr_sql(a: str, b: str) -> str:
    return (f"round(corr(CASE WHEN {b} IS NOT NULL THEN CAST({a} AS DOUBLE) END, "
            f"CASE WHEN {a} IS NOT NULL THEN CAST({b} AS DOUBLE) END), 6)")


@query("k10_target_correlations", with_snapshot(" UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {_corr_sql(c, 'Churn')} AS correlation FROM snap"
    for c in _NUMERIC)))
def _(spark, folder):
    df = profiling.target_correlations(snapshot(spark, folder), "Churn", _NUMERIC)
    return rounded(df, "correlation")


@query("k11_correlation_matrix", with_snapshot(" UNION ALL ".join(
    f"SELECT '{a}' AS row_name, '{b}' AS column_name, {_corr_sql(a, b)} AS correlation FROM snap"
    for a in _NUMERIC for b in _NUMERIC)))
def _(spark, folder):
    return rounded(
        profiling.correlation_matrix(snapshot(spark, folder), _NUMERIC), "correlation"
    )


_GRAM_SQL = "g AS (SELECT " + ", ".join(
    f"sum({a} * {b}) AS g{i}{j}"
    for i, a in enumerate(("Tenure", "DaySinceLastOrder", "OrderCount"))
    for j, b in enumerate(("Tenure", "DaySinceLastOrder", "OrderCount"))
) + """ FROM (SELECT Tenure, DaySinceLastOrder, CAST(OrderCount AS DOUBLE) AS OrderCount FROM snap
  WHERE Tenure IS NOT NULL AND DaySinceLastOrder IS NOT NULL AND OrderCount IS NOT NULL)),
d AS (SELECT *, g00 * (g11 * g22 - g12 * g12) - g01 * (g01 * g22 - g12 * g02)
  + g02 * (g01 * g12 - g11 * g02) AS det FROM g)"""


@query("k12_variance_inflation", with_snapshot("""
SELECT 'Tenure' AS feature, round(g00 * (g11 * g22 - g12 * g12) / det, 4) AS vif FROM d
UNION ALL SELECT 'DaySinceLastOrder', round(g11 * (g00 * g22 - g02 * g02) / det, 4) FROM d
UNION ALL SELECT 'OrderCount', round(g22 * (g00 * g11 - g01 * g01) / det, 4) FROM d""", _GRAM_SQL))
def _(spark, folder):
    df = profiling.variance_inflation(
        snapshot(spark, folder), ["Tenure", "DaySinceLastOrder", "OrderCount"]
    )
    return rounded(df, "vif", places=4)


def _determinant(rows: tuple[int, ...]) -> str:
    """The determinant of the products of the given columns, written out by cofactors."""
    def expand(left: tuple[int, ...], right: tuple[int, ...]) -> str:
        if not left:
            return "1.0"
        terms = [
            f"{'-' if k % 2 else '+'} s{min(left[0], j)}{max(left[0], j)} * "
            f"({expand(left[1:], right[:k] + right[k + 1:])})"
            for k, j in enumerate(right)
        ]
        return " ".join(terms)

    return expand(rows, rows)


_ALL = tuple(range(len(NUMBERS)))
# Products of columns that were divided by their norm, so that the determinants stay near 1.
_ALL_GRAM_SQL = (
    "x AS (SELECT " + ", ".join(f"CAST({c} AS DOUBLE) AS x{i}" for i, c in enumerate(NUMBERS))
    + " FROM snap WHERE " + " AND ".join(f"{c} IS NOT NULL" for c in NUMBERS) + ")",
    "p AS (SELECT " + ", ".join(f"sum(x{i} * x{j}) AS p{i}{j}" for i in _ALL for j in _ALL[i:]) + " FROM x)",
    "s AS (SELECT " + ", ".join(
        f"p{i}{j} / sqrt(p{i}{i} * p{j}{j}) AS s{i}{j}" for i in _ALL for j in _ALL[i:]) + " FROM p)",
)


@query("k12_all_features", with_snapshot(" UNION ALL ".join(
    f"SELECT '{c}' AS feature, round(({_determinant(_ALL[:i] + _ALL[i + 1:])}) / ({_determinant(_ALL)}), 4) AS vif FROM s"
    for i, c in enumerate(NUMBERS)), *_ALL_GRAM_SQL))
def _(spark, folder):
    return rounded(profiling.variance_inflation(snapshot(spark, folder), NUMBERS), "vif", places=4)
