"""Inputs shared by the queries, on Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.quality import QualityRules
from holdfast.session import stage_table
from holdfast.sources.snapshot import customer_snapshot, scored_snapshot, table

# The categories of the driver's tables.
SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")
REGIONS = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")
TYPES = ("ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD")
NUMBERS = ("Tenure", "DaySinceLastOrder", "DaySinceLastUrgent", "OrderCount", "CashbackAmount")

ALIASES = {
    "MarketSegment": {"FURNITURE": "HOUSEHOLD"},
    "PreferedOrderCat": {"SMALL": "MEDIUM"},
}
SNAPSHOT_RULES = QualityRules(
    required=("CustomerID", "MarketSegment", "Region", "InCredit", "Tenure"),
    value_sets={
        "InCredit": ("Yes", "No"),
        "Region": ("AFRICA", "AMERICA", "ASIA", "EUROPE"),
        "MarketSegment": SEGMENTS,
        "Churn": (0, 1),
    },
    ranges={
        "Tenure": (0, 60, 0.5),
        "DaySinceLastOrder": (0, 365, 0.99),
        "CashbackAmount": (0, None, None),
        "OrderCount": (None, 25, 0.99),
    },
    not_null=("CustomerID", "DaySinceLastUrgent"),
)
COARSE = ("CustomerID", "Churn", "MarketSegment", "Region", "InCredit", "OrderCount")


def snapshot(spark: SparkSession, folder: str) -> DataFrame:
    return customer_snapshot(spark, folder)


def stored_snapshot(spark: SparkSession, folder: str) -> DataFrame:
    """The snapshot as a stored table, for operators that read it more than once."""
    return stage_table(snapshot(spark, folder), "snapshot")


def coarse(spark: SparkSession, folder: str) -> DataFrame:
    """The columns in which customers repeat each other."""
    return snapshot(spark, folder).select(*COARSE)


def scores(spark: SparkSession, folder: str) -> DataFrame:
    return scored_snapshot(spark, folder)


def stored_scores(spark: SparkSession, folder: str) -> DataFrame:
    """The scores as a stored table, which is what an assignment starts from."""
    return stage_table(scores(spark, folder), "scores")


def document_scores(spark: SparkSession, folder: str) -> DataFrame:
    """(lang, label, probability) from the labelled documents."""
    size = F.col("n_chars").cast("double")
    return table(spark, folder, "labels").join(
        table(spark, folder, "documents").select("doc_id", "lang", "n_chars"), "doc_id"
    ).select(
        "lang", F.col("quality").alias("label"), (size / (size + F.lit(1500.0)))
        .alias("probability"),
    )


def labelled(df: DataFrame) -> DataFrame:
    """The scored snapshot with the metric operators' column names."""
    return df.select(F.col("Churn").alias("label"), F.col("churn_probability")
                     .alias("probability"))


def rounded(df: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(F.col(c), places) for c in columns})


FACTS_SQL = """
facts AS (
  SELECT o_custkey,
    min(CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN CAST(o_orderdate AS DATE) END) AS d1,
    max(CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN CAST(o_orderdate AS DATE) END) AS d2,
    max(CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' AND o_orderpriority = '1-URGENT'
        THEN CAST(o_orderdate AS DATE) END) AS d3,
    count(CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 1 END) AS n_orders,
    count(CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 1 END) AS n_later
  FROM orders WHERE o_orderdate < TIMESTAMP '2000-12-31' GROUP BY o_custkey
)"""

SNAPSHOT_SQL = FACTS_SQL + """,
per_type AS (
  SELECT o_custkey, p_type, count(*) AS n,
    sum(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_discount AS DECIMAL(4,2))) AS cashback
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
  WHERE o_orderdate < TIMESTAMP '2000-01-01' GROUP BY o_custkey, p_type
),
favourite AS (
  SELECT o_custkey, p_type FROM (
    SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY n DESC, p_type) AS r
    FROM per_type) WHERE r = 1
),
cash AS (SELECT o_custkey, CAST(sum(cashback) AS DOUBLE) AS c FROM per_type GROUP BY o_custkey),
snap AS (
  SELECT c_custkey AS CustomerID,
    CAST(CASE WHEN coalesce(n_later, 0) > 0 THEN 0 ELSE 1 END AS INTEGER) AS Churn,
    c_mktsegment AS MarketSegment, r_name AS Region,
    CASE WHEN c_acctbal >= 0 THEN 'Yes' ELSE 'No' END AS InCredit,
    favourite.p_type AS PreferedOrderCat,
    CAST(date_diff('day', d1, DATE '2000-01-01') AS DOUBLE) / 30.0::DOUBLE AS Tenure,
    CAST(date_diff('day', d2, DATE '2000-01-01') AS DOUBLE) AS DaySinceLastOrder,
    CAST(date_diff('day', d3, DATE '2000-01-01') AS DOUBLE) AS DaySinceLastUrgent,
    nullif(n_orders, 0) AS OrderCount, cash.c AS CashbackAmount
  FROM customer
  LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
  LEFT JOIN facts ON c_custkey = facts.o_custkey
  LEFT JOIN favourite ON c_custkey = favourite.o_custkey
  LEFT JOIN cash ON c_custkey = cash.o_custkey
)"""

SCORES_SQL = FACTS_SQL + """,
scores AS (
  SELECT c_custkey AS CustomerID,
    coalesce(CAST(date_diff('day', d2, DATE '2000-01-01') AS DOUBLE)
      / (CAST(date_diff('day', d2, DATE '2000-01-01') AS DOUBLE) + 365.0::DOUBLE), 0.5::DOUBLE)
      AS churn_probability,
    CAST(CASE WHEN coalesce(n_later, 0) > 0 THEN 0 ELSE 1 END AS INTEGER) AS Churn
  FROM customer LEFT JOIN facts ON c_custkey = o_custkey
),
lp AS (SELECT Churn AS label, churn_probability AS probability FROM scores)"""

DOCUMENTS_SQL = """
docs AS (
  SELECT lang, quality AS label,
    CAST(n_chars AS DOUBLE) / (CAST(n_chars AS DOUBLE) + 1500.0::DOUBLE) AS probability
  FROM labels JOIN documents USING (doc_id)
)"""


def with_snapshot(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([SNAPSHOT_SQL.strip(), *ctes]) + "\n" + select


def with_scores(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([SCORES_SQL.strip(), *ctes]) + "\n" + select


def with_documents(select: str, *ctes: str) -> str:
    return "WITH " + ",\n".join([DOCUMENTS_SQL.strip(), *ctes]) + "\n" + select


def quoted(values) -> str:
    return ", ".join("'" + v.replace("'", "''") + "'" for v in values)
