"""One row per customer, derived from the order tables as of a date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = dt.date(2000, 1, 1)
HORIZON_DAYS = 365

NUMERIC_FEATURES = (
    "Tenure", "DaySinceLastOrder", "DaySinceLastUrgent", "OrderCount", "CashbackAmount",
)
TEXT_FEATURES = ("MarketSegment", "Region", "InCredit", "PreferedOrderCat")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _hundredths(column: str) -> Column:
    return F.rint(F.col(column) * F.lit(100.0)).cast("long")


def _orders_until(spark: SparkSession, folder: str, as_of: dt.date, horizon_days: int) -> DataFrame:
    return (
        table(spark, folder, "orders")
        .select("o_orderkey", "o_custkey", "o_orderpriority",
                F.to_date("o_orderdate").alias("day"), "o_orderdate")
        .filter(F.col("o_orderdate") < F.lit(as_of + dt.timedelta(days=horizon_days)))
    )


def _order_facts(orders: DataFrame, earlier: Column) -> DataFrame:
    urgent = earlier & (F.col("o_orderpriority") == "1-URGENT")
    return orders.groupBy("o_custkey").agg(
        F.min(F.when(earlier, F.col("day"))).alias("first_day"),
        F.max(F.when(earlier, F.col("day"))).alias("last_day"),
        F.max(F.when(urgent, F.col("day"))).alias("last_urgent_day"),
        F.count(F.when(earlier, 1)).alias("n_orders"),
        F.max(F.when(earlier, 0).otherwise(1)).alias("active"),
    )


def customer_snapshot(
    spark: SparkSession, folder: str, as_of: dt.date = AS_OF, horizon_days: int = HORIZON_DAYS
) -> DataFrame:
    """Features from orders before ``as_of``; Churn = no order in the ``horizon_days`` after it.

    Orders and lines are reduced per customer before they meet the customer table, so a customer
    with very many orders is combined on the map side. Money is summed in whole units, so the result
    is the same for every partitioning.
    """
    start = F.lit(as_of)
    earlier = F.col("o_orderdate") < start
    orders = _orders_until(spark, folder, as_of, horizon_days)
    cashback = _hundredths("l_extendedprice") * _hundredths("l_discount")
    per_type = (
        table(spark, folder, "lineitem")
        .select("l_orderkey", "l_partkey", cashback.alias("cashback"))
        .join(orders.filter(earlier).select("o_orderkey", "o_custkey"),
              F.col("l_orderkey") == F.col("o_orderkey"))
        .join(table(spark, folder, "part").select("p_partkey", "p_type"),
              F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("o_custkey", "p_type")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("cashback").alias("cashback"))
    )
    per_line_customer = per_type.groupBy(F.col("o_custkey").alias("line_custkey")).agg(
        F.min_by("p_type", F.struct(-F.col("n"), F.col("p_type"))).alias("PreferedOrderCat"),
        (F.sum("cashback") / F.lit(10000.0)).alias("CashbackAmount"),
    )

    def days_since(day: str) -> Column:
        return F.datediff(start, F.col(day)).cast("double")

    places = (
        table(spark, folder, "nation")
        .join(table(spark, folder, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("n_nationkey", F.col("r_name").alias("Region"))
    )
    return (
        table(spark, folder, "customer")
        .select("c_custkey", "c_nationkey", "c_acctbal", "c_mktsegment")
        .join(_order_facts(orders, earlier), F.col("c_custkey") == F.col("o_custkey"), "left")
        .join(per_line_customer, F.col("c_custkey") == F.col("line_custkey"), "left")
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("CustomerID"),
            (F.lit(1) - F.coalesce(F.col("active"), F.lit(0))).alias("Churn"),
            F.col("c_mktsegment").alias("MarketSegment"),
            "Region",
            F.when(F.col("c_acctbal") >= 0, "Yes").otherwise("No").alias("InCredit"),
            "PreferedOrderCat",
            (days_since("first_day") / F.lit(30.0)).alias("Tenure"),
            days_since("last_day").alias("DaySinceLastOrder"),
            days_since("last_urgent_day").alias("DaySinceLastUrgent"),
            F.when(F.col("n_orders") > 0, F.col("n_orders")).alias("OrderCount"),
            "CashbackAmount",
        )
    )


def recency_score() -> Column:
    """A risk score that needs no model: d / (d + 365), 0.5 where no order is known."""
    days = F.col("DaySinceLastOrder")
    return F.coalesce(days / (days + F.lit(365.0)), F.lit(0.5))


def scored_snapshot(
    spark: SparkSession, folder: str, as_of: dt.date = AS_OF, horizon_days: int = HORIZON_DAYS
) -> DataFrame:
    """(CustomerID, churn_probability, Churn) with the recency score, from the orders alone."""
    earlier = F.col("o_orderdate") < F.lit(as_of)
    facts = _order_facts(_orders_until(spark, folder, as_of, horizon_days), earlier)
    return (
        table(spark, folder, "customer")
        .select("c_custkey")
        .join(facts, F.col("c_custkey") == F.col("o_custkey"), "left")
        .withColumn("DaySinceLastOrder", F.datediff(F.lit(as_of), "last_day").cast("double"))
        .select(
            F.col("c_custkey").alias("CustomerID"),
            recency_score().alias("churn_probability"),
            (F.lit(1) - F.coalesce(F.col("active"), F.lit(0))).alias("Churn"),
        )
    )
