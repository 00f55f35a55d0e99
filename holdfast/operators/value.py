"""Expected value of contacting a customer."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def expected_value(
    probability: Column, margin: Column, success_rate: float, offer_cost: float
) -> Column:
    return probability * margin * F.lit(float(success_rate)) - F.lit(float(offer_cost))


def rank_by_value(
    scored: DataFrame, margin: Column, success_rate: float, offer_cost: float,
    probability: str = "churn_probability", id_column: str = "CustomerID",
) -> DataFrame:
    value = expected_value(F.col(probability), margin, success_rate, offer_cost)
    return scored.withColumn("expected_value", value).orderBy(
        F.col("expected_value").desc(), id_column
    )
