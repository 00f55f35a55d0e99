"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from holdfast.catalog.inputs import scores, snapshot
from holdfast.operators import assignment, metrics
from holdfast.operators.cleaning import clean
from holdfast.operators.encoding import apply_feature_schema, fit_feature_schema
from holdfast.operators.splitting import three_way_split
from holdfast.session import stage_table
from holdfast.sources.snapshot import customer_snapshot


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, small):
    return stage_table(scores(spark, small), "scores")


def test_splits_do_not_move_rows(stored):
    text = plan(three_way_split(stored, "CustomerID", "Churn", 0.2, 0.2, 42))
    assert "Exchange" not in text and "Sort" not in text


def test_cleaning_and_encoding_are_projections(spark, small):
    df = stage_table(snapshot(spark, small), "raw")
    schema = fit_feature_schema(df.drop("CustomerID"))
    cleaned = clean(df, drop_duplicates=False, missing_columns=["Tenure"])
    text = plan(apply_feature_schema(cleaned, schema))
    assert "Exchange" not in text and "Python" not in text


def test_scan_reads_what_is_needed(spark, small):
    text = plan(customer_snapshot(spark, small).select("CustomerID", "DaySinceLastOrder", "Churn"))
    orders = [s for s in re.findall(r"ReadSchema: struct<([^>]*)>", text) if "o_custkey" in s]
    assert orders and all("o_totalprice" not in s and "o_orderstatus" not in s for s in orders)
    assert "LessThan(o_orderdate" in text


def _single_partition_windows(text: str) -> list[str]:
    """Windows right above an exchange to one partition whose input is not an aggregate."""
    out, lines = [], text.splitlines()
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = " ".join(lines[i + 1:i + 5])
            if "Aggregate" not in below:
                out.append(line)
    return out


@pytest.mark.parametrize("build", [
    lambda df: assignment.risk_ranks(df),
    lambda df: metrics.ranking_metrics(
        df.select(F.col("Churn").alias("label"), F.col("churn_probability").alias("probability"))),
    lambda df: metrics.threshold_curve(
        df.select(F.col("Churn").alias("label"), F.col("churn_probability").alias("probability"))),
])
def test_only_aggregates_reach_one_partition(stored, build):
    text = plan(build(stored))
    assert not _single_partition_windows(text)
    assert "CartesianProduct" not in text and "PythonUDF" not in text


def test_threshold_curve_is_bounded(spark):
    df = spark.range(50_000).select(
        (F.col("id") % 2).cast("int").alias("label"),
        (F.col("id") / 50_000).alias("probability"))
    assert metrics.threshold_curve(df).count() <= 10_001
