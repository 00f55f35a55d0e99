"""The record of a run: numbers and texts in one long table, stored with its bundle and found by its id."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.operators.metrics import classification_report
from holdfast.sources.bundles import RECORD_SCHEMA, runs_table
from holdfast.sources.fingerprints import table_fingerprint


def typed_rows(df: DataFrame, section: str, item: str | None = None) -> DataFrame:
    """(section, item, metric, number, text): numbers and flags as numbers, all other columns as text.

    ``item`` names the column that tells the rows of a section apart.
    """
    entries = []
    for f in df.schema.fields:
        if f.name == item:
            continue
        c = F.col(f"`{f.name}`")
        as_number = isinstance(f.dataType, (T.NumericType, T.BooleanType))
        entries.append(F.struct(
            F.lit(f.name).alias("metric"),
            (c.cast("double") if as_number else F.lit(None).cast("double")).alias("number"),
            (F.lit(None).cast("string") if as_number else c.cast("string")).alias("text"),
        ))
    label = F.col(f"`{item}`").cast("string") if item else F.lit("")
    return df.select(F.lit(section).alias("section"), label.alias("item"), F.explode(F.array(*entries)).alias("m")).select(
        "section", "item", "m.*")


def fact_rows(spark: SparkSession, section: str, facts: Mapping[str, object]) -> DataFrame:
    """Facts of the driver as rows: numbers and flags as numbers, None as neither, all else as text."""
    rows = []
    for name, value in facts.items():
        number = float(value) if isinstance(value, (int, float)) else None
        text = None if value is None or number is not None else str(value)
        rows.append((section, "", name, number, text))
    return spark.createDataFrame(rows, "section string, item string, metric string, number double, text string")


def run_record(
    run_id: str, results: DataFrame, *, facts: Mapping[str, object], raw: DataFrame | None = None,
    test_scores: DataFrame | None = None, threshold: float | None = None, comparison: DataFrame | None = None,
    importance: DataFrame | None = None, label: str = "label", score: str = "probability",
) -> DataFrame:
    """Everything that is known of a run as (run_id, section, item, metric, number, text).

    ``results`` is the numeric results table. ``raw`` adds the digest of the table the run read,
    ``test_scores`` with ``threshold`` the class report, ``comparison`` and ``importance`` every model and
    every feature, not the strongest alone. An empty mapping or table adds no row.
    """
    numbers = results.select("section", "item", "metric", F.col("value").alias("number"), F.lit(None).cast("string").alias("text"))
    if comparison is not None:
        numbers = numbers.filter("section <> 'comparison'")  # below it is there with its texts
    parts = [numbers, fact_rows(results.sparkSession, "run", facts)]
    if raw is not None:
        parts.append(typed_rows(table_fingerprint(raw), "input"))
    if test_scores is not None and threshold is not None:
        parts.append(typed_rows(classification_report(test_scores, threshold, label, score), "class_report", "row"))
    if comparison is not None:
        parts.append(typed_rows(comparison, "comparison", "model"))
    if importance is not None:
        parts.append(typed_rows(importance, "importance", "feature"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.withColumn("run_id", F.lit(run_id)).select("run_id", "section", "item", "metric", "number", "text")


def read_records(spark: SparkSession, root: str, run_id: str | None = None) -> DataFrame:
    """The records of all finished runs below ``root``, or of one. A record without its run in the table of
    runs was never committed and is not seen."""
    runs = runs_table(spark, root).filter("status = 'FINISHED'")
    if run_id is not None:
        runs = runs.filter(F.col("run_id") == run_id)
    found = [r["run_id"] for r in runs.filter("has_record").select("run_id").distinct().collect()]  # a row a run
    if not found:
        return spark.createDataFrame([], RECORD_SCHEMA)
    return spark.read.schema(RECORD_SCHEMA).parquet(*[f"{root.rstrip('/')}/{r}/record" for r in found])
