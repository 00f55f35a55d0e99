"""Scoring of customer files as they arrive.

Encoding and imputation are projections of fitted state, so the batch plan runs on a stream as it
is: no state, no watermark.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from holdfast.operators.cleaning import CATEGORY_ALIASES
from holdfast.plans.scoring import score_batch
from holdfast.sources.bundles import RunBundle
from holdfast.sources.customers import normalize_missing


def score_arrivals(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    bundle: RunBundle,
    output: str,
    checkpoint: str,
    aliases: Mapping[str, Mapping[str, str]] = CATEGORY_ALIASES,
) -> StreamingQuery:
    """Score the Parquet files not scored yet, append the scores to ``output``, and stop."""
    arrivals: DataFrame = normalize_missing(spark.readStream.schema(schema).parquet(folder))
    scored = score_batch(
        arrivals, bundle.model, bundle.schema, bundle.medians, bundle.threshold,
        aliases=aliases, check_drift=False, ranked=False,
    )
    return (
        scored.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
