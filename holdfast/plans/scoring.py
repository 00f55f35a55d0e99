"""Scoring of raw customer batches with a stored run."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.cleaning import (
    CATEGORY_ALIASES, ROW_KEY, apply_medians, clean, find_id_column, numeric_columns,
    trim_headers,
)
from holdfast.operators.encoding import FeatureSchema, apply_feature_schema, warn_about_drift
from holdfast.operators.models import ScoringModel
from holdfast.sources.bundles import load_bundle
from holdfast.sources.customers import load_customers
from holdfast.sources.sinks import ranked_scores, write_ranked

PROBABILITY, DECISION = "churn_probability", "churn_prediction"


def decide(probability, threshold: float):
    return (probability >= F.lit(float(threshold))).cast("int")


def fitted_indicators(schema: FeatureSchema) -> list[str]:
    """The columns whose missing indicator is a feature of the fitted schema."""
    ending = "_missing"
    return [c[: -len(ending)] for c in schema.feature_columns if c.endswith(ending)]


def feature_rows(batch: DataFrame, schema: FeatureSchema, medians: Mapping[str, float | None],
                 aliases: Mapping[str, Mapping[str, str]] = CATEGORY_ALIASES) -> DataFrame:
    """The batch as the model wants it: same cleaning without dedup, fitted columns, training
    medians. A projection: it needs no job and keeps every row."""
    cleaned = clean(
        batch, schema.target, drop_duplicates=False, aliases=aliases,
        missing_columns=fitted_indicators(schema),
    )
    cleaned = cleaned.drop(schema.target)
    encoded = apply_feature_schema(cleaned, schema)
    wanted = [c for c in numeric_columns(encoded) if c != ROW_KEY]
    return apply_medians(encoded, {c: medians.get(c) for c in wanted})


def score_batch(
    batch: DataFrame,
    model: ScoringModel,
    schema: FeatureSchema,
    medians: Mapping[str, float | None],
    threshold: float,
    id_column: str | None = None,
    *,
    aliases: Mapping[str, Mapping[str, str]] = CATEGORY_ALIASES,
    check_drift: bool = True,
    ranked: bool = True,
) -> DataFrame:
    """(id, churn_probability, churn_prediction), one row per customer, highest risk first.

    The id column is found by its usual names unless given. ``check_drift`` spends one aggregate to
    warn about values the schema does not know; ``ranked=False`` leaves out the final sort.
    """
    batch = trim_headers(batch)
    id_column = id_column or find_id_column(batch)
    if id_column and id_column in batch.columns and id_column != find_id_column(batch):
        usual = find_id_column(batch)
        batch = (batch.drop(usual) if usual else batch).withColumn(ROW_KEY, F.col(id_column))
    if check_drift:
        warn_about_drift(clean(
            batch, schema.target, drop_duplicates=False, aliases=aliases, missing_columns=[]
        ), schema)
    rows = feature_rows(batch, schema, medians, aliases)
    scored = model.score(rows, PROBABILITY).withColumn(
        DECISION, decide(F.col(PROBABILITY), threshold)
    )
    ids = [F.col(ROW_KEY).alias(id_column)] if ROW_KEY in scored.columns and id_column else []
    out = scored.select(*ids, PROBABILITY, DECISION)
    return ranked_scores(out, PROBABILITY, id_column) if ranked else out


def flagged_count(scored: DataFrame) -> DataFrame:
    """One row: customers scored, and customers to contact."""
    return scored.agg(
        F.count(F.lit(1)).alias("n_scored"),
        F.coalesce(F.sum(DECISION), F.lit(0)).alias("n_flagged"),
    )


def score_files(spark: SparkSession, batch_path: str, output_path: str, bundle_root: str,
                run_id: str | None = None, id_column: str | None = None,
                aliases: Mapping[str, Mapping[str, str]] = CATEGORY_ALIASES) -> DataFrame:
    """Load a bundle, score a stored batch, write the contact list; returns it as written."""
    bundle = load_bundle(spark, bundle_root, run_id)
    batch = load_customers(spark, batch_path)
    scored = score_batch(
        batch, bundle.model, bundle.schema, bundle.medians, bundle.threshold, id_column,
        aliases=aliases, ranked=False,
    )
    write_ranked(scored, output_path, id_column=id_column or find_id_column(batch))
    return load_customers(spark, output_path)
