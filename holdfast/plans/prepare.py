"""Preparation of a table, with and without a split."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.cleaning import (
    CATEGORY_ALIASES, ROW_KEY, apply_medians, clean, fit_medians, impute_numeric,
)
from holdfast.operators.encoding import FeatureSchema, apply_feature_schema, fit_feature_schema
from holdfast.operators.quality import require_binary_target, require_target
from holdfast.operators.splitting import three_way_split
from holdfast.session import stage_table
from holdfast.sources.customers import load_customers
from holdfast.sources.sinks import write_cleaned

SPLIT = "split"


@dataclass(frozen=True)
class PreparedTable:
    cleaned: DataFrame
    features: DataFrame
    schema: FeatureSchema


def prepare_table(raw: DataFrame, target: str = "Churn", *,
                  aliases: Mapping[str, Mapping[str, str]] = CATEGORY_ALIASES) -> PreparedTable:
    """Clean, impute and encode one unsplit table.

    The target is checked before anything is filled, and never filled itself. Medians come from the
    whole table, which only suits a table that is not split afterwards.
    """
    cleaned = stage_table(clean(raw, target, aliases=aliases), "cleaned")
    require_binary_target(cleaned, target)
    imputed, _ = impute_numeric(cleaned, skip=(ROW_KEY, target))
    schema = fit_feature_schema(imputed, target)
    return PreparedTable(imputed, apply_feature_schema(imputed, schema), schema)


def prepare_files(spark: SparkSession, raw_path: str, cleaned_path: str, features_path: str,
                  target: str = "Churn") -> PreparedTable:
    """Load, prepare, and store the cleaned table and the feature matrix separately."""
    prepared = prepare_table(load_customers(spark, raw_path), target)
    write_cleaned(prepared.cleaned, cleaned_path)
    write_cleaned(prepared.features, features_path)
    return prepared


@dataclass(frozen=True)
class PreparedSplits:
    """One encoded, imputed table with a ``split`` column, and the state that was fitted."""

    frame: DataFrame
    target: str
    schema: FeatureSchema
    medians: Mapping[str, float | None]

    @property
    def feature_columns(self) -> list[str]:
        return list(self.schema.feature_columns)

    def part(self, *names: str) -> DataFrame:
        return self.frame.filter(F.col(SPLIT).isin(list(names)))

    @property
    def trainval(self) -> DataFrame:
        return self.part("train", "val")


def fit_splits(marked: DataFrame, target: str) -> PreparedSplits:
    """Fit on a cleaned table that already has its ``split`` column.

    The categories come from train and validation, the medians from train alone; test rows shape
    nothing.
    """
    known = marked.filter(F.col(SPLIT) != "test").drop(SPLIT)
    schema = fit_feature_schema(known, target)
    encoded = apply_feature_schema(marked, schema, keep=(SPLIT,))
    medians = fit_medians(
        encoded.filter(F.col(SPLIT) == "train"), list(schema.feature_columns),
        flags=schema.flag_columns,
    )
    return PreparedSplits(apply_medians(encoded, medians), target, schema, medians)


def prepare_model_splits(
    cleaned: DataFrame, target: str = "Churn", test_size: float = 0.2, val_size: float = 0.2,
    random_state: int = 42,
) -> PreparedSplits:
    """Split first, then fit. ``cleaned`` carries a unique ``row_key`` and should be stored."""
    require_target(cleaned, target)
    marked = three_way_split(
        cleaned, ROW_KEY, target, test_size, val_size, random_state, name=SPLIT
    )
    return fit_splits(marked, target)
