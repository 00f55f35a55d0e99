"""Cleaning of raw customer tables, and median imputation."""

from __future__ import annotations

import warnings
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.operators.percentiles import exact_percentiles

ROW_KEY = "row_key"

# The spellings of the id column, and category labels that mean the same.
ID_COLUMNS = ("CustomerID", "customerID", "customer_id")
CATEGORY_ALIASES: Mapping[str, Mapping[str, str]] = {
    "PreferredLoginDevice": {"Phone": "Mobile Phone"},
    "PreferredPaymentMode": {"COD": "Cash on Delivery", "CC": "Credit Card"},
    "PreferedOrderCat": {"Mobile": "Mobile Phone"},
}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def bool_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def find_id_column(df: DataFrame, names: Sequence[str] = ID_COLUMNS) -> str | None:
    return next((c for c in names if c in df.columns), None)


def set_ids_aside(df: DataFrame, names: Sequence[str] = ID_COLUMNS) -> DataFrame:
    """Drop the id columns, keeping the first one found as ``row_key``, which is never a feature."""
    found = find_id_column(df, names)
    kept = df.withColumn(ROW_KEY, F.col(found)) if found else df
    return kept.drop(*[c for c in names if c in df.columns])


def binary_target(column: Column) -> Column:
    """Yes/No as 1/0 after trimming; any other text is null."""
    trimmed = F.trim(column)
    return F.when(trimmed == "Yes", 1).when(trimmed == "No", 0)


def map_target(df: DataFrame, target: str) -> DataFrame:
    if target in df.columns and target in text_columns(df):
        return df.withColumn(target, binary_target(F.col(target)))
    return df


def collapse_aliases(
    df: DataFrame, aliases: Mapping[str, Mapping[str, str]] = CATEGORY_ALIASES
) -> DataFrame:
    text = set(text_columns(df))
    for column, pairs in aliases.items():
        if column in text:
            df = df.replace(dict(pairs), subset=[column])
    return df


def fit_missing_columns(df: DataFrame, target: str) -> list[str]:
    """Numeric columns, apart from the target and the row key, that hold a null: one pass."""
    candidates = [c for c in numeric_columns(df) if c not in (target, ROW_KEY)]
    if not candidates:
        return []
    row = df.agg(*[
        F.max(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(candidates)
    ]).first()
    return [c for i, c in enumerate(candidates) if row[f"m{i}"]]


def add_missing_indicators(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({f"{c}_missing": F.col(c).isNull().cast("int") for c in columns})


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    """One row per distinct content; the smallest row key of the copies survives.

    A grouped minimum: copies meet on the map side first, so a row repeated a billion times
    crosses the network once per task. Without a row key, the md5 of the content becomes one.
    """
    features = [c for c in df.columns if c != ROW_KEY]
    if ROW_KEY in df.columns:
        return df.groupBy(*features).agg(F.min(ROW_KEY).alias(ROW_KEY))
    return df.dropDuplicates().withColumn(ROW_KEY, content_hash(df, features))


def content_hash(df: DataFrame, columns: Sequence[str]) -> Column:
    """md5 of the columns as text. Nulls get a token, and separators inside texts are escaped."""
    text = set(text_columns(df))
    parts = []
    for c in columns:
        value = F.col(c).cast("string")
        if c in text:
            value = F.replace(F.replace(value, F.lit("\\"), F.lit("\\\\")), F.lit("|"), F.lit("\\|"))
        parts.append(F.coalesce(value, F.lit("\\N")))
    return F.md5(F.concat_ws("|", *parts))


def duplicate_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows before and after dropping copies over ``columns``, dropped, and their share."""
    groups = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("n"))
    counts = groups.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_before"), F.count(F.lit(1)).alias("n_after")
    )
    dropped = F.col("n_before") - F.col("n_after")
    return counts.select(
        "n_before", "n_after", dropped.alias("n_dropped"),
        F.try_divide(dropped.cast("double"), F.col("n_before").cast("double"))
        .alias("dropped_share"),
    )


def clean(
    df: DataFrame,
    target: str = "Churn",
    drop_duplicates: bool = True,
    *,
    aliases: Mapping[str, Mapping[str, str]] = CATEGORY_ALIASES,
    missing_columns: Sequence[str] | None = None,
) -> DataFrame:
    """The whole cleaning step.

    The order matters: ids leave first and labels are merged before copies are sought, and the
    missing indicators exist before either split or imputation. ``missing_columns`` freezes the set
    of indicators, which makes the step a projection without a job; otherwise one pass fits it.
    Scoring passes ``drop_duplicates=False`` so that no customer is lost.
    """
    work = collapse_aliases(map_target(set_ids_aside(trim_headers(df)), target), aliases)
    if missing_columns is None:
        missing_columns = fit_missing_columns(work, target)
    work = add_missing_indicators(work, [c for c in missing_columns if c in work.columns])
    return drop_duplicate_rows(work) if drop_duplicates else work


def fit_medians(
    df: DataFrame, columns: Sequence[str] | None = None, *, flags: Sequence[str] = (),
    approximate: bool = False,
) -> dict[str, float | None]:
    """Interpolated medians; None for a column without a value.

    ``flags`` names the columns known to hold only 0 and 1, most of an encoded matrix. Their median
    follows from a sum, so they need neither sketches nor value counts.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    flagged = [c for c in columns if c in set(flags)]
    found = exact_percentiles(
        df, [c for c in columns if c not in set(flags)], [0.5], approximate=approximate
    )
    medians = {c: values[0] for c, values in found.items()}
    if flagged:
        row = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"a{i}")
                       for i, c in enumerate(flagged)]).first()
        for i, c in enumerate(flagged):
            share = row[f"a{i}"]
            medians[c] = None if share is None else 0.5 * ((share >= 0.5) + (share > 0.5))
    return {c: medians[c] for c in columns}


def apply_medians(df: DataFrame, medians: Mapping[str, float | None]) -> DataFrame:
    """Fill nulls with the fitted medians, and with 0 where no median exists; doubles result."""
    present = [c for c in df.columns if c in medians]
    undefined = [c for c in present if medians[c] is None]
    if undefined:
        warnings.warn(
            f"columns {undefined} had no value to take a median of; their gaps become 0",
            stacklevel=2,
        )
    return df.withColumns({
        c: F.coalesce(F.col(c).cast("double"), F.lit(float(medians[c] or 0.0))) for c in present
    })


def impute_numeric(
    df: DataFrame,
    medians: Mapping[str, float | None] | None = None,
    *,
    skip: Sequence[str] = (ROW_KEY,),
) -> tuple[DataFrame, dict[str, float | None]]:
    """Median imputation; pass the training medians to apply them to later rows.

    A numeric column that the given medians do not know is filled with 0.
    """
    columns = [c for c in numeric_columns(df) if c not in skip]
    fitted = fit_medians(df, columns) if medians is None else dict(medians)
    return apply_medians(df, {c: fitted.get(c) for c in columns}), fitted


def bools_to_ints(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("int") for c in bool_columns(df)})
