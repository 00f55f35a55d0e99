"""Categorical encoding with a fitted schema: fit once, then a plain projection."""

from __future__ import annotations

import json
import warnings
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.operators.cleaning import ROW_KEY, bool_columns, text_columns
from holdfast.session import stage_table


@dataclass(frozen=True)
class FeatureSchema:
    target: str
    binary: Mapping[str, Mapping[str, int]]
    multi: Mapping[str, tuple[str, ...]]
    feature_columns: tuple[str, ...]
    dropped: tuple[str, ...] = ()

    @property
    def flag_columns(self) -> list[str]:
        """The features that are 0 or 1 on every row: binary columns and dummies."""
        dummies = {dummy_name(c, v) for c, vs in self.multi.items() for v in vs[1:]}
        return [c for c in self.feature_columns if c in dummies or c in self.binary]

    def to_json(self) -> str:
        return json.dumps({
            "target": self.target,
            "binary": {c: dict(m) for c, m in self.binary.items()},
            "multi": {c: list(v) for c, v in self.multi.items()},
            "feature_columns": list(self.feature_columns),
            "dropped": list(self.dropped),
        })

    @classmethod
    def from_json(cls, text: str) -> FeatureSchema:
        data = json.loads(text)
        return cls(
            target=data["target"],
            binary=data["binary"],
            multi={c: tuple(v) for c, v in data["multi"].items()},
            feature_columns=tuple(data["feature_columns"]),
            dropped=tuple(data["dropped"]),
        )


def distinct_values(
    df: DataFrame, columns: Sequence[str], limit: int | None = None
) -> dict[str, list[str]]:
    """Sorted distinct non-null values of each column.

    A grouped aggregate over (column, value) pairs, combined on the map side. The values become
    features, so they come to the driver. Where a free-text column should end in an error that names it, give a
    ``limit``: the exact numbers of values are held against it first.
    """
    if not columns:
        return {}
    pairs = F.array(*[
        F.struct(F.lit(i).alias("i"), F.col(c).cast("string").alias("v")) for i, c in enumerate(columns)
    ])
    values = df.select(F.explode(pairs).alias("p")).select("p.*").filter("v IS NOT NULL").distinct()
    if limit is not None:
        values = stage_table(values, "categories")
        sizes = {r["i"]: r["count"] for r in values.groupBy("i").count().collect()}  # a row a column
        too_wide = [c for i, c in enumerate(columns) if sizes.get(i, 0) > limit]
        if too_wide:
            raise ValueError(f"columns {too_wide} have more than {limit} distinct values")
    found: dict[str, list[str]] = {c: [] for c in columns}
    for r in values.collect():
        found[columns[r["i"]]].append(r["v"])
    return {c: sorted(v) for c, v in found.items()}


def fit_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column_name, value, code, size): codes of any number of categories, stored; nothing comes to the driver.

    ``code`` is a value's place among the sorted distinct non-null values of its column, from 0, and ``size`` their
    number. The values are sorted by ranges; a range's first place is the running sum of those before.
    """
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns])
    values = df.select(F.explode(pairs).alias("p")).select("p.*").filter("value IS NOT NULL").distinct()
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["column_name", "value"]
    placed = stage_table(
        stage_table(values, "categories").repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()), "places",
    )
    part = F.shiftright("place", 33)
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = placed.groupBy(part.alias("part")).count().select(  # a row a range
        "part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    numbered = placed.join(F.broadcast(bases), part == F.col("part")).select(
        *order, (F.col("base") + F.col("place").bitwiseAND((1 << 33) - 1)).alias("place"))
    sizes = numbered.groupBy("column_name").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("size"))
    return stage_table(
        numbered.join(F.broadcast(sizes), "column_name").select(  # a row a column
            *order, (F.col("place") - F.col("first")).alias("code"), "size"), "dictionary",
    )


def with_codes(df: DataFrame, categories: DataFrame, columns: Sequence[str], suffix: str = "_code") -> DataFrame:
    """``df`` with the code of every one of ``columns``, by a join on the value; null where it is null or was not seen."""
    for c in columns:
        known = categories.filter(F.col("column_name") == c).select(
            F.col("value").alias("__value"), F.col("code").alias(f"{c}{suffix}"))
        df = df.join(known, F.col(c).cast("string") == F.col("__value"), "left").drop("__value")
    return df


def one_hot_vectors(df: DataFrame, categories: DataFrame, columns: Sequence[str], suffix: str = "_vector") -> DataFrame:
    """``df`` with a sparse vector for every one of ``columns``: a 1 at the place of the category, the first one left out.

    Vectors are as long as their column has categories, less one; null and unseen values, and the first
    category, are all zeros. Whatever the number of categories, a row holds one number a column.
    """
    sizes = {r["column_name"]: r["size"] for r in categories.select("column_name", "size").distinct().collect()}
    wide = [c for c in columns if sizes.get(c, 0) > 1]
    coded = with_codes(df, categories, wide, "__code")
    names = [f"{c}__index" for c in wide]
    for c, name in zip(wide, names):  # the last index is the one that the encoder leaves out
        code = F.coalesce(F.col(f"{c}__code"), F.lit(0))
        coded = coded.withColumn(name, F.pmod(code - 1, F.lit(sizes[c])).cast("double")).drop(f"{c}__code")
    if not wide:
        return coded
    ends = df.sparkSession.createDataFrame([tuple(float(sizes[c] - 1) for c in wide)], [*names])
    encoder = OneHotEncoder(inputCols=names, outputCols=[f"{c}{suffix}" for c in wide], dropLast=True)
    return encoder.fit(ends).transform(coded).drop(*names)


def binary_mapping(values: Sequence[str]) -> dict[str, int] | None:
    """0/1 codes for two values in sorted order: No before Yes, Female before Male."""
    ordered = sorted(values)
    return {ordered[0]: 0, ordered[1]: 1} if len(ordered) == 2 else None


def dummy_name(column: str, category: str) -> str:
    return f"{column}_{category}"


def fit_feature_schema(
    df: DataFrame, target: str = "Churn", *, limit: int | None = None
) -> FeatureSchema:
    """Two values make a binary column, more make dummies; a constant text column is left out.

    Feature order: the untouched and binary columns in table order, then the dummies.
    """
    text = [c for c in text_columns(df) if c not in (target, ROW_KEY)]
    values = distinct_values(df, text, limit)
    binary = {c: binary_mapping(v) for c, v in values.items() if len(v) == 2}
    multi = {c: tuple(v) for c, v in values.items() if len(v) > 2}
    dropped = tuple(c for c, v in values.items() if len(v) < 2)
    plain = [
        c for c in df.columns if c not in (target, ROW_KEY) and c not in multi and c not in dropped
    ]
    dummies = [dummy_name(c, v) for c, vs in multi.items() for v in vs[1:]]
    return FeatureSchema(target, binary, multi, tuple(plain + dummies), dropped)


def encode_binary(column: str, mapping: Mapping[str, int]) -> Column:
    """The fitted code; null and unseen values are 0."""
    ones = [value for value, code in mapping.items() if code == 1]
    text = F.col(column).cast("string")
    return F.when(text.isin(ones), 1).otherwise(0)


def encode_dummy(column: str, category: str) -> Column:
    matched = F.col(column).cast("string") == F.lit(category)
    return F.coalesce(matched, F.lit(False)).cast("int")


def apply_feature_schema(
    df: DataFrame, schema: FeatureSchema, keep: Sequence[str] = ()
) -> DataFrame:
    """The fitted columns in the fitted order: one projection, no job.

    A fitted column the batch lacks is 0, a column the fit did not know is left out. The target and
    the row key go first where the batch has them, then the side columns to ``keep``.
    """
    bools = set(bool_columns(df))
    dummies = {
        dummy_name(c, v): encode_dummy(c, v) if c in df.columns else F.lit(0)
        for c, vs in schema.multi.items()
        for v in vs[1:]
    }

    def encoded(name: str) -> Column:
        if name in dummies:
            return dummies[name].alias(name)
        if name not in df.columns:
            return F.lit(0).alias(name)
        if name in schema.binary:
            return encode_binary(name, schema.binary[name]).alias(name)
        return F.col(name).cast("int").alias(name) if name in bools else F.col(name)

    leading = [c for c in (ROW_KEY, schema.target, *keep) if c in df.columns]
    return df.select(*leading, *[encoded(c) for c in schema.feature_columns])


def unseen_binary_values(df: DataFrame, schema: FeatureSchema) -> DataFrame:
    """(column_name, value, n) of values a binary column did not have at fit: schema drift.

    Counted by a grouped aggregate, so a column that drifted on every row is combined on the map
    side.
    """
    columns = [c for c in schema.binary if c in df.columns]
    if not columns:
        return df.sparkSession.createDataFrame([], "column_name string, value string, n long")
    pairs = []
    for c in columns:
        value = F.col(c).cast("string")
        unseen = F.when(~value.isin(list(schema.binary[c])), value)
        pairs.append(F.struct(F.lit(c).alias("column_name"), unseen.alias("value")))
    return (
        df.select(F.explode(F.array(*pairs)).alias("p"))
        .select("p.*")
        .filter(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def warn_about_drift(df: DataFrame, schema: FeatureSchema, examples: int = 5) -> int:
    """Warn once per binary column with unseen values; returns how many columns drifted."""
    drift = (
        unseen_binary_values(df, schema)
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("n_values"), F.min("value").alias("example"),
             F.sum("n").alias("n_rows"))
        .collect()
    )
    for row in drift:
        warnings.warn(
            f"column '{row['column_name']}' has {row['n_values']} values on {row['n_rows']} rows "
            f"that were unknown when the schema was fit (such as {row['example']!r}); they are "
            "encoded as 0",
            stacklevel=2,
        )
    return len(drift)
