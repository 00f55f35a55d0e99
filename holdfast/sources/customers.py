"""Reading customer tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Texts that stand for a missing value in CSV exports.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


def normalize_missing(df: DataFrame, tokens: Sequence[str] = NA_TOKENS) -> DataFrame:
    """Null for NaN in floating columns and for the given tokens in text columns."""
    out = {}
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)):
            out[field.name] = F.when(~F.isnan(c), c)
        elif isinstance(field.dataType, T.StringType) and tokens:
            out[field.name] = F.when(~c.isin(list(tokens)), c)
    return df.withColumns(out) if out else df


def _typed(df: DataFrame) -> DataFrame:
    """Numbers where every value is one: one pass over the text columns decides.

    Whole numbers without gaps become longs; with gaps, or with decimals, doubles; True/False
    becomes boolean.
    """
    aggregates: list[Column] = []
    for i, c in enumerate(df.columns):
        text = F.col(c)
        aggregates += [
            F.count(F.when(text.isNull(), 1)).alias(f"null{i}"),
            F.count(text).alias(f"some{i}"),
            F.count(text.try_cast("bigint")).alias(f"whole{i}"),
            F.count(F.when(text.rlike(r"^\s*[+-]?\d+\s*$"), 1)).alias(f"digits{i}"),
            F.count(text.try_cast("double")).alias(f"number{i}"),
            F.count(F.when(text.isin("True", "False"), 1)).alias(f"bool{i}"),
        ]
    row = df.agg(*aggregates).first()
    casts = {}
    for i, c in enumerate(df.columns):
        some = row[f"some{i}"]
        if some and some == row[f"number{i}"]:
            whole = some == row[f"whole{i}"] == row[f"digits{i}"] and not row[f"null{i}"]
            casts[c] = F.col(c).cast("bigint" if whole else "double")
        elif some and some == row[f"bool{i}"] and not row[f"null{i}"]:
            casts[c] = F.col(c).cast("boolean")
        elif not some:
            casts[c] = F.col(c).cast("double")
    return df.withColumns(casts) if casts else df


def load_customers(
    spark: SparkSession, path: str, schema: T.StructType | str | None = None,
    tokens: Sequence[str] = NA_TOKENS, multi_line: bool = False,
) -> DataFrame:
    """A customer table from Parquet, or from CSV if the path ends in .csv.

    Tokens for missing values are a matter of CSV: in Parquet a text such as NA is a value.
    ``multi_line`` reads quoted line breaks, at the price that a file is not split among tasks.
    A schema makes the CSV read lazy; without one, a pass over the file settles the types.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    try:
        if not path.lower().rstrip("/").endswith(".csv"):
            reader = spark.read if schema is None else spark.read.schema(schema)
            return normalize_missing(reader.parquet(path), ())
        raw = spark.read.csv(path, header=True, escape='"', multiLine=multi_line)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no table at {path}") from error
        raise
    raw = normalize_missing(raw, tokens)
    if schema is None:
        return _typed(raw)
    return raw.select(*[
        F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in schema.fields
    ])


def load_with_rescue(
    spark: SparkSession, path: str, schema: T.StructType | str,
    tokens: Sequence[str] = NA_TOKENS, multi_line: bool = False, rescued: str = "rescued",
) -> DataFrame:
    """A CSV table under ``schema`` that loses nothing: what the schema cannot hold stays beside the row.

    ``rescued`` maps the name of a column to its raw text, where that text is no missing-value token and
    does not fit the column's type, or where the schema has no such column. A record with too few or too
    many fields is there whole, under the empty name. It is null for rows that fit. A column of
    the schema that the file lacks is null. The read is lazy but for the header. Files of one table
    must share their header; an error says where one differs.
    """
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    options = {"header": True, "escape": '"', "multiLine": multi_line}
    try:
        names = spark.read.csv(path, **options).columns
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no table at {path}") from error
        raise
    record = "_" * (1 + max(map(len, names))) + "record"  # longer than any name of the file
    texts = T.StructType([T.StructField(c, T.StringType()) for c in (*names, record)])
    raw = spark.read.schema(texts).csv(
        path, enforceSchema=False, mode="PERMISSIVE", columnNameOfCorruptRecord=record, **options)
    # Renamed by place, so that no name of the file needs care below.
    raw = raw.toDF(*[f"c{i}" for i in range(len(names))], record)
    place = {name: F.col(f"c{i}") for i, name in enumerate(names)}
    texts_of = {name: F.when(~c.isin(list(tokens)), c) if tokens else c for name, c in place.items()}
    kept, left = [], [F.struct(F.lit("").alias("key"), F.col(record).alias("value"))]
    for field in schema.fields:
        text = texts_of.get(field.name, F.lit(None).cast("string"))
        kept.append(text.try_cast(field.dataType).alias(field.name))
        left.append(F.struct(
            F.lit(field.name).alias("key"), F.when(text.try_cast(field.dataType).isNull(), text).alias("value")))
    known = set(schema.fieldNames())
    left += [F.struct(F.lit(name).alias("key"), text.alias("value"))
             for name, text in texts_of.items() if name not in known]
    failed = F.filter(F.array(*left), lambda e: e["value"].isNotNull())
    return raw.select(*kept, F.when(F.size(failed) > 0, F.map_from_entries(failed)).alias(rescued))


def rescued_values(df: DataFrame, keys: Sequence[str] = (), rescued: str = "rescued") -> DataFrame:
    """(keys, column_name, raw): a row for every text that did not fit its column."""
    return df.select(*keys, F.explode(rescued).alias("column_name", "raw"))


def rescue_report(df: DataFrame, rescued: str = "rescued") -> DataFrame:
    """(column_name, n_failed, first_raw, last_raw): how many texts of a column did not fit, the lowest and the highest."""
    return rescued_values(df, (), rescued).groupBy("column_name").agg(
        F.count(F.lit(1)).alias("n_failed"), F.min("raw").alias("first_raw"), F.max("raw").alias("last_raw"))
