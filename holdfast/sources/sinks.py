"""Writing result tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.operators.cleaning import ROW_KEY


def write_table(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Parquet, or CSV with a header if the path ends in .csv. Every task writes its own file."""
    writer = df.write.mode(mode)
    if path.lower().rstrip("/").endswith(".csv"):
        writer.csv(path, header=True, escape='"')
    else:
        writer.parquet(path)


def write_cleaned(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """The cleaned table without its side key."""
    write_table(df.drop(ROW_KEY), path, mode)


def ranked_scores(scored: DataFrame, probability: str = "churn_probability",
                  id_column: str | None = "CustomerID") -> DataFrame:
    """Highest probability first; a range-partitioned sort, ties in id order."""
    ties = [id_column] if id_column and id_column in scored.columns else []
    return scored.orderBy(F.col(probability).desc(), *ties)


def write_ranked(scored: DataFrame, path: str, mode: str = "errorifexists",
                 id_column: str | None = "CustomerID") -> None:
    """The files follow the ranking: part 0 holds the highest probabilities."""
    write_table(ranked_scores(scored, id_column=id_column), path, mode)


def write_json_record(record: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """A one-row report."""
    record.coalesce(1).write.mode(mode).json(path)
