"""Fingerprints of tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.operators.cleaning import content_hash


def table_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row (n_rows, digest) that identifies the content whatever the row order.

    Each row is hashed over all its columns; the digest is the sum of both hash halves. The sums
    are decimals, since longs would overflow beyond two billion rows.
    """
    columns = df.columns if columns is None else list(columns)

    def lane(start: int) -> Column:
        number = F.conv(F.substring("h", start, 8), 16, 10).cast("decimal(20,0)")
        return F.coalesce(F.sum(number), F.lit(0)).cast("decimal(38,0)").cast("string")

    return df.select(content_hash(df, columns).alias("h")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.concat_ws("-", lane(1), lane(9)).alias("digest")
    )
