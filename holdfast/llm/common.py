"""What several operators share: reading, batches of bounded size, running totals, connected components."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.session import stage_table

BATCH_ROWS = 1000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(df: DataFrame, rows: int = BATCH_ROWS) -> DataFrame:
    """``df``, with the session's Arrow batches held to ``rows`` rows, as texts may be long."""
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_SETTING, "10000")) <= rows:
        conf.set(_BATCH_SETTING, str(rows))
    return df


def parts_for(spark: SparkSession, rows: int, each: int = 1_000_000) -> int:
    """Partitions for ``rows`` rows about to be made out of few: adaptive execution sees only the few, and
    would put them in one task if it chose."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))


def worker_memory() -> dict:
    """A dictionary that lives as long as the Python worker, for what is slow to load; functions travel by value."""
    import sys
    import types

    name = "holdfast_worker_memory"
    return sys.modules.setdefault(name, types.ModuleType(name)).__dict__


def batch_of(rows, schema):
    """An Arrow record batch of ``rows`` (tuples in the order of ``schema``)."""
    import pyarrow as pa

    columns = zip(*rows) if rows else [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def running_start(
    df: DataFrame, group: Sequence[str], size: Column, order: Sequence[Column],
    name: str = "start", buckets: int = 512, seed: int = 7,
) -> DataFrame:
    """Adds ``name``: the sizes of all rows of the group that come before this one.

    The order is (bucket, ``order``), the bucket being a hash of ``order``: a group of any size is
    spread over ``buckets`` windows, and the totals of the buckets are summed apart. ``order`` should
    tell different rows apart; rows that are equal in it are taken to be equal. ``group`` columns must
    not be null.
    """
    spread = F.pmod(F.xxhash64(*order, F.lit(seed)), F.lit(buckets))
    sized = df.withColumn("_bucket", spread).withColumn("_size", size.cast("long"))
    totals = sized.groupBy(*group, "_bucket").agg(F.sum("_size").alias("_total"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    bases = totals.select(
        *group, "_bucket", F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_base")
    )
    inside = Window.partitionBy(*group, "_bucket").orderBy(*order).rowsBetween(
        Window.unboundedPreceding, -1
    )
    return (
        sized.join(bases, [*group, "_bucket"])
        .withColumn(name, F.col("_base") + F.coalesce(F.sum("_size").over(inside), F.lit(0)))
        .drop("_bucket", "_size", "_base")
    )


def connected_components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (src, dst); a component is named by its smallest node.

    Large-star and small-star steps in turn: each node hands its neighbours to the smallest one it
    knows, until every node hangs on the smallest of its component. Minima are taken before rows
    travel; joins on a hub are ordinary joins that adaptive execution may split. Every round is written
    to the shared folder. No edges: no rows.
    """
    current = stage_table(
        edges.select(F.col("src").cast("long"), F.col("dst").cast("long"))
        .filter("src != dst")
        .select(F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst"))
        .distinct(),
        "edges",
    )
    seen = _state(current)
    for _ in range(max_rounds):
        both = current.union(current.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
        least = both.groupBy("src").agg(F.least(F.min("dst"), F.col("src")).alias("low"))
        large = (
            both.join(least, "src").filter("dst > src")
            .select(F.col("dst").alias("src"), F.col("low").alias("dst")).distinct()
        )
        low = large.groupBy("src").agg(F.min("dst").alias("low"))
        small = (
            large.join(low, "src").select(F.col("dst").alias("src"), F.col("low").alias("dst"))
            .union(low.select("src", F.col("low").alias("dst")))
            .filter("src != dst").distinct()
        )
        current = stage_table(small, "edges")
        now = _state(current)
        if now == seen:
            return current.select(F.col("src").alias("node"), F.col("dst").alias("component")).union(
                current.select(F.col("dst").alias("node"), F.col("dst").alias("component")).distinct()
            )
        seen = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def _state(edges: DataFrame):
    """Tells two sets of edges apart."""
    row = edges.agg(
        F.count("*"), F.sum(F.xxhash64("src", "dst").cast("decimal(38,0)")),
        F.sum(F.xxhash64("dst", "src", F.lit(1)).cast("decimal(38,0)")),
    ).first()
    return tuple(row)
