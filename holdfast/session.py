"""Spark sessions for local work, and the shared folder in which long jobs cut their lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A session for tests and the local bench. On a cluster, bring your own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("holdfast")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def staging_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Executors come and go, so on a cluster the folder has to be shared and the setting is required;
    only a single-machine session falls back to a temporary folder of its own.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    folder = tempfile.mkdtemp(prefix="holdfast-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def staging_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the staging folder."""
    return f"{staging_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the staging folder and read it back.

    What follows starts from stored columns: it survives lost executors without replaying the
    joins before it, sees the same rows every time, and reads only the columns it needs.
    """
    path = staging_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
