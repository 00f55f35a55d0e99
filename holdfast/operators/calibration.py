"""Probability calibrators, fitted on held-out rows of an already fitted model."""

from __future__ import annotations

import sys
from dataclasses import dataclass

from pyspark import cloudpickle
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.session import stage_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

METHODS = ("isotonic", "sigmoid", "none")
RAW = "raw_probability"


@dataclass(frozen=True)
class Calibrator:
    method: str
    model: IsotonicRegressionModel | LogisticRegressionModel

    def apply(self, df: DataFrame, raw: str = RAW, out: str = "churn_probability") -> DataFrame:
        """Add the calibrated probability of the raw one."""
        if self.method == "isotonic":
            work = self.model.transform(df.withColumn("__x", F.col(raw)))
            return work.withColumn(out, F.col("__calibrated")).drop("__x", "__calibrated")
        work = VectorAssembler(inputCols=[raw], outputCol="__x").transform(df)
        work = self.model.transform(work)
        return work.withColumn(out, vector_to_array("__calibrated")[1]).drop(
            "__x", "__margin", "__calibrated", "__decision"
        )

    def save(self, path: str) -> None:
        self.model.write().save(path)

    @classmethod
    def load(cls, method: str, path: str) -> Calibrator:
        loader = IsotonicRegressionModel if method == "isotonic" else LogisticRegressionModel
        return cls(method, loader.load(path))


def _by_score(df: DataFrame, raw: str, label: str) -> DataFrame:
    """Rows of equal score combined: (raw, n, positives). Both fits only need the sums."""
    return df.groupBy(raw).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.count(F.when(F.col(label) == 1, 1)).cast("double").alias("positives"),
    )


def _pooled(scores: list[tuple[float, float, float, float]]) -> list[list[float]]:
    """Neighbouring blocks (lowest, highest, n, positives) merged until their rates rise."""
    stack: list[list[float]] = []
    for block in scores:
        stack.append(list(block))
        while len(stack) > 1 and stack[-2][3] * stack[-1][2] >= stack[-1][3] * stack[-2][2]:
            _, high, n, positives = stack.pop()
            stack[-1][1:] = high, stack[-1][2] + n, stack[-1][3] + positives
    return stack


def isotonic_blocks(scores: DataFrame, raw: str) -> DataFrame:
    """(low, high, n, positives): the steps of the isotonic fit to (raw, n, positives), one row per score.

    Scores are dealt by ranges and each range is pooled by a task of its own; then neighbouring ranges are
    joined two by two, as pooling what is pooled gives the same steps. Only steps travel, never the
    scores. Null scores and those that are not numbers take no part.
    """
    import pyarrow as pa

    shape = "part int, low double, high double, n double, positives double"
    names = ["part", "low", "high", "n", "positives"]
    kinds = [pa.int32(), *[pa.float64()] * 4]

    def rows_of(part: int, blocks) -> pa.RecordBatch:
        columns = zip(*blocks) if blocks else [()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array([part] * len(blocks), kinds[0]), *(pa.array(c, k) for c, k in zip(columns, kinds[1:]))], names=names)

    def pool_range(batches):
        from pyspark import TaskContext

        blocks: list = []
        for batch in batches:
            score, n, positives = (c.to_pylist() for c in batch.columns)
            blocks = _pooled([*blocks, *zip(score, score, n, positives)])
        yield rows_of(TaskContext.get().partitionId(), blocks)

    def pool_pair(table: pa.Table) -> pa.Table:
        table = table.sort_by("low")
        part = table.column("part")[0].as_py() // 2
        blocks = _pooled(list(zip(*(table.column(c).to_pylist() for c in names[1:]))))
        return pa.Table.from_batches([rows_of(part, blocks)])

    known = scores.filter(F.col(raw).isNotNull() & ~F.isnan(raw)).select(F.col(raw).cast("double").alias("x"), "n", "positives")
    parts = int(scores.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    steps = known.repartitionByRange(parts, "x").sortWithinPartitions("x").mapInArrow(pool_range, shape)
    while parts > 1:
        steps = steps.groupBy(F.floor(F.col("part") / 2)).applyInArrow(pool_pair, shape)
        parts = -(-parts // 2)
    return stage_table(steps.drop("part"), "steps")


def fit_calibrator(
    df: DataFrame, method: str | None, raw: str = RAW, label: str = "label"
) -> Calibrator | None:
    """Isotonic steps, Platt's sigmoid, or nothing.

    Platt's smoothed targets enter as two weighted rows per score, one for each label.
    """
    if method in (None, "none"):
        return None
    if method not in METHODS:
        raise ValueError(f"unknown calibration '{method}'; choose one of {METHODS}")
    scores = _by_score(df, raw, label)
    if method == "isotonic":
        steps = isotonic_blocks(scores, raw)  # what Spark's fit has to hold: the ends of the steps
        ends = steps.select(
            F.explode(F.array_distinct(F.array("low", "high"))).alias("__x"), F.col("n"),
            (F.col("positives") / F.col("n")).alias("rate"))
        fit = IsotonicRegression(
            featuresCol="__x", labelCol="rate", weightCol="n", predictionCol="__calibrated").fit(ends)
        return Calibrator(method, fit)
    totals = scores.agg(F.sum("positives").alias("p"), F.sum("n").alias("n")).first()
    positives, negatives = totals["p"] or 0.0, (totals["n"] or 0.0) - (totals["p"] or 0.0)
    high, low = (positives + 1.0) / (positives + 2.0), 1.0 / (negatives + 2.0)
    churned, stayed = F.col("positives"), F.col("n") - F.col("positives")
    weighted = scores.select(
        raw,
        F.explode(F.array(
            F.struct(F.lit(1.0).alias("y"), (churned * high + stayed * low).alias("w")),
            F.struct(F.lit(0.0).alias("y"),
                     (churned * (1.0 - high) + stayed * (1.0 - low)).alias("w")),
        )).alias("s"),
    ).select(raw, "s.*")
    fit = LogisticRegression(
        featuresCol="__x", labelCol="y", weightCol="w", regParam=0.0, standardization=False,
        maxIter=200, tol=1e-9, probabilityCol="__calibrated", rawPredictionCol="__margin",
        predictionCol="__decision",
    ).fit(VectorAssembler(inputCols=[raw], outputCol="__x").transform(weighted))
    return Calibrator(method, fit)
