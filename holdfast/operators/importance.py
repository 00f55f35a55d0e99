"""Permutation importance: the drop of average precision when one feature is shuffled."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.keyed import keyed_hash, unit_interval
from holdfast.operators.metrics import (
    curve_areas, ranking_metrics, score_curve, score_points,
)
from holdfast.operators.models import FEATURES, LABEL, ScoringModel
from holdfast.operators.ranking import bounded_broadcast, bucket_count
from holdfast.session import stage_table


def with_donors(df: DataFrame, key: str, values: str, repeats: int, seed: int) -> DataFrame:
    """Each row once per repeat, with the ``values`` of a donor row; every row donates once.

    Per repeat the rows form one random circle, ordered by a keyed hash, and each takes the values
    of its successor. The successor is a ``lead`` inside a bucket of the hash range; only the last
    row of a bucket looks at the small table of first rows. So shuffling costs one exchange and no
    join of the rows with themselves.
    """
    n = bucket_count(df.sparkSession, repeats)
    copies = df.withColumn("repeat", F.explode(F.sequence(F.lit(1), F.lit(repeats))))
    copies = copies.withColumn("__h", keyed_hash(key, "shuffle", F.col("repeat"), seed))
    copies = copies.withColumn("__b", F.floor(unit_interval("__h") * F.lit(n)).cast("int"))
    # The windows' own exchange, with its number of partitions pinned: the rows are few bytes but
    # each one costs many predictions, so they must not be coalesced by size.
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    copies = copies.repartition(parts, "repeat", "__b")
    around = Window.partitionBy("repeat").orderBy("__b")
    whole = around.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    firsts = copies.groupBy("repeat", "__b").agg(
        F.min_by(values, F.struct("__h", key)).alias("__first")
    )
    nexts = firsts.select(
        "repeat", "__b",
        F.coalesce(F.lead("__first").over(around), F.first("__first").over(whole))
        .alias("__next"),
    )
    inside = Window.partitionBy("repeat", "__b").orderBy("__h", key)
    joined = copies.join(bounded_broadcast(nexts, repeats), ["repeat", "__b"], "left")
    donor = F.coalesce(F.lead(values).over(inside), F.col("__next"))
    return joined.withColumn("donor", donor).drop("__h", "__b", "__next")


def _with_shuffled(values: Column, donor: Column, feature: Column) -> Column:
    return F.transform(
        values, lambda x, i: F.when(i == feature, F.get(donor, feature)).otherwise(x)
    )


def permutation_importance(
    model: ScoringModel,
    df: DataFrame,
    features: Sequence[str],
    key: str,
    *,
    repeats: int = 10,
    seed: int = 42,
) -> DataFrame:
    """(feature, importance_mean, importance_std) over the repeats, for (key, label, features) rows.

    As is usual, one shuffled order per repeat serves all features. A row becomes its
    features x repeats variants only after that exchange, right before the model; the scores are
    combined per (feature, repeat) and stored, so every variant is predicted once.
    """
    names = F.array(*[F.lit(f) for f in features])
    plain = model.score(df, "probability")
    base = ranking_metrics(plain, LABEL, "probability").select("pr_auc")
    rows = df.select(key, LABEL, vector_to_array(FEATURES).alias("values"))
    variants = (
        with_donors(rows, key, "values", repeats, seed)
        .withColumn("feature_no", F.explode(F.sequence(F.lit(0), F.lit(len(features) - 1))))
        .withColumn(
            FEATURES,
            array_to_vector(_with_shuffled(F.col("values"), F.col("donor"), F.col("feature_no"))),
        )
        .select(key, LABEL, "repeat", "feature_no", FEATURES)
    )
    by = ["feature_no", "repeat"]
    points = score_points(model.score(variants, "probability"), LABEL, "probability", by)
    shuffled = curve_areas(
        score_curve(stage_table(points, "importance-points"), by, len(features) * repeats), by
    )
    drop = base.scalar() - F.col("pr_auc")
    return (
        shuffled.withColumn("drop", drop)
        .groupBy("feature_no")
        .agg(F.avg("drop").alias("importance_mean"), F.stddev_pop("drop").alias("importance_std"))
        .select(F.get(names, F.col("feature_no")).alias("feature"),
                "importance_mean", "importance_std")
    )


def top_drivers(importance: DataFrame, k: int = 10) -> DataFrame:
    return importance.orderBy(F.desc("importance_mean"), "feature").limit(k)
