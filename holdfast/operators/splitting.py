"""Stratified splits, folds and class weights.

A split is a comparison of the row's keyed hash with one cut per class, so assigning a hundred
billion rows to train, validation and test is a projection. The cuts sit at exact ranks, which
makes the class counts exact too, also where keys repeat or are missing: ties are broken by the content
of the row, and rows equal in every column are numbered where a cut falls among them.

Cuts are literals for up to ``literal_classes`` classes; beyond that they are a table joined on the class.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.functions.keyed import keyed_hash
from holdfast.operators.class_tables import between_ranks, class_table, with_fold_ends, with_quota
from holdfast.operators.ranking import hash_places

CLASS_LIMIT = 1000


def _few_classes(df: DataFrame, target: str, most: int) -> dict[object, int] | None:
    """The class counts, or None where there are more than ``most`` classes."""
    if most < 1:
        return None
    rows = df.groupBy(target).agg(F.count(F.lit(1)).alias("n")).limit(most + 1).collect()
    if any(r[target] is None for r in rows):
        raise ValueError(f"'{target}' has nulls")
    if len(rows) > most:
        return None
    return {r[target]: r["n"] for r in sorted(rows, key=lambda r: r[target])}


def class_counts(df: DataFrame, target: str) -> dict[object, int]:
    counts = _few_classes(df, target, CLASS_LIMIT)
    if counts is None:
        raise ValueError(f"'{target}' has more than {CLASS_LIMIT} classes")
    return counts


def stratified_quota(counts: Mapping[object, int], draws: int) -> dict[object, int]:
    """Share ``draws`` among the classes by largest remainder; equal remainders go to the lower
    class first."""
    total = sum(counts.values())
    exact = {c: draws * n / total for c, n in counts.items()}
    quota = {c: math.floor(x) for c, x in exact.items()}
    order = sorted(counts, key=lambda c: (-(exact[c] - quota[c]), c))
    for c in order[: draws - sum(quota.values())]:
        quota[c] += 1
    return quota


def _order_text(df: DataFrame, key: str, *salt: object) -> Column:
    """The keyed hash, and after it a hash of the whole row: rows without a key, or with the same one,
    still have an order of their own."""
    vectors = {f.name for f in df.schema.fields if isinstance(f.dataType, VectorUDT)}
    content = F.to_json(F.struct(*[
        (vector_to_array(F.col(f"`{c}`")) if c in vectors else F.col(f"`{c}`")).alias(f"c{i}")
        for i, c in enumerate(df.columns)
    ]))
    return F.concat(keyed_hash(key, *salt), F.md5(content))


def _between_cuts(df: DataFrame, target: str, hashed: Column, ranks: Mapping[object, Sequence[int]],
                  names: Sequence[object], name: str) -> DataFrame:
    """Adds names[i] for the first rank that the row's place in its class does not exceed, the last name
    beyond all.

    A projection, unless a rank falls among rows that are equal in every column: then those are numbered.
    """
    places = hash_places(df, target, hashed, ranks)
    cut_copies = any(0 < place < n for found in places.values() for _, place, n in found)
    number = F.lit(1)
    if cut_copies:
        split = [h for found in places.values() for h, place, n in found if 0 < place < n]
        number = F.when(hashed.isin(split), F.row_number().over(
            Window.partitionBy(target, F.when(hashed.isin(split), hashed).otherwise(
                F.substring(hashed, 1, 8))).orderBy(hashed)))
    work = df.withColumns({"__hash": hashed, "__number": number})
    label = None
    for value, found in places.items():
        slot = None
        for (h, place, n), one in zip(found, names):
            rule = F.col("__hash") <= F.lit(h)
            if 0 < place < n:
                rule = (F.col("__hash") < F.lit(h)) | (
                    (F.col("__hash") == F.lit(h)) & (F.col("__number") <= place))
            slot = F.when(rule, F.lit(one)) if slot is None else slot.when(rule, F.lit(one))
        slot = slot.otherwise(F.lit(names[-1]))
        same = F.col(target) == F.lit(value)
        label = F.when(same, slot) if label is None else label.when(same, slot)
    return work.withColumn(name, label).drop("__hash", "__number")


def holdout_split(
    df: DataFrame, key: str, target: str, fraction: float, seed: int,
    *, name: str = "split", held: str = "test", rest: str = "train", literal_classes: int = CLASS_LIMIT,
) -> DataFrame:
    """Mark ceil(fraction * n) rows, shared among the classes in proportion, as held out."""
    counts = _few_classes(df, target, literal_classes)
    if counts is None:
        classes = class_table(df, target)
        draws = math.ceil(fraction * (classes.agg(F.sum("n")).first()[0] or 0))
        classes = with_quota(classes, draws)
        return between_ranks(df, target, _order_text(df, key, seed), classes, ["quota"], [held, rest], name)
    quota = stratified_quota(counts, math.ceil(fraction * sum(counts.values())))
    ranks = {c: [q] for c, q in quota.items()}
    return _between_cuts(df, target, _order_text(df, key, seed), ranks, [held, rest], name)


def three_way_split(
    df: DataFrame, key: str, target: str, test_size: float, val_size: float, seed: int,
    *, name: str = "split", literal_classes: int = CLASS_LIMIT,
) -> DataFrame:
    """test / val / train; the validation share is ``val_size`` of the whole table."""
    counts = _few_classes(df, target, literal_classes)
    if counts is None:
        classes = class_table(df, target)
        n = classes.agg(F.sum("n")).first()[0] or 0
        draws = math.ceil(test_size * n)
        classes = with_quota(classes, draws, name="__test").withColumn("__left", F.col("n") - F.col("__test"))
        classes = with_quota(classes, math.ceil(val_size / (1.0 - test_size) * (n - draws)), "__left", "__val")
        classes = classes.withColumn("__both", F.col("__test") + F.col("__val"))
        return between_ranks(df, target, _order_text(df, key, seed), classes, ["__test", "__both"],
                             ["test", "val", "train"], name)
    n = sum(counts.values())
    test = stratified_quota(counts, math.ceil(test_size * n))
    left = {c: counts[c] - test[c] for c in counts}
    val_fraction = val_size / (1.0 - test_size)
    val = stratified_quota(left, math.ceil(val_fraction * sum(left.values())))
    ranks = {c: [test[c], test[c] + val[c]] for c in counts}
    names = ["test", "val", "train"]
    return _between_cuts(df, target, _order_text(df, key, seed), ranks, names, name)


def fold_sizes(counts: Mapping[object, int], k: int) -> dict[object, list[int]]:
    """Rows of each class per fold: lay the classes end to end and deal the places round-robin, so
    sizes differ by at most one, per class and overall."""
    sizes, start = {}, 0
    for c, n in counts.items():
        sizes[c] = [n // k + (1 if (f - start) % k < n % k else 0) for f in range(k)]
        start += n
    return sizes


def stratified_folds(
    df: DataFrame, key: str, target: str, k: int, seed: int, *, name: str = "fold",
    literal_classes: int = CLASS_LIMIT,
) -> DataFrame:
    """Fold numbers 0..k-1, exactly balanced by class."""
    if k < 2:
        raise ValueError(f"at least 2 folds are needed; got {k}")
    counts = _few_classes(df, target, literal_classes)
    if counts is None:
        classes, places = with_fold_ends(class_table(df, target), k)
        return between_ranks(df, target, _order_text(df, key, "fold", seed), classes, places, list(range(k)), name)
    ends = {}
    for c, sizes in fold_sizes(counts, k).items():
        ends[c] = [sum(sizes[: f + 1]) for f in range(k - 1)]
    return _between_cuts(df, target, _order_text(df, key, "fold", seed), ends, list(range(k)), name)


def class_ratio(df: DataFrame, target: str) -> DataFrame:
    """One row: negatives, positives, and negatives per positive."""
    return df.agg(
        F.count(F.when(F.col(target) == 0, 1)).alias("n_negative"),
        F.count(F.when(F.col(target) == 1, 1)).alias("n_positive"),
    ).withColumn(
        "ratio", F.try_divide(F.col("n_negative").cast("double"), F.col("n_positive"))
    )


def balanced_weights(counts: Mapping[object, int]) -> dict[object, float]:
    """n / (classes * n_class)."""
    total = sum(counts.values())
    return {c: total / (len(counts) * n) for c, n in counts.items()}


def with_class_weight(df: DataFrame, target: str, weights: Mapping[object, float],
                      name: str = "weight") -> DataFrame:
    expression = None
    for value, weight in weights.items():
        rule, w = F.col(target) == F.lit(value), F.lit(float(weight))
        expression = F.when(rule, w) if expression is None else expression.when(rule, w)
    return df.withColumn(name, expression.otherwise(F.lit(1.0)))
