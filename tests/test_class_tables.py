from __future__ import annotations

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from holdfast.operators import class_tables, splitting


def _shape(df, *by):
    return Counter(tuple(r) for r in df.select(*by).collect())


@pytest.fixture(scope="module")
def tables(spark):
    """Tables with unique, repeated and missing keys, and one of equal rows, with classes of unequal size."""
    base = spark.range(1000, numPartitions=5)
    y = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("c"), (F.col("id") % 41).cast("string")))
    return {
        "unique": base.select("id", y.alias("y"), (F.col("id") * 2).alias("x")),
        "repeated": base.select((F.col("id") % 10).alias("id"), y.alias("y"), F.col("id").alias("x")),
        "missing": base.select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("id"), y.alias("y"), F.col("id").alias("x")),
        "equal": base.select(F.lit(None).cast("long").alias("id"), y.alias("y"), F.lit(0).alias("x")),
    }


@pytest.mark.parametrize("keys", ["unique", "repeated", "missing", "equal"])
def test_tables_give_what_literals_give(tables, keys):
    df = tables[keys].cache()
    for split in (
        lambda n: splitting.holdout_split(df, "id", "y", 0.23, 7, literal_classes=n),
        lambda n: splitting.three_way_split(df, "id", "y", 0.2, 0.15, 7, literal_classes=n),
        lambda n: splitting.stratified_folds(df, "id", "y", 4, 7, literal_classes=n),
    ):
        few, many = split(1000), split(0)
        assert few.columns == many.columns and few.dtypes == many.dtypes
        assert _shape(many, *many.columns) == _shape(few, *few.columns)


@pytest.mark.parametrize("keys", ["unique", "repeated", "missing", "equal"])
def test_slices_of_many_rows_are_cut_again(tables, keys, monkeypatch):
    """Rows without a key share the hash of their key: they were sorted in one task."""
    df = tables[keys].cache()
    few = splitting.stratified_folds(df, "id", "y", 4, 7)
    depths, cut = [], class_tables._cut_slices

    def seen(*arguments, **options):
        cuts = cut(*arguments, **options)
        depths.append(max(r["m"] for r in cuts.selectExpr("greatest(__m0, __m1, __m2) AS m").collect()))
        return cuts

    monkeypatch.setattr(class_tables, "_SLICE_ROWS", 20)
    monkeypatch.setattr(class_tables, "_cut_slices", seen)
    many = splitting.stratified_folds(df, "id", "y", 4, 7, literal_classes=0)
    assert _shape(many, *many.columns) == _shape(few, *few.columns)
    if keys == "missing":
        assert depths[0] > 100 and depths[-1] <= 5


def test_quota_of_many_equal_classes(spark):
    classes = spark.range(5000, numPartitions=3).select(
        F.col("id").alias("y"), F.lit(3).cast("long").alias("n"), F.col("id").alias("place"))
    quota = {r["y"]: r["quota"] for r in class_tables.with_quota(classes, 3001).collect()}
    assert sum(quota.values()) == 3001
    assert {y for y, q in quota.items() if q} == set(range(3001))


def test_quota_is_exact_by_largest_remainder(spark):
    sizes = {y: (y * 7919) % 101 + 1 for y in range(400)}
    total, draws = sum(sizes.values()), 3333
    classes = spark.createDataFrame([(y, n, y) for y, n in sizes.items()], "y int, n long, place long")
    quota = {r["y"]: r["quota"] for r in class_tables.with_quota(classes, draws).collect()}
    expected = {y: draws * n // total for y, n in sizes.items()}
    order = sorted(sizes, key=lambda y: (-(draws * sizes[y] % total), y))
    for y in order[:draws - sum(expected.values())]:
        expected[y] += 1
    assert quota == expected


def test_more_classes_than_literals(spark):
    df = spark.range(6000).select("id", (F.col("id") % 1500).alias("y"))
    folds = splitting.stratified_folds(df, "id", "y", 3, 1).groupBy("y", "fold").count().collect()
    sizes = Counter()
    for r in folds:
        assert r["count"] in (1, 2)
        sizes[r["fold"]] += r["count"]
    assert sizes == {0: 2000, 1: 2000, 2: 2000}
    assert splitting.holdout_split(df, "id", "y", 0.1, 1).filter("split = 'test'").count() == 600


def test_copies_of_one_row_are_dealt_in_pieces(spark):
    df = spark.range(50_000).select(F.lit(None).cast("long").alias("id"), F.lit("only").alias("y"))
    got = splitting.three_way_split(df, "id", "y", 0.2, 0.2, 3, literal_classes=0)
    assert _shape(got, "split") == {("test",): 10_000, ("val",): 10_000, ("train",): 30_000}


def test_empty_tables_nulls_and_weights(spark):
    empty = spark.createDataFrame([], "id long, y long")
    assert splitting.holdout_split(empty, "id", "y", 0.5, 1, literal_classes=0).collect() == []
    assert splitting.stratified_folds(empty, "id", "y", 3, 1, literal_classes=0).collect() == []
    with pytest.raises(ValueError, match="nulls"):
        splitting.holdout_split(spark.createDataFrame([(1, None)], "id long, y long"), "id", "y", 0.5, 1,
                                literal_classes=0)
    df = spark.createDataFrame([(1, 0), (2, 0), (3, 1), (4, None)], "id long, y long")
    weights = {r["id"]: r["weight"] for r in class_tables.with_balanced_weight(df, "y").collect()}
    assert weights == {1: 0.75, 2: 0.75, 3: 1.5, 4: 1.0}
    assert math.isclose(sum(weights[i] for i in (1, 2, 3)), 3.0)
