from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.functions.arithmetic import edges_below, ratio_or_zero, round_half_even
from holdfast.functions.keyed import keyed_hash, unit_interval
from holdfast.operators import splitting
from holdfast.operators.percentiles import exact_percentiles, order_statistics
from holdfast.operators.ranking import hash_cuts, with_global_rank


def md5(*parts) -> str:
    return hashlib.md5(":".join(str(p) for p in parts).encode()).hexdigest()


VALUES = {
    "distinct": lambda i: (i * 7919 % 2003) / 2003,
    "all_tied": lambda i: 0.5,
    "third_tied": lambda i: 0.25 if i % 3 == 0 else (i * 7919 % 2003) / 2003,
    "few": lambda i: (i % 5) / 4,
    "crowded": lambda i: 0.5 + i * 1e-12,
}


@pytest.mark.parametrize("kind", VALUES)
def test_global_rank_is_the_sorted_position(spark, kind):
    rows = [(i, VALUES[kind](i)) for i in range(2003)]
    df = spark.createDataFrame(rows, "id long, p double")
    expected = {
        i: r for r, (i, _) in
        enumerate(sorted(rows, key=lambda x: (-x[1], md5(x[0], 42), x[0])), start=1)
    }
    for partitions in (1, 16):
        ranked = with_global_rank(df.repartition(partitions), "id", [42], value=F.col("p"))
        assert {r["id"]: r["rank"] for r in ranked.collect()} == expected


def test_rank_within_groups_follows_the_hash(spark):
    rows = [(i, "big" if i % 3 else f"g{i % 2}") for i in range(500)]
    df = spark.createDataFrame(rows, "id long, g string")
    ranked = with_global_rank(df, "id", ["x", 1], by=["g"], groups=3).collect()
    for g in {g for _, g in rows}:
        members = sorted((md5(i, "x", 1), i) for i, h in rows if h == g)
        expected = {i: r for r, (_, i) in enumerate(members, start=1)}
        assert {r["id"]: r["rank"] for r in ranked if r["g"] == g} == expected


def test_ties_are_spread_over_partitions(spark):
    df = spark.range(4000).withColumn("p", F.lit(0.5))
    ranked = with_global_rank(df, "id", [1], value=F.col("p"))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        sizes = ranked.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert max(r["count"] for r in sizes) < 4000 * 0.6


@pytest.mark.parametrize("limit", [1, 10, 20_000])
def test_hash_cuts_find_exact_ranks(spark, limit):
    rows = [(i, i % 2) for i in range(1000)]
    df = spark.createDataFrame(rows, "id long, c int")
    cuts = hash_cuts(df, "c", keyed_hash("id", 7), {0: [0, 1, 250, 500], 1: [13]},
                     fetch_limit=limit)
    ordered = {c: sorted(md5(i, 7) for i, k in rows if k == c) for c in (0, 1)}
    assert cuts[0] == ["", ordered[0][0], ordered[0][249], ordered[0][499]]
    assert cuts[1] == [ordered[1][12]]
    with pytest.raises(ValueError, match="fewer than"):
        hash_cuts(df, "c", keyed_hash("id", 7), {1: [501]})


def test_unit_interval_is_monotone(spark):
    rows = sorted(
        spark.range(300).select(keyed_hash("id", 1).alias("h"), unit_interval(
            keyed_hash("id", 1)).alias("u")).collect()
    )
    assert all(a["u"] <= b["u"] for a, b in zip(rows, rows[1:]))
    assert all(0 <= r["u"] < 1 for r in rows)


def test_edges_below_matches_searchsorted(spark):
    edges = [0.1, 0.2, 0.2, 0.2, 0.5, 0.9]
    values = [0.0, 0.1, 0.15, 0.2, 0.3, 0.5, 0.9, 1.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    array = F.array(*[F.lit(e) for e in edges])
    rows = df.select(
        "v", edges_below(array, F.col("v"), 6).alias("lo"),
        edges_below(array, F.col("v"), 6, inclusive=True).alias("hi"),
    ).collect()
    for r in rows:
        assert r["lo"] == np.searchsorted(edges, r["v"], "left")
        assert r["hi"] == np.searchsorted(edges, r["v"], "right")


def test_rounding_and_ratios(spark):
    values = [0.00005, 0.00015, 0.00025, 0.12345, 0.99995]
    df = spark.createDataFrame([(v,) for v in values], "p double")
    got = [r[0] for r in df.select(round_half_even(F.col("p"), 4)).collect()]
    assert got == [float(np.round(v, 4)) for v in values]
    assert df.select(ratio_or_zero(F.lit(3), F.lit(0))).first()[0] == 0.0


def test_exact_percentiles(spark):
    rng = np.random.default_rng(3)
    wide = rng.lognormal(0, 3, 4001)
    rows = [
        (float(w), None if i % 4 == 0 else i % 3, None, -float(w) if i % 2 else None)
        for i, w in enumerate(wide)
    ]
    df = spark.createDataFrame(rows, "a double, b int, c double, d double").repartition(7)
    got = exact_percentiles(df, ["a", "b", "c", "d"], [0.25, 0.5, 0.75])
    columns = list(zip(*rows))
    for name, values in zip("abd", (columns[0], columns[1], columns[3])):
        known = [v for v in values if v is not None]
        assert got[name] == pytest.approx(list(np.quantile(known, [0.25, 0.5, 0.75])), rel=1e-12)
    assert got["c"] == [None, None, None]
    assert exact_percentiles(df.filter("false"), ["a"], [0.5]) == {"a": [None]}


def test_percentiles_of_equal_and_of_distinct_values(spark):
    n = 1_000_000
    df = spark.range(n, numPartitions=8).select(
        F.lit(7.25).alias("same"), (F.col("id") * 7919 % n + 0.1).alias("each"),
        F.when(F.col("id") % 3 == 0, F.lit(-1e300)).otherwise(F.col("id") / n).alias("mixed"))
    got = exact_percentiles(df, ["same", "each", "mixed"], [0.0, 0.1, 0.5, 1.0])
    ids = np.arange(n)
    expected = {"same": np.full(n, 7.25), "each": ids * 7919 % n + 0.1,
                "mixed": np.where(ids % 3 == 0, -1e300, ids / n)}
    for name, values in expected.items():
        assert got[name] == pytest.approx(list(np.quantile(values, [0.0, 0.1, 0.5, 1.0])), rel=1e-12)


def test_order_statistics_of_any_doubles(spark):
    values = [0.0, -0.0, 5e-324, -5e-324, 1e-310, 1.7e308, -1.7e308, math.inf, -math.inf, math.nan, math.nan,
              1.0, 1.0 + 2**-52, 1.0 - 2**-53, -1.0, -1.0 - 2**-52, 3.0, 3.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "`odd name` double").repartition(3)
    got = order_statistics(df, {"odd name": range(len(values))})
    expected = sorted((v for v in values if v == v)) + [math.nan, math.nan]
    for i, v in enumerate(expected):
        assert got["odd name", i] == v or (math.isnan(v) and math.isnan(got["odd name", i]))
    with pytest.raises(ValueError, match="rank"):
        order_statistics(df, {"odd name": [len(values)]})


@pytest.mark.parametrize("key", ["repeated", "missing", "copies"])
def test_splits_are_exact_on_any_keys(spark, key):
    df = spark.range(1000).select(
        {"repeated": F.col("id") % 10, "missing": F.when(F.col("id") % 2 == 0, F.col("id")),
         "copies": F.lit(None).cast("long")}[key].alias("k"),
        (F.col("id") % 5 == 0).cast("int").alias("y"),
        (F.lit(0) if key == "copies" else F.col("id")).alias("x"),
    )
    sizes = {
        (r["split"], r["y"]): r["count"] for r in
        splitting.three_way_split(df, "k", "y", 0.2, 0.2, 42).groupBy("split", "y").count().collect()
    }
    assert sizes == {("test", 0): 160, ("test", 1): 40, ("val", 0): 160, ("val", 1): 40,
                     ("train", 0): 480, ("train", 1): 120}
    folds = splitting.stratified_folds(df, "k", "y", 5, 42).groupBy("fold", "y").count().collect()
    assert {(r["fold"], r["y"]): r["count"] for r in folds} == {
        (f, y): n for f in range(5) for y, n in ((0, 160), (1, 40))}
