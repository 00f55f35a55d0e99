from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from holdfast.operators import profiling


@pytest.fixture(scope="module")
def data():
    rng = np.random.default_rng(1)
    a = rng.normal(size=120)
    return pd.DataFrame({
        "id": np.arange(120), "a": a, "b": 2 * a + rng.normal(size=120),
        "c": np.where(np.arange(120) % 5 == 0, np.nan, rng.normal(size=120)),
        "k": np.ones(120), "t": [["x", "y", "y", None][i % 4] for i in range(120)],
    })


@pytest.fixture(scope="module")
def table(spark, data):
    rows = [
        tuple(None if v is None or v != v else (int(v) if n == "id" else v)
              for n, v in zip(data.columns, row))
        for row in data.itertuples(index=False)
    ]
    return spark.createDataFrame(
        rows, "id long, a double, b double, c double, k double, t string")


def test_describe_matches_pandas(table, data):
    for r in profiling.describe_numbers(table).collect():
        d = data[r["column_name"]].describe()
        got = [r[c] for c in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")]
        assert got == pytest.approx(list(d), abs=1e-12)
    text = profiling.describe_text(table).first()
    assert (text["count"], text["n_distinct"], text["top"], text["freq"]) == (90, 2, "y", 60)


def test_correlations_match_pandas(table, data):
    expected = data[["a", "b", "c", "k"]].corr()
    for r in profiling.correlation_matrix(table, ["a", "b", "c", "k"]).collect():
        e = expected.loc[r["row_name"], r["column_name"]]
        assert r["correlation"] is None if np.isnan(e) else r["correlation"] == pytest.approx(e)
    by_target = profiling.target_correlations(table, "a", ["b", "k"]).collect()
    assert by_target[0]["correlation"] == pytest.approx(expected.loc["a", "b"])


def test_variance_inflation_is_the_uncentred_form(table, data):
    x = data[["a", "b", "c"]].dropna().to_numpy()
    for r in profiling.variance_inflation(table, ["a", "b", "c"]).collect():
        i = "abc".index(r["feature"])
        others = np.delete(x, i, axis=1)
        fit = others @ np.linalg.lstsq(others, x[:, i], rcond=None)[0]
        r2 = 1 - ((x[:, i] - fit) ** 2).sum() / (x[:, i] ** 2).sum()
        assert r["vif"] == pytest.approx(1 / (1 - r2))


def test_counts(table, data):
    got = {r["column_name"]: r["n_distinct"] for r in profiling.distinct_counts(table).collect()}
    assert got == {c: data[c].nunique() for c in data.columns}
    types = profiling.column_types(table).collect()
    assert [r["non_null"] for r in types] == [120, 120, 120, 96, 120, 90]
    assert profiling.columns_by_kind(table)["other"] == ["t"]
    repeated = profiling.duplicate_counts(table.union(table.limit(3)), "id").first()
    assert (repeated["duplicates_with_id"], repeated["duplicates_without_id"]) == (3, 3)
    assert tuple(profiling.table_shape(table).first()) == (120, 6)


def test_correlations_of_shifted_and_partly_constant_columns(spark):
    """Large offsets do not cancel, NaN is missing, and a column that is constant where both are known is null."""
    rows = [(1e9 + i, 1e9 - 2.0 * i, 0.1 if i < 30 else float(i), float(i) if i < 30 else None,
             float("nan") if i == 3 else float(i % 7)) for i in range(40)]
    df = spark.createDataFrame(rows, "a double, b double, c double, d double, e double")
    got = {(r[0], r[1]): r[2] for r in profiling.correlation_matrix(df).collect()}
    assert got["a", "b"] == pytest.approx(-1.0)
    assert got["c", "d"] is None
    expected = pd.DataFrame(rows, columns=list("abcde"))[["a", "e"]].corr().loc["a", "e"]
    assert got["a", "e"] == pytest.approx(expected)
    empty = profiling.correlation_matrix(df.limit(0)).collect()
    assert len(empty) == 25 and all(r[2] is None for r in empty)


def test_correlations_of_many_columns(spark):
    wide = spark.range(200).select(*[F.rand(i).alias(f"x{i}") for i in range(200)])
    assert profiling.correlation_matrix(wide).count() == 40_000


def test_distinct_counts_of_odd_values(spark):
    df = spark.sql("""
        SELECT IF(id % 2 = 0, 0.0D, -0.0D) AS zero, IF(id % 3 = 0, double('nan'), 1.0D) AS nan, id % 7 AS `a b`,
          CAST(NULL AS INT) AS none, array(id % 4, 1) AS list, CAST(CAST(id % 5 AS STRING) AS BINARY) AS bytes,
          timestamp_micros(id % 11) AS time, id % 2 = 0 AS flag, CAST(id AS STRING) AS each, '' AS empty
        FROM range(0, 5000, 1, 6)""")
    expected = {"zero": 1, "nan": 2, "a b": 7, "none": 0, "list": 4, "bytes": 5, "time": 11, "flag": 2,
                "each": 5000, "empty": 1}
    for held in (10, 1_000_000):
        got = profiling.distinct_counts(df, held=held).collect()
        assert {r["column_name"]: r["n_distinct"] for r in got} == expected
    assert all(r["n_distinct"] == 0 for r in profiling.distinct_counts(df.filter("false")).collect())


def test_distinct_counts_keep_numbers_and_times_as_numbers(spark):
    """A text of every value of a wide table took longer than the rest of the count."""
    df = spark.sql("""
        SELECT CAST(id % 5 AS TINYINT) AS tiny, IF(id % 4 = 0, NULL, id) AS gaps, 9007199254740992 + id % 3 AS large,
          CAST(id % 6 AS FLOAT) AS single, id % 2 = 0 AS flag, date_add(DATE'1969-12-28', CAST(id % 8 AS INT)) AS day,
          timestampadd(MICROSECOND, id % 9, TIMESTAMP_NTZ'1969-12-31 23:59:59.999995') AS local_time,
          timestamp_micros(id % 7 - 3) AS time
        FROM range(0, 4000, 1, 5)""")
    plan = df.sparkSession._jvm.PythonSQLUtils.explainString(profiling.distinct_counts(df)._jdf.queryExecution(), "simple")
    assert "as string" not in plan
    for held in (10, 1_000_000):
        got = {r["column_name"]: r["n_distinct"] for r in profiling.distinct_counts(df, held=held).collect()}
        assert got == {"tiny": 5, "gaps": 3000, "large": 3, "single": 6, "flag": 2, "day": 8, "local_time": 9, "time": 7}
    texts = spark.sql("SELECT IF(id % 3 = 0, NULL, id % 10) AS n, IF(id % 3 = 1, NULL, repeat('x', CAST(id % 20 AS INT))) AS t, "
                      "CAST(id % 4 AS DECIMAL(30, 2)) AS d FROM range(500)")
    assert [r["n_distinct"] for r in profiling.distinct_counts(texts, held=50).orderBy("column_name").collect()] == [4, 10, 20]


def _written(node) -> int:
    """Shuffle bytes of an executed plan."""
    while (kind := node.getClass().getSimpleName()) == "AdaptiveSparkPlanExec" or kind.endswith("QueryStageExec"):
        node = node.executedPlan() if kind == "AdaptiveSparkPlanExec" else node.plan()
    own = node.metrics().get("shuffleBytesWritten")
    below = node.children()
    return (own.get().value() if own.isDefined() else 0) + sum(_written(below.apply(i)) for i in range(below.size()))


def test_distinct_values_travel_packed(spark):
    """A (column, number, text) row of every distinct value took more than ten times the table on disk."""
    n, columns = 100_000, 12
    df = spark.range(0, n, 1, 4).select(*[
        (F.col("id") * 7 + i if i % 2 else F.round((F.col("id") * 7919 % n) / 100 + 900 + i, 2)).alias(f"c{i}") for i in range(columns)])
    counts = profiling.distinct_counts(df)
    assert {r["n_distinct"] for r in counts.collect()} == {n}
    assert 0 < _written(counts._jdf.queryExecution().executedPlan()) < 2 * n * columns


def test_packed_values_are_the_same_values():
    rng = np.random.default_rng(7)
    low, high = np.iinfo(np.int64).min, np.iinfo(np.int64).max
    for codes in ([5], [low, high], [low, -1, 0, 1, high], np.arange(70_000) * 86_400_000_000, rng.integers(low, high, 5000)):
        codes = np.unique(np.array(codes, np.int64))
        assert (profiling._unpack(memoryview(profiling._pack(codes))) == codes).all()


def test_distinct_doubles_of_all_sizes(spark):
    """Decimals travel as whole numbers; two of them, or one and another double, are never taken for one."""
    values = [0.0, 1e-4, 1e-5, 0.1 + 0.2, 0.3, float("inf"), float("-inf"), float("nan"), 1e308, -1e308, 5e-324, 1e-310, 9e11, 2.0 ** 53,
              2.0 ** 53 + 2, -0.0001, 1.00005, 104999.99, 1 / 3, 1e15 + 0.5, *(k / 100 for k in range(1, 3000) if k != 30)]
    df = spark.createDataFrame([(v,) for v in values] * 3 + [(-0.0,), (None,)], "v double").repartition(7)
    for held in (10, 1_000_000):
        assert profiling.distinct_counts(df, held=held).first()["n_distinct"] == len(values)


def test_sketches_merge(spark):
    parts = [spark.range(a, a + 30_000).select("id", (F.col("id") % 9).alias("k")) for a in (0, 20_000)]
    both = profiling.distinct_sketches(parts[0]).union(profiling.distinct_sketches(parts[1]))
    got = {r["column_name"]: r["n_distinct"] for r in
           profiling.sketch_estimates(profiling.merge_sketches(both)).collect()}
    assert got["k"] == 9 and got["id"] == pytest.approx(50_000, rel=0.03)
