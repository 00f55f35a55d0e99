"""Exact order statistics over whole tables without a single-partition sort.

A global rank, a running total and a top-n by hash all need a position in one total order. Here
rows are first cut into buckets by a function that never decreases along that order. The bucket
counts are a bounded table; their running sum gives each bucket its offset; inside a bucket an
ordinary partitioned window does the rest. The bucket edges steer only the balance: any edges give
the same ranks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.functions.arithmetic import edges_below
from holdfast.functions.keyed import keyed_hash, unit_interval

MAX_BUCKETS = 4096
_SKETCH_ACCURACY = 20_000


def bucket_count(spark: SparkSession, groups: int | None = 1) -> int:
    """Buckets per group: a few per shuffle partition, at most MAX_BUCKETS over all groups."""
    wanted = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(wanted, MAX_BUCKETS // max(groups or 64, 1)))


def bounded_broadcast(df: DataFrame, groups: int | None) -> DataFrame:
    """Hint a broadcast of a per-bucket table where the number of groups bounds its size.

    With an unknown or large number of groups Spark chooses from the sizes it sees.
    """
    return F.broadcast(df) if groups is not None and groups <= MAX_BUCKETS else df


def quantile_edges(df: DataFrame, value: Column, n: int) -> Column:
    """The ``n - 1`` inner quantiles of ``value``, fixed as a literal array.

    A sketch may come out a little different each time it is computed, so it is computed once, here,
    and not inside the plan: counts and ranks must see the same buckets even if a lost executor has
    its work repeated. Groups need no edges of their own: a bucket of the whole table bounds every
    group's part of it.
    """
    fractions = [i / n for i in range(1, n)]
    found = None
    if fractions:
        sketch = F.percentile_approx(value.cast("double"), fractions, _SKETCH_ACCURACY)
        found = df.agg(sketch.alias("edges")).first()["edges"]
    return F.array(*[F.lit(e) for e in found or []]).cast("array<double>")


def with_global_rank(
    df: DataFrame,
    key: str,
    salt: Sequence[object],
    *,
    value: Column | None = None,
    descending: bool = True,
    by: Sequence[str] = (),
    groups: int | None = None,
    name: str = "rank",
) -> DataFrame:
    """Add the exact 1-based position within ``by``, ordered by (value, keyed hash, key).

    Without ``value`` the order is that of the hash alone, a random order, and the buckets are
    equal slices of the hash range. With ``value`` they lie between its quantiles; a value heavy
    enough to cover several quantiles is spread over that many buckets by the hash, so ties of any
    size are split as well. ``groups`` is the number of groups, if known. The rows are read three
    times (quantiles, counts, ranks): give them as a stored table.
    """
    groups = groups if by else 1
    n = bucket_count(df.sparkSession, groups)
    work = df.withColumn("__h", keyed_hash(key, *salt))
    share = unit_interval("__h")
    order = [F.col("__h"), F.col(key)]
    if value is None:
        work = work.withColumn("__b", F.floor(share * F.lit(n)).cast("int"))
    else:
        work = work.withColumn("__v", -value if descending else value)
        edges = quantile_edges(work, F.col("__v"), n)
        low = edges_below(edges, F.col("__v"), n - 1)
        high = edges_below(edges, F.col("__v"), n - 1, inclusive=True)
        work = (
            work.withColumns({"__lo": low, "__hi": high})
            .withColumn(
                "__b",
                (F.col("__lo") + F.floor(share * (F.col("__hi") - F.col("__lo") + 1))).cast("int"),
            )
            .drop("__lo", "__hi")
        )
        order = [F.col("__v"), *order]

    before = Window.partitionBy(*by).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        work.groupBy(*by, "__b")
        .agg(F.count(F.lit(1)).alias("__n"))
        .select(*by, "__b", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__offset"))
    )
    # A left join, because an inner one would push "bucket is not null" below and compute every
    # bucket twice.
    placed = work.join(bounded_broadcast(offsets, groups), [*by, "__b"], "left")
    inside = Window.partitionBy(*by, "__b").orderBy(*order)
    rank = (F.col("__offset") + F.row_number().over(inside)).cast("long")
    return placed.withColumn(name, rank).select(*df.columns, name)


def hash_cuts(
    df: DataFrame, group: str, hashed: Column, ranks: Mapping[object, Sequence[int]],
    *, fetch_limit: int = 20_000,
) -> dict[object, list[str]]:
    """The hash text at the given 1-based ranks of each group, found without sorting the table."""
    places = hash_places(df, group, hashed, ranks, fetch_limit=fetch_limit)
    return {g: [place[0] for place in found] for g, found in places.items()}


def hash_places(
    df: DataFrame, group: str, hashed: Column, ranks: Mapping[object, Sequence[int]],
    *, fetch_limit: int = 20_000,
) -> dict[object, list[tuple[str, int, int]]]:
    """(hash, place, rows) at the given 1-based ranks of each group: the hash text there, the place of the
    rank among the rows with that text, and how many these are.

    Counts per leading digits locate the slice that holds a rank; slices with more than
    ``fetch_limit`` distinct hashes are counted again with more digits. A rank of 0 gives the empty
    text, below every hash. Rows with one hash are counted, not fetched, so a hash that repeats costs
    one row. Only counts and small slices reach the driver; the rows are never shuffled.
    """
    keyed = df.select(F.col(group).alias("g"), hashed.alias("h"))
    places: dict[tuple[object, int], tuple[str, int, int]] = {}
    pending: dict[tuple[object, int], tuple[str, int]] = {}
    for g, wanted in ranks.items():
        for r in wanted:
            if r <= 0:
                places[g, r] = ("", 0, 0)
            else:
                pending[g, r] = ("", r)
    digits = 0
    while pending:
        digits += 3
        counted = _only(keyed, pending, digits - 3).groupBy("g", "h").agg(
            F.count(F.lit(1)).alias("n")
        ).groupBy("g", F.substring("h", 1, digits).alias("p")).agg(
            F.sum("n").alias("n"), F.count(F.lit(1)).alias("hashes")
        ) if digits > 3 else keyed.groupBy("g", F.substring("h", 1, digits).alias("p")).agg(
            F.count(F.lit(1)).alias("n"), F.count(F.lit(1)).alias("hashes")
        )
        slices: dict[object, list[tuple[str, int, int]]] = {}
        for row in counted.collect():
            slices.setdefault(row["g"], []).append((row["p"], row["n"], row["hashes"]))
        for found in slices.values():
            found.sort()
        ready: dict[tuple[object, int], tuple[str, int]] = {}
        deeper: dict[tuple[object, int], tuple[str, int]] = {}
        for (g, r), (prefix, left) in pending.items():
            for p, n, hashes in slices.get(g, ()):
                if not p.startswith(prefix):
                    continue
                if left <= n:
                    (ready if hashes <= fetch_limit else deeper)[g, r] = (p, left)
                    break
                left -= n
            else:
                raise ValueError(f"group {g!r} has fewer than {r} rows")
        if ready:
            inside: dict[tuple[object, str], list[tuple[str, int]]] = {}
            for row in _only(keyed, ready, digits).groupBy("g", "h").agg(
                F.count(F.lit(1)).alias("n")
            ).collect():
                inside.setdefault((row["g"], row["h"][:digits]), []).append((row["h"], row["n"]))
            for (g, r), (p, left) in ready.items():
                for h, n in sorted(inside[g, p]):
                    if left <= n:
                        places[g, r] = (h, left, n)
                        break
                    left -= n
        pending = deeper
    return {g: [places[g, r] for r in wanted] for g, wanted in ranks.items()}


def _only(keyed: DataFrame, wanted: Mapping, digits: int) -> DataFrame:
    if digits == 0:
        return keyed
    places = {(g, prefix) for (g, _), (prefix, _) in wanted.items()}
    keep = F.lit(False)
    for g in {g for g, _ in places}:
        prefixes = sorted(p for pg, p in places if pg == g)
        keep = keep | ((F.col("g") == F.lit(g)) & F.substring("h", 1, digits).isin(prefixes))
    return keyed.filter(keep)
