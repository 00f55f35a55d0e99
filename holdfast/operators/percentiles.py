"""Exact interpolated percentiles of many columns of a table of any size.

A double has a 64-bit image that keeps its order. The image of a wanted order statistic is found from
its leading bits down: each pass counts, for all columns at once, the values below every prefix that is
still open, 10 or 12 bits further. Tasks add up their counts, so a pass moves at most a few thousand
numbers per open prefix and task, whether the values are all different or all equal, and
no value is kept in a buffer. A prefix under which only one value occurs ends its search at once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_ACCURACY = 10_000
# (bits below the prefix after the pass, bits the pass looks at); together all 64.
_PASSES = ((52, 12), (40, 12), (30, 10), (20, 10), (10, 10), (0, 10))
_COUNTS = "column_no int, parent long, child long, n long, low long, high long"


def order_images(values: np.ndarray) -> np.ndarray:
    """Signed 64-bit integers in the order of the doubles; NaN above all, both zeros alike."""
    bits = (np.where(np.isnan(values), np.nan, values) + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def image_value(image: int) -> float:
    bits = np.int64(image)
    return float((bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))).view(np.float64))


def _prefix_counts(open_prefixes: dict[int, list[int | None]], shift: int, bits: int, above: int):
    """A task's counts of the values below the open prefixes, ``bits`` bits further down.

    ``open_prefixes`` lists them per column as values shifted right by ``above``; None stands for all values.
    """
    size = 1 << bits

    def counted(batches):
        counts, lows, highs = {}, {}, {}
        for batch in batches:
            for place, (column, parents) in enumerate(open_prefixes.items()):
                values = batch.column(place).drop_null().to_numpy(zero_copy_only=False)
                images, times = np.unique(order_images(values), return_counts=True)
                for parent in parents:
                    if parent is None:
                        found, n, first = images, times, -(size >> 1)
                    else:
                        a = np.searchsorted(images, parent << above)
                        b = np.searchsorted(images, (parent << above) + ((1 << above) - 1), side="right")
                        found, n, first = images[a:b], times[a:b], parent << bits
                    if not len(found):
                        continue
                    child = (found >> shift) - first
                    starts = np.flatnonzero(np.r_[True, child[1:] != child[:-1]])
                    ends = np.r_[starts[1:], len(child)] - 1
                    key = column, parent
                    if key not in counts:
                        counts[key] = np.zeros(size, np.int64)
                        lows[key] = np.full(size, np.iinfo(np.int64).max)
                        highs[key] = np.full(size, np.iinfo(np.int64).min)
                    at = child[starts]
                    counts[key][at] += np.add.reduceat(n, starts)
                    lows[key][at] = np.minimum(lows[key][at], found[starts])
                    highs[key][at] = np.maximum(highs[key][at], found[ends])
        for (column, parent), n in counts.items():
            at = np.flatnonzero(n)
            first = -(size >> 1) if parent is None else parent << bits
            yield pa.RecordBatch.from_pydict({
                "column_no": np.full(len(at), column, np.int32),
                "parent": np.full(len(at), parent or 0, np.int64),
                "child": at + first, "n": n[at],
                "low": lows[column, parent][at], "high": highs[column, parent][at],
            })

    return counted


def order_statistics(df: DataFrame, ranks: dict[str, Sequence[int]]) -> dict[tuple[str, int], float]:
    """The values at 0-based ranks among the non-null values of each column, in ascending order."""
    columns = [c for c, wanted in ranks.items() if wanted]
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    found: dict[tuple[str, int], float] = {}
    # (column, rank) -> (prefix, rank among the values below it)
    pending = {(i, r): (None, r) for i, c in enumerate(columns) for r in set(ranks[c])}
    above = 64
    for shift, bits in _PASSES:
        if not pending:
            break
        parents: dict[int, list[int | None]] = {}
        for i, p in sorted({(i, p) for (i, _), (p, _) in pending.items()}, key=lambda x: (x[0], x[1] or 0)):
            parents.setdefault(i, []).append(p)
        seen = values.select(*[f"c{i}" for i in parents]).mapInArrow(
            _prefix_counts(parents, shift, bits, above), _COUNTS
        ).groupBy("column_no", "parent", "child").agg(
            F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))
        upto = Window.partitionBy("column_no", "parent").orderBy("child")
        running = seen.withColumn("upto", F.sum("n").over(upto))
        # As many rows as there are ranks asked for.
        asked = df.sparkSession.createDataFrame(
            [(i, p or 0, r, left) for (i, r), (p, left) in pending.items()],
            "column_no int, parent long, rank long, left long")
        hits = running.join(F.broadcast(asked), ["column_no", "parent"]).filter(
            "left < upto AND left >= upto - n")
        following = {}
        for row in hits.collect():
            key = row["column_no"], row["rank"]
            if row["low"] == row["high"]:
                found[columns[key[0]], key[1]] = image_value(row["low"])
            else:
                following[key] = (row["child"], row["left"] - (row["upto"] - row["n"]))
        if len(following) + len(found) < sum(len(set(ranks[c])) for c in columns):
            raise ValueError("a rank exceeds the number of values of its column")
        pending, above = following, shift
    return found


def exact_percentiles(
    df: DataFrame,
    columns: Sequence[str],
    fractions: Sequence[float],
    *,
    approximate: bool = False,
) -> dict[str, list[float | None]]:
    """Linear-interpolated percentiles of each column's non-null values; None for an all-null one.

    NaN counts as the largest value. The table is read once for the counts and up to six times for the
    values: give it as a stored one. ``approximate=True`` settles for a sketch: one pass, not exact.
    """
    columns = list(columns)
    fractions = list(fractions)
    if not columns:
        return {}
    if approximate:
        row = df.agg(*[
            F.percentile_approx(F.col(f"`{c}`").cast("double"), fractions, _ACCURACY).alias(f"v{i}")
            for i, c in enumerate(columns)
        ]).first()
        return {c: list(row[f"v{i}"] or [None] * len(fractions)) for i, c in enumerate(columns)}

    sizes = df.agg(*[
        F.count(F.col(f"`{c}`").cast("double")).alias(f"n{i}") for i, c in enumerate(columns)
    ]).first()
    places = {c: [f * (n - 1) for f in fractions] if n else [] for c, n in zip(columns, sizes)}
    found = order_statistics(df, {
        c: [edge for p in wanted for edge in (math.floor(p), math.ceil(p))] for c, wanted in places.items()
    })

    def between(column: str, place: float) -> float:
        low, high = math.floor(place), math.ceil(place)
        a, b = found[column, low], found[column, high]
        return a if a == b or low == high else (high - place) * a + (place - low) * b

    return {
        c: [between(c, p) for p in places[c]] if places[c] else [None] * len(fractions) for c in columns
    }
