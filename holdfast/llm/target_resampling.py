"""Importance resampling towards a target: bucketed word runs, gains per bucket, and a weighted draw without replacement."""

from __future__ import annotations

import math
import zlib

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import batch_of, small_batches, worker_memory
from holdfast.session import stage_table

BUCKETS, SMOOTHING, SCALE = 10_000, 1, 1000
SLICE_CHARS = 1 << 20
#: ASCII letters in lower case, digits and everything beyond ASCII make words.
WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
LOWER = {c: c + 32 for c in range(65, 91)}


def word_splitter(pattern: str = WORDS):
    """A function from a text to the offsets [(start, end), ...] of its words, by the tokenizers library, untrained."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    memory = worker_memory()
    if ("word_splitter", pattern) not in memory:
        memory["word_splitter", pattern] = Split(Regex(pattern), "removed", invert=True)
    split = memory["word_splitter", pattern].pre_tokenize_str

    def offsets(text: str) -> list[tuple[int, int]]:
        return [place for _, place in split(text)]

    return offsets


def text_slices(text: str, size: int = SLICE_CHARS):
    """``text`` in slices of about ``size`` characters, none of which ends inside a word of ``WORDS``."""
    start = 0
    while len(text) - start > size:
        end = start + size
        while end < len(text) and (text[end].isdigit() or text[end].islower() or text[end] > "\x7f"):
            end += 1
        yield text[start:end]
        start = end
    yield text[start:]


def run_buckets(text: str, longest: int, buckets: int):
    """(words, run_buckets): how many words the whole text has, and the bucket of every run of 1 to ``longest`` of them.

    A run's words are joined by one space; pairs of offsets, first word's start and last word's end, give
    its bytes.
    """
    import numpy as np

    offsets = word_splitter()
    total, carried, found = 0, [], []
    for piece in text_slices(text.translate(LOWER)):
        words = [piece[a:b].encode() for a, b in offsets(piece)]
        total += len(words)
        old, words = len(carried), carried + words
        line = memoryview(b" ".join(words))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        ends = (np.cumsum(sizes + 1) - 1).tolist()
        starts = (np.array(ends, np.int64) - sizes).tolist()
        for n in range(1, longest + 1):
            first = max(old - n + 1, 0)  # runs that end in the slice before were counted there
            windows = zip(starts[first:], ends[first + n - 1:])
            found.append(np.fromiter((zlib.crc32(line[a:b]) for a, b in windows), np.int64) % buckets)
        carried = words[len(words) - longest + 1:] if longest > 1 else []
    return total, np.concatenate(found) if found else np.zeros(0, np.int64)


def bucket_counts(docs: DataFrame, key: str, longest: int = 1, buckets: int = BUCKETS) -> DataFrame:
    """(key, n_words, n_features, at, buckets, counts): the bucket histogram of every whole text, stored.

    ``at`` tells rows apart that share a key. A null text has no words.
    """
    import pyarrow as pa

    schema = pa.schema([(key, pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()),
                        ("buckets", pa.list_(pa.int32())), ("counts", pa.list_(pa.int64()))])

    def count(batches):
        import numpy as np

        for batch in batches:
            rows = []
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words, found = run_buckets(text.as_py() or "", longest, buckets)
                names, counts = np.unique(found, return_counts=True)
                rows.append((name, words, len(found), names, counts))
                if len(rows) == 256:
                    yield batch_of(rows, schema)
                    rows = []
            if rows:
                yield batch_of(rows, schema)

    texts = small_batches(docs.select(F.col(key).cast("long").alias(key), "text"))
    counted = texts.mapInArrow(
        count, f"`{key}` long, n_words long, n_features long, buckets array<int>, counts array<long>")
    return stage_table(counted.withColumn("at", F.monotonically_increasing_id()), "buckets")


def histogram(counted: DataFrame) -> dict[int, int]:
    """Features per bucket over all rows; as many entries as there are buckets, at most."""
    flat = counted.select(F.inline(F.arrays_zip("buckets", "counts")))
    return {r["buckets"]: r["n"] for r in flat.groupBy("buckets").agg(F.sum("counts").alias("n")).collect()}


def bucket_gains(source: dict[int, int], target: dict[int, int], buckets: int = BUCKETS) -> list[int]:
    """floor(1000 ln of the target's smoothed share over the source's) of every bucket."""
    s_all, t_all = sum(source.values()) + SMOOTHING * buckets, sum(target.values()) + SMOOTHING * buckets
    return [
        math.floor(SCALE * math.log((target.get(b, 0) + SMOOTHING) * s_all
                                    / ((source.get(b, 0) + SMOOTHING) * t_all)))
        for b in range(buckets)
    ]


def scored(counted: DataFrame, key: str, gains: list[int], seed: int) -> DataFrame:
    """(key, n_words, n_features, at, weight, score): summed gains, and with Gumbel noise drawn from the key's hash.

    Adding Gumbel noise and keeping the highest draws without replacement in proportion to exp(weight / 1000).
    The gains travel as a broadcast of one number a bucket. A null key is hashed as ``null``.
    """
    import pyarrow as pa

    shared = counted.sparkSession.sparkContext.broadcast(gains)

    def weigh(batches):
        import hashlib

        import numpy as np

        gain = np.array(shared.value, np.int64)

        def noise(name) -> int:
            digits = hashlib.sha256(f"{seed}:{'null' if name is None else name}".encode()).hexdigest()[:8]
            return math.floor(-SCALE * math.log(-math.log((int(digits, 16) + 0.5) / 4294967296)))

        for batch in batches:
            names, counts = batch.column(4), batch.column(5)
            products = gain[names.flatten().to_numpy()] * counts.flatten().to_numpy()
            sums = np.concatenate([[0], np.cumsum(products)])
            ends = np.cumsum([0, *(len(x) for x in names)])
            weight = sums[ends[1:]] - sums[ends[:-1]]
            score = weight + np.array([noise(name) for name in batch.column(0).to_pylist()], np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(weight, pa.int64()), pa.array(score, pa.int64())],
                names=[key, "n_words", "n_features", "at", "weight", "score"])

    rows = counted.select(key, "n_words", "n_features", "at", "buckets", "counts")
    return small_batches(rows).mapInArrow(
        weigh, f"`{key}` long, n_words long, n_features long, at long, weight long, score long")


def resample(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", longest: int = 1, buckets: int = BUCKETS,
    percent: int = 10, min_words: int = 20, seed: int = 2024,
) -> DataFrame:
    """(key, n_features, weight, score, rank): every row of ``docs``, weighed by how much its words are those of ``target``.

    Features are runs of 1 to ``longest`` words of the whole ASCII-lowered text, repeats counted, each in
    the bucket of its CRC-32. Of the rows with ``min_words`` words or more, the ``percent`` percent with
    the highest scores are drawn and ranked from 1, ties to the smaller key (null keys last, then in any
    order); others have no rank. Rows are sorted once, by ranges of all they are ordered by, so that
    many equal scores or keys spread. Repeated rows are rows like others, null and empty texts weigh 0, an empty
    ``target`` gives every bucket its smoothed share, other columns take no part. No rows: no rows.
    """
    counted = bucket_counts(docs, key, longest, buckets)
    wanted = bucket_counts(target.select(F.lit(0).alias(key), "text"), key, longest, buckets)
    gains = bucket_gains(histogram(counted), histogram(wanted), buckets)
    rows = scored(counted, key, gains, seed).withColumn("able", F.col("n_words") >= min_words)
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("able").desc(), F.col("score").desc(), F.col(key).asc_nulls_last(), F.col("at").asc()]
    stored = stage_table(rows, "scores")
    placed = stage_table(
        stored.repartitionByRange(parts, *order).sortWithinPartitions(*order)
        .withColumn("place", F.monotonically_increasing_id()), "places")
    part = F.shiftright("place", 33)
    sizes = placed.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.count_if("able").alias("able_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    bases = sizes.select(  # one row a partition
        "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
        F.floor(F.sum("able_n").over(everything) * percent / 100).alias("drawn"))
    rank = F.col("base") + F.col("place").bitwiseAND((1 << 33) - 1) + 1
    return placed.join(F.broadcast(bases), part == F.col("part")).select(
        key, "n_features", "weight", "score",
        F.when(F.col("able") & (rank <= F.col("drawn")), rank).alias("rank"))
