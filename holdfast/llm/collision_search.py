"""Approximate nearest neighbours by collision counting over sorted projections."""

from __future__ import annotations

import contextlib

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from holdfast.session import stage_table

BLOCK_ROWS, QUERY_ROWS = 8192, 512
ROTATIONS, WIDTH, GROWTH, FIRST_RADIUS, MISS_SIGMAS = 2, 0.6745, 1.2, 0.5, 2.0
GRID, CHUNK_WORDS = 128, 24576  # steps of a sorted projection; words of a bit set held at once
_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextlib.contextmanager
def rows_a_batch(spark: SparkSession, rows: int):
    """Holds Arrow batches to ``rows`` rows for what runs inside; rows of packed vectors are large."""
    before = spark.conf.get(_SETTING, None)
    spark.conf.set(_SETTING, str(rows))
    try:
        yield
    finally:
        spark.conf.unset(_SETTING) if before is None else spark.conf.set(_SETTING, before)


def usable(vector: str) -> Column:
    """True where a vector is not null, not zero, and all its components are finite."""
    infinite = F.lit(float("inf"))
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == infinite))
    some = F.exists(vector, lambda x: x != 0)
    return F.coalesce(~bad & some, F.lit(False))


def projections(dimension: int, rotations: int = ROTATIONS, seed: int = 17):
    """Random orthonormal directions, ``rotations`` full sets of them, scaled to unit variance."""
    import numpy as np

    rng = np.random.default_rng([seed, dimension])
    sets = [np.linalg.qr(rng.standard_normal((dimension, dimension)))[0] for _ in range(rotations)]
    return np.concatenate(sets, axis=1) * dimension**0.5


class SortedLines:
    """The sorted projections of a block; where a window lies between grid places, its rows are a bit set.

    ``prefix[j, g]`` has a bit for each of the first ``g * step`` rows of projection ``j``, so the rows of a window
    are two prefixes apart, and windows of all projections are added up bit by bit. Places are rounded to the
    nearest grid place; the grid has ``GRID`` steps at any size of block.
    """

    def __init__(self, unit, axes):
        import numpy as np

        n, self.m = len(unit), axes.shape[1]
        spots = np.ascontiguousarray((unit @ axes).T)
        order = np.argsort(spots, axis=1, kind="stable")
        step = max(1, -(-n // GRID))
        self.words, steps = -(-n // 64), -(-n // step)
        # A value lies at the grid place whose middle it has passed.
        self.middles = np.take_along_axis(spots, order, axis=1)[:, step // 2::step].copy()
        group = np.arange(n) // step
        self.prefix = np.zeros((self.m, steps + 1, self.words), np.uint64)
        width = self.words * 8
        for j, rows in enumerate(order):
            # Bits of one byte differ, so their sum is their union.
            own = np.bincount(group * width + (rows >> 3), weights=1 << (rows & 7), minlength=steps * width)
            own = own.astype(np.uint8).reshape(steps, width).view(np.uint64)
            np.bitwise_or.accumulate(own, axis=0, out=self.prefix[j, 1:])

    def collided(self, centres, reach: float, need: int):
        """Bit sets of the rows that fall within ``reach`` of each centre in ``need`` projections or more."""
        import numpy as np

        shape = (len(centres), self.words)
        # planes[i]: bit i of every row's count; waiting[i]: a carry of weight 2**i that has no partner yet.
        planes = [np.zeros(shape, np.uint64) for _ in range(self.m.bit_length() + 1)]
        waiting = [None] * (len(planes) + 1)
        for j in range(self.m + self.m % 2):
            if j < self.m:
                places = self.middles[j].searchsorted(centres[:, j] + [[reach], [-reach]])
                window = self.prefix[j].take(places[0], axis=0)
                window ^= self.prefix[j].take(places[1], axis=0)
            else:
                window = np.zeros(shape, np.uint64)
            level = 0
            while waiting[level] is not None:
                other, waiting[level], plane = waiting[level], None, planes[level]
                half = other ^ window
                other &= window
                window = half & plane
                window |= other
                plane ^= half
                level += 1
            waiting[level] = window
        for level, carry in enumerate(waiting):
            while carry is not None and level < len(planes):
                carry, planes[level], level = carry & planes[level], carry ^ planes[level], level + 1
                carry = carry if carry.any() else None
        enough = np.full(shape, ~np.uint64(0))
        for i, plane in enumerate(planes):
            enough = enough & plane if need >> i & 1 else enough | plane
        return enough


def search_block(ids, vectors, query_ids, queries, k: int):
    """(query_id, vec_id, score) of the ``k`` nearest of a block for every query.

    Every projection is a sorted array. A window around the query's place grows with the radius; a
    vector met in enough windows is compared exactly. At radius r a vector that lies at distance r falls in each
    window with probability one half, and the threshold is set two deviations below that. The search ends at the
    first radius that covers the k-th best vector found, or when every vector was compared.
    """
    import numpy as np

    vectors, queries = vectors.astype(np.float64), queries.astype(np.float64)
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    query_norms = np.sqrt((queries * queries).sum(axis=1))
    axes = projections(vectors.shape[1])
    lines = SortedLines(vectors / norms[:, None], axes)
    centres = (queries / query_norms[:, None]) @ axes
    m = axes.shape[1]
    need = max(0, int(np.ceil(m * 0.5 - MISS_SIGMAS * (m * 0.16) ** 0.5)))
    chunk = max(1, CHUNK_WORDS // lines.words)
    out = []
    for start in range(0, len(queries), chunk):
        asks = np.arange(start, min(start + chunk, len(queries)))
        todo = query_ids[asks][:, None] != ids[None, :]
        found = {q: (np.zeros(0, np.int64), np.zeros(0)) for q in asks}
        radius = FIRST_RADIUS
        while len(asks):
            if radius < 2.0:
                bits = lines.collided(centres[asks], WIDTH * radius, need).view(np.uint8)
                fresh = np.unpackbits(bits, axis=1, count=len(ids), bitorder="little").view(bool) & todo
            else:
                fresh = todo.copy()
            todo &= ~fresh
            going = []
            for i, q in enumerate(asks):
                rows = np.flatnonzero(fresh[i])
                score = (vectors[rows] * queries[q]).sum(axis=1) / (norms[rows] * query_norms[q])
                rows, score = np.append(found[q][0], rows), np.append(found[q][1], score)
                best = np.lexsort((ids[rows], -score))[:k]
                found[q] = rows[best], score[best]
                covered = len(best) == k and 2 - 2 * score[best[-1]] <= radius * radius
                if not covered and radius < 2.0:
                    going.append(i)
            asks, todo, radius = asks[going], todo[going], radius * GROWTH
        out += [(np.full(len(rows), query_ids[q]), ids[rows], score) for q, (rows, score) in found.items() if len(rows)]
    return out


def nearest(embeddings: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest other rows of every row for which ``is_query`` holds.

    Nearness is the cosine of the original vectors in double precision, ties go to the smaller vec_id.
    Vectors that are null, zero or not finite, and rows without vec_id, take no part; vectors of different lengths
    are not compared; rows that repeat count once. Of copies of one vector only the ``k + 1`` smallest ids can be among
    the k nearest of anything, so only these are searched. All vectors are split into blocks by hash, the queries
    into packets, and each packet visits each block. Other columns take no part. No queries: no rows.
    """
    import numpy as np
    import pyarrow as pa

    spark = embeddings.sparkSession
    rows = stage_table(
        embeddings.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<float>"),
                          F.coalesce(is_query, F.lit(False)).alias("asks"))
        .filter(F.col("vec_id").isNotNull() & usable("embedding")).distinct()
        .withColumn("dim", F.size("embedding")), "vectors",
    )
    sizes = rows.groupBy("dim").agg(
        F.greatest(F.lit(1), F.ceil(F.count("*") / BLOCK_ROWS)).alias("blocks"),
        F.greatest(F.lit(1), F.ceil(F.count(F.when(F.col("asks"), 1)) / QUERY_ROWS)).alias("packets"),
    )
    copies = Window.partitionBy("embedding").orderBy("vec_id")
    kept = rows.withColumn("_n", F.row_number().over(copies)).filter(F.col("_n") <= k + 1)

    def packed(df: DataFrame, name: str, key: str) -> DataFrame:
        number = F.pmod(F.xxhash64("vec_id", F.lit(name)), F.col(key))
        return (
            df.join(F.broadcast(sizes), "dim").withColumn(name, number)  # a row for each vector length
            .groupBy("dim", name, key).agg(
                F.collect_list("vec_id").alias(f"{name}_ids"),
                F.flatten(F.collect_list("embedding")).alias(f"{name}_vectors"))
        )

    blocks = packed(kept, "block", "blocks")
    packets = packed(rows.filter("asks"), "packet", "packets")
    counts = F.broadcast(sizes.select("dim", "blocks"))
    visits = packets.join(counts, "dim").withColumn(
        "block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    )
    pairs = visits.drop("blocks").join(blocks.drop("blocks"), ["dim", "block"]).select(
        "dim", "block_ids", "block_vectors", "packet_ids", "packet_vectors"
    )

    def searched(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                dim = batch.column(0)[i].as_py()
                cell = [batch.column(c)[i].values.to_numpy(zero_copy_only=False) for c in range(1, 5)]
                found = search_block(cell[0], cell[1].reshape(-1, dim), cell[2],
                                     cell[3].reshape(-1, dim), k)
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(side)) for side in zip(*found)],
                        names=["query_id", "vec_id", "score"],
                    )

    with rows_a_batch(spark, 4):
        local = stage_table(
            pairs.mapInArrow(searched, "query_id long, vec_id long, score double"), "block_neighbours"
        )
    best = local.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
