"""Near duplicates by SimHash: fingerprints in tiles of equal bit counts, tile against tile."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import connected_components, small_batches
from holdfast.session import stage_table

SHINGLE, SEED, RADIUS = 3, 42, 2
SECTIONS = 4
TILE_ROWS = 2048


def fingerprints(docs: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, *keep, fp long): 64 bits of every whole text.

    A-Z are lower-cased and the text is cut at ASCII white space; all runs of three words count, repeats included
    (fewer words: the whole sequence). A bit is set if it is set in over half of the XXH64
    hashes. Null, empty and blank texts have fingerprint zero.
    """
    import pyarrow as pa

    def hashed(batches):
        from itertools import repeat

        import numpy as np
        from xxhash import xxh64_intdigest

        def bits(text: str | None) -> int:
            words = (text or "").encode().lower().split()
            if not words:
                return 0
            if len(words) < SHINGLE:
                runs = [b" ".join(words)]
            else:
                runs = list(map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)))))
            h = np.fromiter(map(xxh64_intdigest, runs, repeat(SEED)), np.uint64, len(runs))
            counts = np.zeros(64, np.int64)
            for part in range(0, len(h), 65536):
                planes = h[part: part + 65536].view(np.uint8).reshape(-1, 8)
                counts += np.unpackbits(planes, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            majority = np.packbits(counts * 2 > len(h), bitorder="little")
            return int(majority.view(np.int64)[0])

        for batch in batches:
            found = [bits(text.as_py()) for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:], pa.array(found, pa.int64())],
                names=["doc_id", *keep, "fp"],
            )

    texts = docs.select(F.col("doc_id").cast("long"), "text", *keep)
    kept = "".join(f"{name} string, " for name in keep)
    return small_batches(texts).mapInArrow(hashed, f"doc_id long, {kept}fp long")


def _section_counts(fp: str) -> list:
    width = 64 // SECTIONS
    mask = F.lit((1 << width) - 1)
    return [
        F.bit_count(F.shiftrightunsigned(fp, width * i).bitwiseAND(mask)) for i in range(SECTIONS)
    ]


def _shifts(radius: int) -> list[tuple[int, ...]]:
    """Differences of tile names within the radius, one of each pair of opposite ones."""
    steps = itertools.product(range(-radius, radius + 1), repeat=SECTIONS)
    return [s for s in steps if sum(map(abs, s)) <= radius and s >= (0,) * SECTIONS]


def tile_links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(src, dst): links that join all ``fp`` within ``radius`` bits of each other, directly or over others.

    A tile holds the fingerprints with the same bit counts in each of four sections. Two fingerprints
    differ in at least as many bits as those counts do, so tiles farther apart than the radius are skipped;
    all others are compared whole by exclusive-or and bit counts. A tile is cut into blocks of about
    ``TILE_ROWS``, and a pair of blocks returns a forest of its links, not all of them: rows out are at
    most rows in.
    """
    import pyarrow as pa

    width = 64 // SECTIONS + 1
    base = [width**i for i in reversed(range(SECTIONS))]
    tiled = distinct.withColumn("p", F.array(*_section_counts("fp")))
    tiled = tiled.withColumn("tile", sum(F.col("p")[i] * base[i] for i in range(SECTIONS)))
    sizes = tiled.groupBy("tile").count()  # at most (64 / SECTIONS + 1) ** SECTIONS rows
    cut = F.pmod(F.xxhash64("fp"), F.ceil(F.col("count") / TILE_ROWS))
    blocks = stage_table(
        tiled.join(F.broadcast(sizes), "tile").withColumn("block", cut)
        .groupBy("tile", "block").agg(F.collect_list("fp").alias("fps")), "tiles",
    )
    steps = F.array(*[
        F.struct(F.array(*map(F.lit, s)).alias("step"),
                 F.lit(sum(x * b for x, b in zip(s, base))).alias("shift"))
        for s in _shifts(radius)
    ])
    digits = F.array(*[
        F.pmod(F.floor(F.col("tile") / b), F.lit(width)).cast("int") for b in base
    ])
    inside = F.forall(F.zip_with("digits", "step", lambda a, b: a + b),
                      lambda x: x.between(0, width - 1))
    left = (
        blocks.withColumn("digits", digits).select("*", F.inline(steps)).filter(inside)
        .select((F.col("tile") + F.col("shift")).alias("tile"), F.col("block").alias("left_block"),
                F.col("fps").alias("left_fps"), (F.col("shift") == 0).alias("same"))
    )
    pairs = left.join(blocks, "tile").filter("not same or left_block <= block").select(
        "left_fps", "fps", (F.col("same") & (F.col("left_block") == F.col("block"))).alias("own")
    )

    def compared(batches):
        import numpy as np

        def matches(a, b):
            for i in range(0, len(a), 512):
                near = np.bitwise_count(a[i: i + 512, None] ^ b[None, :]) <= radius
                x, y = np.nonzero(near)
                yield x + i, y

        def forest(a, b, own):
            found = list(matches(a, b))
            x = np.concatenate([f[0] for f in found])
            y = np.concatenate([f[1] for f in found])
            if own:
                x, y = x[x < y], y[x < y]
            if not len(x):
                return None
            names = np.concatenate([a, b])
            if not own:
                y = y + len(a)
            low = np.arange(len(names))
            while True:
                least = np.minimum(low[x], low[y])
                before = low.copy()
                np.minimum.at(low, x, least)
                np.minimum.at(low, y, least)
                low = low[low]
                if (low == before).all():
                    break
            hang = np.nonzero(low != np.arange(len(names)))[0]
            return names[hang], names[low[hang]]

        for batch in batches:
            left_all, right_all = batch.column(0), batch.column(1)
            found = []
            for a, b, own in zip(left_all, right_all, batch.column(2).to_pylist()):
                links = forest(a.values.to_numpy().view(np.uint64),
                               b.values.to_numpy().view(np.uint64), own)
                if links is not None:
                    found.append(links)
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(side).view(np.int64)) for side in zip(*found)],
                    names=["src", "dst"],
                )

    return small_batches(pairs).mapInArrow(compared, "src long, dst long")


def _groups(docs: DataFrame, radius: int, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, fp, *keep, component, component_id): ``component`` names the group even without ids."""
    marked = stage_table(fingerprints(docs, keep), "fingerprints")
    nodes = marked.groupBy("fp").agg(F.min("doc_id").alias("low"))
    groups = connected_components(tile_links(nodes.select("fp"), radius))
    labelled = nodes.join(groups.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "component", F.coalesce("component", "fp")
    )
    lowest = labelled.groupBy("component").agg(F.min("low").alias("component_id"))
    named = labelled.join(lowest, "component").select("fp", "component", "component_id")
    return marked.join(named, "fp")


def simhash_groups(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fp, component_id): one row for every row of ``docs``.

    ``component_id`` is the smallest ``doc_id`` that links reach; rows without an id get it too, and it
    is null only where no row of the group has an id. Equal fingerprints are one node of the graph, so
    copies never meet pair by pair. Columns other than ``doc_id`` and ``text`` take no part. No rows:
    no rows.
    """
    return _groups(docs, radius).select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, radius: int = RADIUS) -> DataFrame:
    """One row of every group, with the columns of ``docs``.

    The row with the smallest ``doc_id`` stays (rows without an id come last); of rows that share it,
    the one with the smallest hash of its text and then the smallest other columns.
    """
    content = F.md5(F.coalesce("text", F.lit("")))
    row = F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), content))
    others = F.struct(F.lit(0).alias("none"), *[
        F.col(c) for c in docs.columns if c not in ("doc_id", "text")])
    keyed = docs.select("doc_id", "text", row.alias("row"), others.alias("others"),
                        F.struct(*docs.columns).alias("doc"))
    order = F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("id"), "row")
    chosen = (
        _groups(keyed, radius, ("row",)).groupBy("component").agg(F.min(order).alias("first"))
        .select(F.col("first.row").alias("row"))
    )
    same = Window.partitionBy("row").orderBy("others")
    return (
        keyed.join(chosen, "row", "left_semi").withColumn("n", F.row_number().over(same))
        .filter("n = 1").select("doc.*")
    )
