"""Mixing sources to target weights: fixed-length blocks, drawn by shard, found by permuted index.

DataFrame functions only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import parts_for, running_start
from holdfast.session import stage_table

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS, SHARE, MOST = (5.0, 2.0, 1.0), 1.5, 2.0
BLOCK, SHARD_SLOTS, ROUNDS, _CHUNK = 32, 4096, 6, 8192
PRIMES = (6291469, 12582917, 3145739)


def word_count(text: Column | str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def permuted(df: DataFrame, index: str, n: str, salts: Sequence[Column], rounds: int = ROUNDS) -> DataFrame:
    """``df`` with ``index`` (0 to n - 1) sent through a pseudorandom permutation of 0 to n - 1.

    First x becomes (ax + b) mod n, which spreads neighbours over the whole range. Then rounds of
    swap-or-not: each pairs x with (k - x) mod n and swaps or keeps the two as a hash of the larger
    one says. Every step is a permutation for any n, as no a divides it; n may reach 2**39.
    """
    def swapped(x: Column, r: Column) -> Column:
        mate = F.pmod(F.pmod(F.xxhash64(*salts, r), F.col(n)) - x, F.col(n))
        swap = F.xxhash64(F.greatest(mate, x), *salts, r, F.lit("swap")) < 0
        return F.when(swap, mate).otherwise(x)

    factor = F.coalesce(*[F.when(F.col(n) % p != 0, F.lit(p)) for p in PRIMES]).cast("long")
    start = F.pmod(F.col(index).cast("long") * factor + F.pmod(F.xxhash64(*salts), F.col(n)), F.col(n))
    return df.withColumn(index, F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, swapped))


def targets(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, share: float = SHARE,
            most: float = MOST) -> DataFrame:
    """``sizes`` (source_key, source_size) with ``target``: the words each source should give.

    Sources are ranked by code point, null last, and weigh ``weights`` in turn. Together they should give ``share``
    times all words, each at most ``most`` times its own, the excess being shared anew by weight.
    In the order of size per weight the sources that stop at their limit come first, so running sums
    tell which those are. Where limits leave less than asked, all sources give their limit.
    """
    # One row a source: windows over all of them see sources, not documents.
    ranked = sizes.withColumn(
        "rank", F.row_number().over(Window.orderBy("source_key")) - 1
    )
    turn = F.array(*map(F.lit, map(float, weights)))
    weighed = ranked.withColumn("weight", turn[(F.col("rank") % len(weights)).cast("int")])
    limit = F.lit(float(most)) * F.col("source_size")
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.orderBy(F.lit(0)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    summed = weighed.select(
        "*", F.sum(limit).over(upto).alias("_given"), F.sum("weight").over(upto).alias("_weight"),
        (F.sum("source_size").over(whole) * F.lit(float(share))).alias("_all"),
        F.sum("weight").over(whole).alias("_weights"),
    )
    # With the sources before this one at their limits, what is left is shared by weight.
    left = F.col("_all") - (F.col("_given") - limit)
    weight_left = F.col("_weights") - (F.col("_weight") - F.col("weight"))
    stops = limit * weight_left <= left * F.col("weight")
    # After the first source below its limit this can only fall, so its largest value is that one's.
    level = F.when(~stops, left / weight_left)
    first = F.max(level).over(whole)
    return summed.withColumn("_stops", stops).select(
        "source_key", "source_size", "rank", "weight",
        F.when(F.col("_stops"), limit).otherwise(F.col("weight") * first).alias("target"),
    )


def lay_out(docs: DataFrame, seed: int = 0, keep: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """(rows, sources): documents laid end to end within their source in a pseudorandom order.

    rows: doc_id, source_key, size, start, *keep. sources: source_key, source_size, target, blocks,
    quota (slots it gets), first_slot.
    """
    rows = docs.select(
        F.col("doc_id").cast("long"), word_count("text").alias("size"),
        F.when(F.col("source").isNull(), F.lit("n"))
        .otherwise(F.concat(F.lit("a"), F.col("source").cast("string"))).alias("source_key"), *keep,
    )
    rows = stage_table(rows, "sizes")
    sizes = rows.groupBy("source_key").agg(F.sum("size").alias("source_size"))
    blocks = F.ceil(F.col("source_size") / BLOCK).cast("long")
    quota = F.coalesce(F.round(F.col("target") / F.col("source_size") * blocks), F.lit(0)).cast("long")
    before = Window.orderBy("rank").rowsBetween(Window.unboundedPreceding, -1)
    sources = stage_table(
        targets(sizes).withColumn("blocks", blocks).withColumn("quota", quota)
        .withColumn("first_slot", F.coalesce(F.sum("quota").over(before), F.lit(0)))
        .withColumn("slots", F.sum("quota").over(Window.orderBy(F.lit(0)).rowsBetween(
            Window.unboundedPreceding, Window.unboundedFollowing))), "sources",
    )
    order = [F.xxhash64("doc_id", "size", F.lit(seed)), F.col("doc_id"), F.col("size"),
             *[F.col(c) for c in keep]]
    return running_start(rows, ["source_key"], F.col("size"), order), sources


def slots(sources: DataFrame, seed: int = 0) -> DataFrame:
    """(shard, slot, source_key, epoch, block): the mix, one row a slot of ``BLOCK`` words.

    The slots of all shards are a permutation of the sources' quotas. So the counts of sources in a
    shard are a multinomial draw at the target shares, given that all shards together meet the targets.
    The k-th slot of a source holds its block at place k of a permutation of the source's blocks, a
    new one for every pass over the source.
    """
    total = sources.agg(F.max("slots")).first()[0] or 0
    chunks = sources.filter("quota > 0").withColumn(
        "chunk", F.explode(F.sequence(F.lit(0).cast("long"), F.col("quota") - 1, F.lit(_CHUNK).cast("long")))
    ).repartition(parts_for(sources.sparkSession, int(total)), "source_key", "chunk")
    drawn = chunks.withColumn("k", F.explode(
        F.sequence("chunk", F.least(F.col("chunk") + _CHUNK, F.col("quota")) - 1)
    ))
    drawn = drawn.select(
        "source_key", "blocks", "slots", (F.col("first_slot") + F.col("k")).alias("slot"),
        F.floor(F.col("k") / F.col("blocks")).alias("epoch"), (F.col("k") % F.col("blocks")).alias("block"),
    )
    drawn = permuted(drawn, "slot", "slots", [F.lit(seed)])
    drawn = permuted(drawn, "block", "blocks", [F.col("source_key"), F.col("epoch"), F.lit(seed)])
    return drawn.select(
        F.floor(F.col("slot") / SHARD_SLOTS).alias("shard"), "slot", "source_key", "epoch", "block"
    )


def _spread(rows: DataFrame) -> DataFrame:
    """A row for every block that a document reaches into."""
    last = F.floor((F.col("start") + F.col("size") - 1) / BLOCK)
    return rows.filter("size > 0").withColumn(
        "block", F.explode(F.sequence(F.floor(F.col("start") / BLOCK), last))
    )


def taken_words(docs: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, size, source_size, target, taken): how many words of every document the mix takes.

    One row for every row of ``docs``. Null, empty and blank texts have size 0 and give nothing; a
    null source is a source of its own, ranked last. Rows that repeat are documents of their own.
    Other columns take no part. Every run gives the same mix, however rows are partitioned.
    """
    rows, sources = lay_out(docs, seed)
    rows = stage_table(rows, "laid")
    times = slots(sources, seed).groupBy("source_key", "block").agg(F.count("*").alias("times"))
    low = F.greatest("start", F.col("block") * BLOCK)
    high = F.least(F.col("start") + F.col("size"), (F.col("block") + 1) * BLOCK)
    taken = (
        _spread(rows).join(times.hint("merge"), ["source_key", "block"], "left")
        .groupBy("doc_id", "source_key", "size", "start")
        .agg(F.sum((high - low) * F.coalesce("times", F.lit(0))).alias("taken"))
    )
    every = taken.select("doc_id", "source_key", "size", "taken").union(
        rows.filter("size = 0").select("doc_id", "source_key", "size", F.lit(0).cast("long"))
    )
    return every.join(sources.select("source_key", "source_size", "target"), "source_key").select(
        "doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken")
    )


def mixed_documents(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mix as documents, with the columns of ``docs``: a row for every pass that takes words of a document.

    A pass that takes a document whole repeats its row as it is. Where it takes some blocks only, ``text`` holds
    their words, joined by spaces, and ``n_chars`` is counted anew. Documents without words are not part
    of a mix. Of rows with equal id, text and source each is in the mix, with the other columns of the first.
    """
    content = F.md5(F.coalesce("text", F.lit("")))
    row = F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), content,
                      F.coalesce(F.concat(F.lit("a"), F.col("source").cast("string")), F.lit("n")))
    others = F.struct(F.lit(0).alias("none"), *[
        F.col(c) for c in docs.columns if c not in ("doc_id", "text", "source")])
    keyed = docs.select("doc_id", "text", "source", F.md5(row).alias("row"), others.alias("others"),
                        F.struct(*docs.columns).alias("doc"))
    laid, sources = lay_out(keyed, seed, ["row"])
    laid = stage_table(laid, "laid")
    # Both sides of the joins grow with the corpus: neither is to be broadcast.
    hits = _spread(laid).join(slots(sources, seed).hint("merge"), ["source_key", "block"])
    passes = hits.groupBy("row", "source_key", "size", "start", "epoch").agg(
        F.array_sort(F.collect_list("block")).alias("blocks")
    )
    # Rows of equal content share a key: the first carries the text, the passes tell how often.
    first = F.row_number().over(Window.partitionBy("row").orderBy("others"))
    texts = keyed.select("row", "others", "doc").withColumn("n", first).filter("n = 1").select("row", "doc")
    need = F.floor((F.col("start") + F.col("size") - 1) / BLOCK) - F.floor(F.col("start") / BLOCK) + 1
    text = F.col("doc")["text"]
    split = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")

    def part(words: Column, block: Column) -> Column:
        low = F.greatest(block * BLOCK - F.col("start"), F.lit(0))
        high = F.least((block + 1) * BLOCK - F.col("start"), F.col("size"))
        return F.array_join(F.slice(words, (low + 1).cast("int"), (high - low).cast("int")), " ")

    # The words are bound by a lambda, so that a text is split once and not for every block.
    some = F.transform(F.array(split), lambda words: F.array_join(
        F.transform("blocks", lambda block: part(words, block)), " "))[0]
    cut = (
        texts.join(passes.hint("merge"), "row").withColumn("whole", F.size("blocks") == need)
        .withColumn("text", F.when(F.col("whole"), text).otherwise(some))
    )
    whole = F.col("whole")
    fresh = {"text": F.col("text"), "n_chars": F.when(whole, F.col("doc.n_chars")).otherwise(
        F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else None}
    return cut.select(*[
        fresh[c].alias(c) if c in fresh else F.col("doc")[c].alias(c) for c in docs.columns
    ])
