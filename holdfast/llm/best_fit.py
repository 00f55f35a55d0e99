"""Best-fit packing of token sequences by large-item matching."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Mapping
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm.common import parts_for, running_start, small_batches
from holdfast.session import stage_table

#: The pre-token pattern of byte-level vocabularies.
PRE_TOKENS = (
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)

_PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long"
_CHUNK = 65536


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte: itself if printable, else the next free one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def _ranked(path: str, tokenizer):
    """The byte-level vocabulary of ``path`` for tiktoken, or None where ranks would not give the same ids.

    They do if nothing but the plain byte-level split comes first, every merge has the id after the one
    before it, and every token comes out as itself.
    """
    import json

    import tiktoken

    with open(path, encoding="utf-8") as file:
        about = json.load(file)
    model, split = about["model"], about.get("pre_tokenizer") or {}
    plain = (
        model["type"] == "BPE" and about.get("normalizer") is None and split.get("type") == "ByteLevel"
        and split.get("use_regex", True) and not split.get("add_prefix_space")
        and not any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "end_of_word_suffix"))
    )
    if not plain:
        return None
    added = {t["content"] for t in about["added_tokens"]}
    vocab = {word: i for word, i in model["vocab"].items() if word not in added}
    merged = ["".join(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
    ids = [vocab[word] for word in merged]
    byte_of = {letter: b for b, letter in byte_letters().items()}
    if any(x >= y for x, y in zip(ids, ids[1:])) or not all(c in byte_of for word in vocab for c in word):
        return None
    if any(len(tokenizer.model.tokenize(word)) != 1 for word in vocab):
        return None
    ranks = {bytes(byte_of[c] for c in word): i for word, i in vocab.items()}
    return tiktoken.Encoding("ranked", pat_str=PRE_TOKENS, mergeable_ranks=ranks, special_tokens={})


@cache
def make_encoder(path: str):
    """A function from a text to its ids as little-endian uint32 bytes, as the tokenizer gives them.

    Byte-level vocabularies are run by tiktoken, which gives the same ids faster. Texts that hold an
    added token, and those whose runs of white space are too long for its patterns, go through the
    tokenizer; so does everything with other vocabularies. A worker loads a vocabulary once.
    """
    import os

    import numpy as np
    from tokenizers import Tokenizer

    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    tokenizer = Tokenizer.from_file(path)
    ranked = _ranked(path, tokenizer)
    added = [t.content for t in tokenizer.get_added_tokens_decoder().values()]

    def encode(text: str) -> bytes:
        if ranked is not None and not any(token in text for token in added):
            try:
                ids = ranked.encode_to_numpy(text, allowed_special=set(), disallowed_special=())
                return ids.astype("<u4").tobytes()
            except ValueError:
                pass
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    return encode


def token_pieces(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, with_ids: bool = False,
    end_id: int = 0,
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): the token sequence of every document, cut to fit.

    A document is the ids of its ``text`` and ``end_id``; a null or empty text is ``end_id`` alone.
    Longer ones are cut into pieces of ``capacity``, of which the first may be shorter. Repeated rows
    and null ids are documents like others.
    """
    import pyarrow as pa

    def cut(batches):
        import numpy as np

        encode = make_encoder(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = encode(text.as_py() or "") + end
                total = len(ids) // 4
                start, size, piece = 0, total % capacity or capacity, 0
                while start < total:
                    part = ids[4 * start: 4 * (start + size)]
                    row = (doc_id, piece, start, size, zlib.crc32(part))
                    out.append(row + (np.frombuffer(part, "<i4").tolist(),) if with_ids else row)
                    start, size, piece = start + size, capacity, piece + 1
            columns = list(zip(*out)) if out else [()] * (5 + with_ids)
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types)], names=names[: len(columns)]
            )

    texts = small_batches(docs.select(F.col("doc_id").cast("long"), "text"))
    return texts.mapInArrow(cut, _PIECE + (", ids array<int>" if with_ids else ""))


def plan_bins(counts: Mapping[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """(length, first, n, sequence, offset): where the ``n`` items of a length from the ``first`` on go.

    Item ``first + i`` goes to bin ``sequence + i`` at ``offset``. Equal lengths are interchangeable,
    so the plan needs only how many items each of at most ``capacity`` lengths has, and its size
    depends on the capacity, not on the number of items. Items above a third of the capacity share
    a bin with at most one other such item: each, largest first, gets the largest partner that fits.
    Smaller items, largest first, go where the least room is left; bins are added when none has room.
    """
    left = {length: n for length, n in counts.items() if n > 0}
    if any(not 0 < length <= capacity for length in left):
        raise ValueError("lengths must lie between 1 and the capacity")
    used: dict[int, int] = defaultdict(int)
    rows: list[tuple[int, int, int, int, int]] = []
    room: dict[int, list[tuple[int, int]]] = defaultdict(list)
    bins = 0

    def put(length: int, n: int, sequence: int, offset: int) -> None:
        rows.append((length, used[length], n, sequence, offset))
        used[length] += n
        left[length] -= n

    large = sorted((x for x in left if 3 * x > capacity), reverse=True)
    for a in large:
        for b in large:
            if left[a] == 0:
                break
            if b > a or a + b > capacity or left[b] == 0:
                continue
            pairs = left[a] // 2 if a == b else min(left[a], left[b])
            if pairs:
                put(a, pairs, bins, 0)
                put(b, pairs, bins, a)
                room[capacity - a - b].append((bins, bins + pairs))
                bins += pairs
        if left[a]:
            alone = left[a]
            put(a, alone, bins, 0)
            room[capacity - a].append((bins, bins + alone))
            bins += alone
    for s in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        gap = s
        while left[s]:
            while gap <= capacity and not room[gap]:
                gap += 1
            if gap > capacity:
                each = capacity // s
                full, rest = divmod(left[s], each)
                for k in range(each if full else 0):
                    put(s, full, bins, k * s)
                room[capacity - each * s].append((bins, bins + full)) if full else None
                bins += full
                for k in range(rest):
                    put(s, 1, bins, k * s)
                if rest:
                    room[capacity - rest * s].append((bins, bins + 1))
                    bins += 1
                break
            first, last = room[gap].pop()
            n = min(left[s], last - first)
            put(s, n, first, capacity - gap)
            room[gap - s].append((first, first + n))
            if first + n < last:
                room[gap].append((first + n, last))
            gap = max(s, gap - s) if gap - s >= s else gap
    return rows


def _planned(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """The plan with one row for every item: (length, place, sequence_id, offset)."""
    plan = spark.createDataFrame(rows, "length long, first long, n long, sequence long, offset long")
    chunks = plan.withColumn(
        "chunk", F.explode(F.sequence(F.lit(0), F.col("n") - 1, F.lit(_CHUNK)))
    ).repartition(parts_for(spark, sum(row[2] for row in rows)), "length", "chunk", "first")
    items = chunks.withColumn(
        "i", F.explode(F.sequence("chunk", F.least(F.col("chunk") + _CHUNK, F.col("n")) - 1))
    )
    return items.select(
        "length", (F.col("first") + F.col("i")).alias("place"),
        (F.col("sequence") + F.col("i")).alias("sequence_id"), "offset",
    )


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = 2048, with_ids: bool = False
) -> DataFrame:
    """The pieces of ``docs`` (see ``token_pieces``) with ``sequence_id`` and ``offset``.

    The driver sees how many pieces each length has, at most ``capacity`` numbers, and plans the bins
    from them. Pieces of a length are numbered in windows over hashed buckets, so one length may hold
    any share of the rows, and meet their place by a join on (length, number). Columns of ``docs`` other than ``doc_id``
    and ``text`` take no part. Empty input: no rows.
    """
    pieces = stage_table(token_pieces(docs, tokenizer_path, capacity, with_ids), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    if not counts:
        return pieces.select("*", F.lit(0).cast("long").alias("sequence_id"),
                             F.lit(0).cast("long").alias("offset"))
    order = [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    numbered = running_start(pieces, ["length"], F.lit(1), order, "place")
    placed = numbered.join(_planned(docs.sparkSession, plan_bins(counts, capacity)), ["length", "place"])
    return placed.select(*pieces.columns, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids): the packed sequences themselves, from ``pack(with_ids=True)``."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("parts")).select(
        "sequence_id", F.flatten(F.col("parts.ids")).alias("ids"), F.col("parts.doc_id").alias("doc_ids")
    )
