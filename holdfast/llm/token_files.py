"""Token ids in flat binary files with 64-bit document offsets, written by tasks and memory-mapped when read."""

from __future__ import annotations

import zlib
from array import array

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import batch_of, small_batches, worker_memory
from holdfast.session import stage_table, staging_path

RANGE_BYTES, FILE_IDS, FILE_DOCS = 1 << 28, 1 << 28, 1 << 22
READ_DOCS, READ_IDS = 1 << 16, 1 << 20
SLICE_CHARS, CACHED_PARTS, CACHED_CHARS = 1 << 20, 500_000, 64

#: A pre-token pattern of word vocabularies, no match of which spans white space.
END_OF_WORD = "</w>"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: A word of letters that are lower-cased one by one, and marks after it.
PLAIN_WORD = r"([A-Za-zÀ-ÖØ-öø-ÿ]{1,64})([.,;:!?]{0,8})"


def splits_at_blanks(about: dict) -> bool:
    """Whether a tokenizer file gives the parts of a text between ASCII blanks the ids they have in the text.

    So it is if white space is dropped before the merges, and nothing that comes first looks across it.
    """
    first = about.get("normalizer") or {}
    steps = first.get("normalizers", [first] if first else [])
    white = {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}
    split, *rest = (about.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
    return (
        all(s["type"] in ("NFC", "Lowercase") or s == white for s in steps)
        and split == {"type": "Split", "pattern": {"Regex": WORD_PATTERN}, "behavior": "Removed", "invert": True}
        and all(s["type"] == "ByteLevel" and not s["add_prefix_space"] and not s["use_regex"] for s in rest)
        and about["model"]["type"] == "BPE" and about["model"]["end_of_word_suffix"] == END_OF_WORD and not about["model"].get("dropout")
        and not any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"]
                    or set(t["content"]) & set(" \n\t") for t in about["added_tokens"])
    )


def slices(text: str, size: int = SLICE_CHARS):
    """``text`` in slices of about ``size`` characters that end before an ASCII blank."""
    start = 0
    while len(text) - start > size:
        ends = [e for e in (text.find(c, start + size) for c in " \n\t") if e >= 0]
        if not ends:
            break
        yield text[start: min(ends)]
        start = min(ends)
    yield text[start:]


def file_encoder(path: str):
    """(encode, largest id): ``encode`` gives a text's ids as the tokenizers library does, as an array.

    Where ``splits_at_blanks`` holds, a text is cut at ASCII blanks, and parts met before are looked up in
    a memory of bounded size. The library encodes the others; of a plain word, with marks after it or not, its
    model merges the letters. With other tokenizers the library gets the whole text. A worker loads a
    tokenizer once.
    """
    import json
    import os
    import re

    import numpy as np
    from tokenizers import Tokenizer
    from tokenizers.pre_tokenizers import ByteLevel

    memory = worker_memory()
    if ("file_encoder", path) in memory:
        return memory["file_encoder", path]
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    tokenizer = Tokenizer.from_file(path)
    with open(path, encoding="utf-8") as file:
        apart = splits_at_blanks(json.load(file))
    largest = max(tokenizer.get_vocab(with_added_tokens=True).values())
    plain, merge = re.compile(PLAIN_WORD).fullmatch, tokenizer.model.tokenize
    as_bytes = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
    letters = {c: as_bytes(chr(c))[0][0] for c in range(0xC0, 0x100)}

    class Parts(dict):
        """The ids of parts of texts, found when first asked for."""

        def __missing__(self, part: str) -> bytes:
            if len(self) >= CACHED_PARTS:
                self.clear()
            found = plain(part)
            if not found:
                ids = array("I", tokenizer.encode(part, add_special_tokens=False).ids).tobytes()
            elif found[2] or not part.islower():
                ids = self[found[1].lower()] + (self[found[2]] if found[2] else b"")
            else:  # one word for the merges, its letters as bytes
                ids = array("I", [t.id for t in merge(part.translate(letters))]).tobytes()
            if len(part) <= CACHED_CHARS:
                self[part] = ids
            return ids

    part_ids = Parts().__getitem__

    def parts(text: str) -> bytes:
        return b"".join(map(part_ids, text.replace("\n", " ").replace("\t", " ").split(" ")))

    def encode(text: str) -> np.ndarray:
        if apart:
            return np.frombuffer(b"".join(map(parts, slices(text))), "<u4")
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    memory["file_encoder", path] = encode, largest
    return encode, largest


def write_token_files(
    docs: DataFrame, tokenizer_path: str, folder: str, end_id: int,
    file_ids: int = FILE_IDS, file_docs: int = FILE_DOCS,
) -> DataFrame:
    """Writes the ids of ``docs`` to ``folder`` in ascending doc_id order; (path, width, docs, null_ids, ids, base) per file.

    ``<path>.bin`` holds the ids of its documents one after another, each text's and ``end_id``, unsigned and
    little-endian, ``width`` bytes each: two where the vocabulary and the end allow it, else four.
    ``<path>.idx`` holds 64-bit integers: where each document starts in the file and where the
    last one ends, then the doc_ids; the first ``null_ids`` documents have none (written as 0). ``base`` is the
    number of ids in all files before this one, a running sum over the files. Texts are dealt by ranges of
    (doc_id, text's hash, partition they come from), so that rows which share an id spread, and each range is
    encoded and written by one task. A task that runs again writes files of other names, and the table
    returned, which is stored, names those that count.
    """
    import pyarrow as pa

    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    spread = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(-(-size // RANGE_BYTES), min(spread, -(-size // (1 << 20))), 1)
    schema = pa.schema([("part", pa.int32()), ("number", pa.int32()), ("path", pa.string()), ("width", pa.int32()),
                        ("docs", pa.int64()), ("null_ids", pa.int64()), ("ids", pa.int64())])

    def write(batches):
        import uuid

        from pyarrow import fs
        from pyspark import TaskContext

        encode, largest = file_encoder(tokenizer_path)
        width = 2 if max(largest, end_id) < 1 << 16 else 4
        end = end_id.to_bytes(width, "little")
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        part, number, file = TaskContext.get().partitionId(), 0, None

        def close():
            file.close()
            with system.open_output_stream(f"{name}.idx") as index:
                index.write(memoryview(starts).cast("B"))
                index.write(memoryview(names).cast("B"))
            return batch_of([(part, number, name, width, len(names), nulls, starts[-1])], schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                if file is None:
                    name = f"{base.rstrip('/')}/{uuid.uuid4().hex}"
                    file = system.open_output_stream(f"{name}.bin", buffer_size=1 << 20)
                    starts, names, nulls = array("q", [0]), array("q"), 0
                ids = encode(text.as_py())
                file.write(ids.astype(f"<u{width}").tobytes() + end)
                starts.append(starts[-1] + len(ids) + 1)
                nulls += doc_id is None
                names.append(doc_id or 0)
                if starts[-1] >= file_ids or len(names) >= file_docs:
                    yield close()
                    file, number = None, number + 1
        if file is not None:
            yield close()

    keyed = texts.select("*", F.xxhash64("text").alias("hash"), F.spark_partition_id().alias("origin"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("hash"), F.col("origin")]
    ranges = keyed.repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    files = stage_table(
        small_batches(ranges).mapInArrow(
            write, "part int, number int, path string, width int, docs long, null_ids long, ids long"), "files",
    )
    before = Window.orderBy("part", "number").rowsBetween(Window.unboundedPreceding, -1)  # one row a file
    return files.select("path", "width", "docs", "null_ids", "ids",
                        F.coalesce(F.sum("ids").over(before), F.lit(0)).alias("base"))


def read_token_files(files: DataFrame, folder: str, with_ids: bool = False) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32[, ids]) of every document in ``files`` (see ``write_token_files``).

    ``start`` counts the ids of all documents before, over all files; the sum is that of the ids as
    32-bit integers. Files are memory-mapped where the folder is a mounted one, else read by ranges; a
    file is read in runs of documents, each by a task of its own.
    """
    import pyarrow as pa

    schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                        ("ids_crc32", pa.int64()), ("ids", pa.list_(pa.int64()))][: 4 + with_ids])

    def read(batches):
        import numpy as np
        from pyarrow import fs

        system, _ = fs.FileSystem.from_uri(folder)

        def opened(path: str):
            local = isinstance(system, fs.LocalFileSystem)
            return pa.memory_map(path) if local else system.open_input_file(path)

        def numbers(file, kind: str, start: int, n: int) -> np.ndarray:
            size = np.dtype(kind).itemsize
            file.seek(start * size)
            return np.frombuffer(file.read_buffer(n * size), kind)

        def found(path, width, docs, null_ids, base, first):
            n = min(READ_DOCS, docs - first)
            with opened(f"{path}.idx") as index, opened(f"{path}.bin") as data:
                starts = numbers(index, "<i8", first, n + 1)
                names = numbers(index, "<i8", docs + 1 + first, n)
                for i in range(n):
                    at, end, crc, ids = int(starts[i]), int(starts[i + 1]), 0, []
                    for low in range(at, end, READ_IDS):
                        part = numbers(data, f"<u{width}", low, min(READ_IDS, end - low))
                        crc = zlib.crc32(part.astype("<u4"), crc)
                        if with_ids:
                            ids += part.tolist()
                    doc_id = int(names[i]) if first + i >= null_ids else None
                    yield (doc_id, base + at, end - at, crc, ids)[: len(schema)]

        for batch in batches:
            for run in zip(*(c.to_pylist() for c in batch.columns)):
                out = []
                for row in found(*run):
                    out.append(row)
                    if len(out) == (16 if with_ids else 5000):
                        yield batch_of(out, schema)
                        out = []
                if out:
                    yield batch_of(out, schema)

    first = F.explode(F.sequence(F.lit(0).cast("long"), F.col("docs") - 1, F.lit(READ_DOCS).cast("long")))
    runs = files.select("path", "width", "docs", "null_ids", "base", first.alias("first"))
    parts = max(1, files.count())
    return runs.repartition(parts, "path", "first").mapInArrow(
        read, "doc_id long, start long, n_tokens long, ids_crc32 long" + (", ids array<long>" if with_ids else ""))


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int, file_ids: int = FILE_IDS,
               with_ids: bool = False) -> DataFrame:
    """Writes ``docs`` (doc_id, text) to token files in the shared folder and reads them back.

    One row per row of ``docs``: rows that repeat, rows without an id (which come first) and null or
    empty texts (``end_id`` alone) are documents like others; other columns take no part. No rows: no
    files, no rows.
    """
    folder = staging_path(docs.sparkSession, "tokens")
    return read_token_files(write_token_files(docs, tokenizer_path, folder, end_id, file_ids), folder, with_ids)
