"""Phrase collocations: frequent word runs by mergeable Misra-Gries summaries, counted exactly in a second pass."""

from __future__ import annotations

import itertools
import zlib

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import batch_of, small_batches
from holdfast.session import stage_table

LONGEST, MIN_COUNT, KEPT = 5, 100, 2000
SLICE_CHARS, CHUNK_WORDS, CACHED_WORDS = 1 << 20, 1 << 19, 200_000
PART_BYTES = 1 << 28
KEY_BITS = 40
FILTER_BITS = 1 << 29
HELD_RUNS, FEW_LANGUAGES = 400_000, 100_000
#: What ends a piece of text, beside line breaks; words are parted by blanks and tabs.
STOPS = ".,;:!?"
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads neighbouring ones."""
    x = (x ^ (x >> np.uint64(32))) * _MIX
    return (x ^ (x >> np.uint64(29))) * _MIX


class RunStream:
    """Words of texts, in chunks of bounded size, with the runs of words in each.

    Texts are added one by one; ``full`` says when a chunk should be taken. A chunk has
    one token per word and a stop between pieces, texts and languages; the last words of a text that goes on in the next chunk
    are repeated there, and runs that end among them are not counted again.
    """

    def __init__(self, longest: int, chunk_words: int = CHUNK_WORDS, slice_chars: int = SLICE_CHARS):
        self.longest, self.chunk_words, self.slice_chars = longest, chunk_words, slice_chars
        lower = {c: c + 32 for c in range(65, 91)}
        stops = {c: 46 for c in (*STOPS.encode(), *range(0x0A, 0x0E))}
        self.table = bytes({**lower, **stops}.get(c, c) for c in range(256))
        self._reset([])

    def _reset(self, carried: list[bytes]) -> None:
        self.tokens, self.skip = list(carried), len(carried)
        self.spans: list[tuple[str, int]] = []  # language, end

    @property
    def full(self) -> bool:
        return len(self.tokens) >= self.chunk_words

    def add(self, lang: str, text: str):
        """Adds a text; yields whenever a chunk is full, with the chunk to be taken by ``take``."""
        data = memoryview(text.encode())
        start = 0
        while start < len(data) or start == 0:
            end = min(start + self.slice_chars, len(data))
            if end < len(data):
                end += self._word_end(data, end)
            part = bytes(data[start:end]).translate(self.table).replace(b".", b" . ")
            self.tokens += part.split()
            start = max(end, 1)
            if start >= len(data):
                self.tokens.append(b".")
            self._span(lang)
            if self.full:
                yield self
                carried = []
                if start < len(data):
                    tail = self.tokens[-(self.longest - 1):] if self.longest > 1 else []
                    carried = tail
                self._reset(carried)

    def _span(self, lang: str) -> None:
        if self.spans and self.spans[-1][0] == lang:
            self.spans.pop()
        self.spans.append((lang, len(self.tokens)))

    @staticmethod
    def _word_end(data: memoryview, at: int) -> int:
        """How many bytes from ``at`` on belong to the word there."""
        step, seen = 4096, 0
        while at + seen < len(data):
            block = bytes(data[at + seen: at + seen + step])
            places = [p for p in (block.find(c) for c in (b" ", b"\t", b"\n", b".", b",")) if p >= 0]
            if places:
                return seen + min(places)
            seen += len(block)
        return seen

    def languages(self) -> tuple[list[str], np.ndarray]:
        """The languages of the chunk, and which of them each token has."""
        names = sorted({lang for lang, _ in self.spans})
        code = {lang: i for i, lang in enumerate(names)}
        ends = [end for _, end in self.spans]
        return names, np.repeat([code[lang] for lang, _ in self.spans], np.diff([0, *ends]))


class WordIds:
    """Numbers of words from 1 on, exact as long as they are kept; a stop is 0."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.number = {b".": 0}
        self.hashes = [0]

    def __call__(self, tokens: list[bytes], with_hashes: bool = True) -> np.ndarray:
        import xxhash

        if len(self.number) > CACHED_WORDS:
            self.clear()
        number = self.number
        for word in set(tokens).difference(number):
            number[word] = len(number)
            self.hashes.append(xxhash.xxh3_64_intdigest(word))
        return np.fromiter(map(number.__getitem__, tokens), np.int64, len(tokens))


def runs(words: np.ndarray, skip: int, longest: int):
    """(n, starts) for n from 1 to ``longest``: where the runs of n words are that hold no stop and end past ``skip``."""
    inside = words != 0
    whole = inside
    for n in range(1, longest + 1):
        if n > 1:
            whole = whole[:-1] & inside[n - 1:] if len(inside) >= n else whole[:0]
        starts = np.flatnonzero(whole)
        yield n, starts[starts + n > skip]


def run_keys(words: np.ndarray, hashes: np.ndarray, langs: np.ndarray, skip: int, longest: int):
    """(n, starts, keys): 64-bit keys of the runs, those of a run in two languages being different."""
    word_hash = hashes[words]
    grown = _mixed(word_hash ^ _mixed(langs))
    for n, starts in runs(words, skip, longest):
        if n > 1:
            grown = _mixed(grown[:-1] + word_hash[n - 1:]) if len(word_hash) >= n else grown[:0]
        yield n, starts, grown[starts]


def packed(numbers: np.ndarray) -> bytes:
    """Ascending 64-bit numbers as planes of bytes of their differences, compressed."""
    import pyarrow as pa

    steps = np.diff(numbers, prepend=np.uint64(0))
    planes = np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T)
    used = 8 - int(np.argmax(planes[::-1].any(axis=1)))
    return bytes([used]) + pa.compress(planes[:used].tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes, n: int) -> np.ndarray:
    import pyarrow as pa

    used = data[0]
    steps = np.zeros((8, n), np.uint8)
    steps[:used] = np.frombuffer(pa.decompress(data[1:], used * n, "zstd"), np.uint8).reshape(used, n)
    return np.cumsum(np.ascontiguousarray(steps.T).view(np.uint64).ravel(), dtype=np.uint64)


class Summary:
    """A Misra-Gries summary of weighted keys: counts that fall short of the true ones by at most ``error``.

    At most ``capacity`` keys are kept. Every cut lowers more than ``capacity`` counts alike, so ``error``
    stays below mass / capacity, however summaries were merged.
    """

    def __init__(self, capacity: int):
        self.capacity, self.error = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def merge(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        self.held += len(keys)
        if self.held > max(self.capacity, 1 << 20):
            self.settle()

    def settle(self) -> None:
        if not self.waiting:
            return
        keys = np.concatenate([self.keys, *(k for k, _ in self.waiting)])
        counts = np.concatenate([self.counts, *(c for _, c in self.waiting)])
        self.waiting, self.held = [], 0
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
        first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else order
        self.keys, self.counts = keys[first], np.add.reduceat(counts, first) if len(keys) else counts
        if len(self.keys) > self.capacity:
            cut = np.partition(self.counts, -self.capacity - 1)[-self.capacity - 1]
            self.error += int(cut)
            stay = self.counts > cut
            self.keys, self.counts = self.keys[stay], self.counts[stay] - cut

    def at_least(self, threshold: int) -> np.ndarray:
        """All keys whose true count may reach ``threshold``; complete while ``error`` is below it."""
        self.settle()
        if self.error >= threshold:
            raise RuntimeError("capacity must exceed mass divided by the threshold")
        return self.keys[self.counts + self.error >= threshold]


def _lang_hash(names: list[str]) -> np.ndarray:
    import xxhash

    return np.array([xxhash.xxh3_64_intdigest(n.encode(), 1) for n in names], np.uint64)


def _texts(docs: DataFrame) -> DataFrame:
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("und"))
    return small_batches(docs.select(lang.alias("lang"), F.coalesce("text", F.lit("")).alias("text")))


def _chunks(batches, longest: int):
    stream = RunStream(longest)
    for batch in batches:
        for lang, text in zip(batch.column(0), batch.column(1)):
            yield from stream.add(lang.as_py(), text.as_py())
    if stream.tokens:
        yield stream


def partitions_for(docs: DataFrame) -> int:
    """Partitions for the counts: as many as the session has, or more where the texts are large."""
    size = _texts(docs).agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))


def frequent_keys(docs: DataFrame, threshold: int, longest: int, parts: int) -> DataFrame:
    """(key): the low ``KEY_BITS`` bits of the keys of all runs of 1 to ``longest`` words that occur ``threshold`` times or
    more in a language, and some others.

    Each task counts the runs of a chunk and sends them, by a hash of the key, to partitions; there
    they meet the mass of the whole partition first and are then merged into a summary whose capacity exceeds
    mass / threshold. Memory is bounded by that capacity, and no run that is frequent is lost. Stored.
    """
    import pyarrow as pa

    texts = _texts(docs)
    shape = pa.schema([("part", pa.int32()), ("mass", pa.int64()), ("n", pa.int64()),
                       ("keys", pa.binary()), ("counts", pa.binary())])

    def local(batches):
        ids, mass = WordIds(), np.zeros(parts, np.int64)
        for stream in _chunks(batches, longest):
            words = ids(stream.tokens)
            names, langs = stream.languages()
            hashes, lang_hash = np.array(ids.hashes, np.uint64), _lang_hash(names)[langs]
            for _, _, keys in run_keys(words, hashes, lang_hash, stream.skip, longest):
                keys, counts = np.unique(keys, return_counts=True)
                to = ((keys >> np.uint64(KEY_BITS)) % np.uint64(parts)).astype(np.int64)
                keys &= np.uint64((1 << KEY_BITS) - 1)
                mass += np.bincount(to, counts, parts).astype(np.int64)
                order = np.lexsort((keys, to))
                ends = np.searchsorted(to[order], np.arange(parts + 1))
                rows = []
                for p in np.flatnonzero(np.diff(ends)).tolist():
                    mine = order[ends[p]: ends[p + 1]]
                    sums = np.cumsum(counts[mine]).astype(np.uint64)
                    rows.append((p, None, len(mine), packed(keys[mine]), packed(sums)))
                    if len(rows) == 256:
                        yield batch_of(rows, shape)
                        rows = []
                if rows:
                    yield batch_of(rows, shape)
        yield batch_of([(p, int(m), None, None, None) for p, m in enumerate(mass) if m], shape)

    def merged(batches):
        keys_of = pa.schema([("key", pa.int64())])
        part, mass, summary = None, 0, None

        def frequent():
            found = summary.at_least(threshold) if summary is not None else np.zeros(0, np.uint64)
            for start in range(0, len(found), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(found[start: start + (1 << 16)].view(np.int64))], schema=keys_of)

        for batch in batches:
            for p, m, n, keys, counts in zip(*batch.columns):
                if p.as_py() != part:
                    yield from frequent()
                    part, mass, summary = p.as_py(), 0, None
                if m.is_valid:
                    mass += m.as_py()
                    continue
                if summary is None:
                    summary = Summary(mass // threshold + 1)
                sums = unpacked(counts.as_py(), n.as_py()).astype(np.int64)
                summary.merge(unpacked(keys.as_py(), n.as_py()), np.diff(sums, prepend=0))
        yield from frequent()

    sent = texts.mapInArrow(local, "part int, mass long, n long, keys binary, counts binary")
    grouped = sent.repartitionById(parts, "part").sortWithinPartitions("part", F.col("mass").desc_nulls_last())
    return stage_table(small_batches(grouped).mapInArrow(merged, "key long"), "frequent")


class KeyFilter:
    """Bits for a set of keys: every key of the set passes, of others few while the set is small against the bits."""

    def __init__(self, bits: int, field: np.ndarray | None = None):
        self.bits = bits
        self.field = np.zeros(bits // 8, np.uint8) if field is None else field

    def places(self, keys: np.ndarray):
        keys = keys & np.uint64((1 << KEY_BITS) - 1)
        mask = np.uint64(self.bits - 1)
        for shift in (0, 21, 42):
            yield (_mixed(keys + np.uint64(shift)) >> np.uint64(8)) & mask

    def add(self, keys: np.ndarray) -> None:
        for place in self.places(keys):
            np.bitwise_or.at(self.field, (place >> np.uint64(3)).astype(np.int64),
                             np.left_shift(np.uint8(1), (place & np.uint64(7)).astype(np.uint8)))

    def passes(self, keys: np.ndarray) -> np.ndarray:
        found = np.ones(len(keys), bool)
        for place in self.places(keys):
            byte = self.field[(place >> np.uint64(3)).astype(np.int64)]
            found &= (byte >> (place & np.uint64(7)).astype(np.uint8)) & 1 == 1
        return found


def key_filter(keys: DataFrame, most_bits: int = FILTER_BITS) -> KeyFilter:
    """A filter over ``keys``: 16 bits a key, up to ``most_bits``.

    Tasks make the filters of their own keys, which are joined pairwise by or; the driver gets the last. Beyond its
    largest size more runs pass that are not frequent, which costs time but no result.
    """
    import pyarrow as pa

    count = keys.count()
    bits = 1 << min(max(16, (16 * count - 1).bit_length() if count else 0), most_bits.bit_length() - 1)

    def fill(batches):
        made = KeyFilter(bits)
        for batch in batches:
            made.add(batch.column(0).to_numpy().view(np.uint64))
        for i in range(0, bits // 8, 1 << 20):
            part = made.field[i: i + (1 << 20)]
            if part.any():
                yield pa.RecordBatch.from_arrays([pa.array([i]), pa.array([zlib.compress(part.tobytes(), 1)])],
                                                 names=["at", "field"])

    def join(batches):
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for at, field in zip(batch.column(0).to_pylist(), batch.column(1)):
                part = np.frombuffer(zlib.decompress(field.as_buffer()), np.uint8)
                total[at] = total[at] | part if at in total else part
        for at, part in total.items():
            yield pa.RecordBatch.from_arrays([pa.array([at]), pa.array([zlib.compress(part.tobytes(), 1)])],
                                             names=["at", "field"])

    shape = "at long, field binary"
    tasks = max(1, min(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-count // 1_000_000)))
    parts = keys.repartition(tasks).mapInArrow(fill, shape)
    pieces = max(1, bits >> 23)
    whole = small_batches(parts.repartitionById(pieces, F.shiftright("at", 20).cast("int"))).mapInArrow(join, shape)
    made = KeyFilter(bits)
    for row in whole.toLocalIterator():  # at most most_bits, cut in parts
        part = np.frombuffer(zlib.decompress(row["field"]), np.uint8)
        made.field[row["at"]: row["at"] + len(part)] = part
    return made


def exact_counts(docs: DataFrame, wanted: KeyFilter, longest: int, parts: int) -> DataFrame:
    """(lang, phrase, n_words, f): exact occurrences of the runs that pass ``wanted``; a null phrase counts all words.

    A run is counted if the runs without its last and without its first word passed as well. Within a chunk runs are told
    apart by the numbers of their words, not by keys. A task adds its chunks up and sends what it has to
    partitions by a hash, a row each, where one task adds up what all have sent.
    """
    import pyarrow as pa

    shape = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("n_words", pa.int32()), ("f", pa.int64())])
    packed_shape = pa.schema([("part", pa.int32()), *((f.name, pa.list_(f.type)) for f in shape)])
    shared = docs.sparkSession.sparkContext.broadcast(wanted.field)

    def sent(sums):
        """Counts in one row a partition."""
        held: dict[int, list] = {}
        for (lang, n, phrase), f in sums.items():
            if f:
                part = zlib.crc32(phrase or b"", zlib.crc32(lang.encode())) % parts
                held.setdefault(part, []).append((lang, phrase and phrase.decode(), n, f))
        for part, found in held.items():
            yield batch_of([(part, *map(list, zip(*found)))], packed_shape)

    def count(batches):
        sums: dict[tuple, int] = {}
        ids, filter_ = WordIds(), KeyFilter(8 * len(shared.value), shared.value)
        for stream in _chunks(batches, longest):
            words = ids(stream.tokens)
            names, langs = stream.languages()
            hashes = np.array(ids.hashes, np.uint64)
            tokens = stream.tokens
            new = np.flatnonzero(words[stream.skip:]) + stream.skip
            for code, n in enumerate(np.bincount(langs[new], minlength=len(names)).tolist()):
                sums[names[code], 0, None] = sums.get((names[code], 0, None), 0) + n
            group = None
            for n, starts, keys in run_keys(words, hashes, _lang_hash(names)[langs], 0, longest):
                if n > 1:
                    parts = (group[starts] >= 0) & (group[starts + 1] >= 0)
                    starts, keys = starts[parts], keys[parts]
                passed = starts[filter_.passes(keys)]
                pairs = ((langs if n == 1 else group)[passed] << 32) | words[passed + n - 1]
                counted = passed + n > stream.skip
                kinds, first, kind = np.unique(pairs, return_index=True, return_inverse=True)
                group = np.full(len(words), -1, np.int64)
                group[passed] = kind
                f = np.bincount(kind[counted], minlength=len(kinds))
                out = np.flatnonzero(f)
                places = passed[first[out]].tolist()
                for code, i, times in zip(langs[places].tolist(), places, f[out].tolist()):
                    run = names[code], n, b" ".join(tokens[i: i + n])
                    sums[run] = sums.get(run, 0) + times
                if len(sums) > HELD_RUNS:
                    yield from sent(sums)
                    sums.clear()
        yield from sent(sums)

    def added(batches):
        part, sums = None, {}

        def whole():
            rows = ((*run, f) for run, f in sums.items())
            while some := list(itertools.islice(rows, 20_000)):
                yield batch_of(some, shape)

        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column(0)[i].as_py() != part:
                    yield from whole()
                    part, sums = batch.column(0)[i].as_py(), {}
                *runs_, counts = (batch.column(c)[i].as_py() for c in range(1, 5))
                for run, f in zip(zip(*runs_), counts):
                    sums[run] = sums.get(run, 0) + f
        yield from whole()

    runs_of = "part int, lang array<string>, phrase array<string>, n_words array<int>, f array<long>"
    rows = _texts(docs).mapInArrow(count, runs_of).repartitionById(parts, "part").sortWithinPartitions("part")
    return small_batches(rows).mapInArrow(added, "lang string, phrase string, n_words int, f long")


def _words(phrase: Column) -> Column:
    return F.split(phrase, "[ \t]", -1)


def _run(words: Column, start, n) -> Column:
    return F.concat_ws(" ", F.slice(words, start, n))


def score_phrases(counts: DataFrame, share: int = 100, kept: int = KEPT, scale: int = 1000) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score) from counts (lang, phrase, n_words, f) of all frequent runs, and of all words.

    A phrase is cut after each of its words but the last; the cut with the lowest score counts. Products
    are decimals of 38 digits. A phrase goes if a longer one around it has at least ``share``
    percent of its occurrences. Each language's best ``kept`` are ranked.
    """
    wide = "decimal(19,0)"
    runs_ = counts.filter("phrase is not null").select("lang", "phrase", "n_words", "f")
    totals = counts.filter("phrase is null").select("lang", F.col("f").alias("n"))
    if totals.count() <= FEW_LANGUAGES:  # one short row each
        totals = F.broadcast(totals)
    words = _words(F.col("phrase"))
    phrases = runs_.filter("n_words > 1").select("lang", "phrase", "n_words", F.col("f").alias("a"), words.alias("w"))
    cuts = phrases.select("lang", "phrase", "a", "w", "n_words", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", _run(F.col("w"), F.lit(1), F.col("k")).alias("left"),
                       _run(F.col("w"), F.col("k") + 1, F.col("n_words") - F.col("k")).alias("right"))
    side = runs_.select("lang", "phrase", "f")
    joined = (
        cuts.join(side.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
        .join(side.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
        .join(totals, "lang")
        .select("*", (F.col("a") * scale).cast(wide).alias("top"))
        .withColumn("score", F.expr(f"(top * cast(n as {wide})) div (cast(l as {wide}) * cast(r as {wide}))"))
    )
    best = joined.groupBy("lang", "phrase").agg(
        F.first("a").alias("a"), F.first("n").alias("n"), F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    spans = F.flatten(F.transform(F.sequence(F.lit(2), F.col("n_words") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("n_words") - m + 1), lambda s: _run(F.col("w"), s, m))))
    inside = phrases.filter("n_words > 2").select("lang", F.explode(F.array_distinct(spans)).alias("phrase"), "a")
    around = inside.groupBy("lang", "phrase").agg(F.max("a").alias("outer"))
    alone = best.join(around, ["lang", "phrase"], "left").filter(
        F.col("outer").isNull() | (F.lit(100) * F.col("outer") < F.lit(share) * F.col("a")))
    ranked = alone.select("lang", "phrase", "a", "n", "cut.score", "cut.l", "cut.r").withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")))
    return ranked.filter(F.col("rank") <= kept).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def collocations(
    docs: DataFrame, threshold: int = MIN_COUNT, longest: int = LONGEST, share: int = 100, kept: int = KEPT,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the best phrases of 2 to ``longest`` words of each language.

    Texts are ASCII-lowered and cut at ``.,;:!?`` and line breaks into pieces, these at blanks and tabs into
    words. A phrase counts every occurrence within a piece, and is a candidate from ``threshold`` on; see
    ``score_phrases`` for the rest. A null ``lang`` is ``und``, a null text is empty, repeated rows count
    again, other columns take no part; languages without a candidate and empty tables give no rows.
    """
    parts = partitions_for(docs)
    wanted = key_filter(frequent_keys(docs, threshold, longest, parts))
    counts = stage_table(
        exact_counts(docs, wanted, longest, parts).filter((F.col("f") >= threshold) | F.col("phrase").isNull()), "phrases")
    return score_phrases(counts, share, kept)
