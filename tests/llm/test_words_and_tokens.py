"""Resampling, token files and collocations against brute force on small tables, and on odd rows."""

from __future__ import annotations

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from holdfast.llm import collocations, queries, target_resampling, token_files
from holdfast.session import staging_path

LOWER = {c: c + 32 for c in range(65, 91)}
NASTY = [
    "", " ", "\n\t \x0b", "don't we'll it's THEY'RE 'tis", "café café ́x a ́b", "İstanbul ẞ ΣΣ xΣ",
    "mixedджlatin 中文字 12.5e3 µm ªº x×y", "<|endoftext|> a<|startoftext|>b <|endoftext|", " no break em \x1c\x1d\x85sep",
    "stop.,;:!?....,,,, end!!!!!!!!!!!!!!!!!!!!", "\U0001f600\U0001f600 smile :) <3", "a" * 300 + " " + "Ab" * 200 + ".", "A.B.C. e.g., x...y", "tab\there  two  spaces ",
]


def frame(spark, texts, lang=None):
    rows = [(i, t, lang[i] if lang else None) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string")


# resampling

def brute_resample(docs, target, longest, buckets, percent, least, seed):
    def features(text):
        words = re.findall(target_resampling.WORDS, (text or "").translate(LOWER))
        runs = [" ".join(words[i: i + n]) for n in range(1, longest + 1) for i in range(len(words) - n + 1)]
        return len(words), [zlib.crc32(r.encode()) % buckets for r in runs]

    found = [(doc_id, *features(text)) for doc_id, text in docs]
    s = collections.Counter(b for _, _, f in found for b in f)
    t = collections.Counter(b for text in target for b in features(text)[1])
    s_all, t_all = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in range(buckets)]
    rows = []
    for doc_id, words, f in found:
        h = int(hashlib.sha256(f"{seed}:{'null' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 2**32)))
        rows.append([doc_id, len(f), weight, weight + noise, None, words])
    able = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0]))
    for i, row in enumerate(able[: len(able) * percent // 100]):
        row[4] = i + 1
    return [tuple(r[:5]) for r in rows]


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is not None, v) for v in r))


@pytest.mark.parametrize("longest, percent, least", [(1, 10, 20), (2, 35, 1), (3, 100, 0)])
def test_resampling_is_brute_force(spark, small, longest, percent, least):
    docs = spark.read.parquet(f"{small}/documents.parquet").limit(120)
    bench = spark.read.parquet(f"{small}/benchmark.parquet")
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = target_resampling.resample(docs, bench, longest=longest, buckets=777, percent=percent, min_words=least)
    wanted = brute_resample(rows, [r[0] for r in bench.select("text").collect()], longest, 777, percent, least, 2024)
    assert ordered(found.collect()) == ordered(wanted)


def test_resampling_of_odd_rows(spark, odd_docs, no_docs):
    nasty = [(i, t) for i, t in enumerate(NASTY)] + [(None, "x y"), (None, "x y"), (3, "x y"), (3, None)]
    docs = spark.createDataFrame(nasty, "doc_id long, text string")
    found = target_resampling.resample(docs, no_docs, percent=50, min_words=1).collect()
    assert ordered(found) == ordered(brute_resample(nasty, [], 1, 10000, 50, 1, 2024))
    odd = target_resampling.resample(odd_docs, odd_docs.select("text"), min_words=2, percent=100)
    assert odd.columns == ["doc_id", "n_features", "weight", "score", "rank"] and odd.count() == odd_docs.count()
    ranks = sorted(r["rank"] for r in odd.collect() if r["rank"] is not None)
    assert ranks == list(range(1, len(ranks) + 1)) and len(ranks) == 9
    assert target_resampling.resample(no_docs, odd_docs).collect() == []


def test_slices_keep_words_and_runs_whole():
    text = ("Alpha, betaégamma 12 delta; " * 40 + "x" * 50) * 3
    cut = list(target_resampling.text_slices(text.translate(LOWER), 37))
    assert "".join(cut) == text.translate(LOWER) and len(cut) > 20
    whole = target_resampling.run_buckets(text, 3, 1009)
    kept = target_resampling.SLICE_CHARS
    target_resampling.text_slices.__defaults__ = (37,)
    try:
        parts = target_resampling.run_buckets(text, 3, 1009)
    finally:
        target_resampling.text_slices.__defaults__ = (kept,)
    assert whole[0] == parts[0] and sorted(whole[1]) == sorted(parts[1])


# token files

def plain_ids(name, texts, end):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return [tokenizer.encode(t or "", add_special_tokens=False).ids + [end] for t in texts]


@pytest.mark.parametrize("name, end", [("word_bpe_49k.json", 2), ("byte_bpe_50k.json", 70_000)])
def test_token_files_give_back_what_the_tokenizer_gives(spark, small, name, end):
    rng = np.random.default_rng(3)
    letters = list("abcdeXYZéßЖ \n\t.,'!12́中 <|>")
    texts = NASTY + ["".join(rng.choice(letters, 60)) for _ in range(150)] + [None]
    texts += [r[0] for r in spark.read.parquet(f"{small}/documents.parquet").select("text").limit(60).collect()]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows[::-1], "doc_id long, text string").repartition(5)
    path = public_tokenizers.path(name)
    found = token_files.round_trip(docs, path, end, file_ids=3000, with_ids=True).orderBy("doc_id").collect()
    at = 0
    for row, (doc_id, _), ids in zip(found, rows, plain_ids(name, texts, end), strict=True):
        raw = np.array(ids, "<u4").tobytes()
        assert tuple(row) == (doc_id, at, len(ids), zlib.crc32(raw), ids)
        at += len(ids)


def test_token_files_on_disk(spark, odd_docs, no_docs):
    path = public_tokenizers.path("word_bpe_49k.json")
    folder = staging_path(spark, "own")
    files = token_files.write_token_files(odd_docs, path, folder, 2, file_ids=5000)
    rows = sorted(files.collect(), key=lambda r: r["base"])
    assert len(rows) > 2 and sum(r["docs"] for r in rows) == odd_docs.count() and sum(r["null_ids"] for r in rows) == 1
    assert [r["base"] for r in rows] == [0, *itertools.accumulate(r["ids"] for r in rows)][:-1]
    for r in rows:
        ids = np.fromfile(f"{r['path']}.bin", "<u2")
        index = np.fromfile(f"{r['path']}.idx", "<i8")
        assert r["width"] == 2 and len(ids) == r["ids"] == index[r["docs"]] and len(index) == 2 * r["docs"] + 1
        assert all(ids[index[1: r["docs"] + 1] - 1] == 2)
    back = token_files.read_token_files(files, folder).collect()
    in_order = [r["doc_id"] for r in sorted(back, key=lambda r: r["start"])]
    assert in_order == [None, 1, 2, 3, 4, 5, 6, 6, 7, 8, 8, 9]
    assert token_files.round_trip(no_docs, path, 2).collect() == []


def test_text_slices_of_the_encoder():
    text = "word next\tline\nlast " * 50 + "y" * 100
    assert "".join(token_files.slices(text, 30)) == text
    encode, _ = token_files.file_encoder(public_tokenizers.path("word_bpe_49k.json"))
    assert encode(text).tolist() == plain_ids("word_bpe_49k.json", [text], 2)[0][:-1]


# collocations

def brute_phrases(docs, threshold, longest, share, kept):
    counts, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in docs:
        lang = lang or "und"
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for n in range(1, longest + 1):
                counts[lang].update(tuple(words[i: i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= threshold}
        inside = set()
        for p, a in candidates.items():
            for n in range(2, len(p)):
                inside |= {p[i: i + n] for i in range(len(p) - n + 1) if 100 * a >= share * candidates[p[i: i + n]]}
        rows = []
        for p, a in candidates.items():
            if p not in inside:
                score, k = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for i, (score, a, phrase, left, right) in enumerate(sorted(rows)[:kept]):
            out.append((lang, i + 1, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.mark.parametrize("threshold, longest, share, kept", [(5, 5, 100, 2000), (2, 3, 60, 7), (1, 2, 100, 50)])
def test_collocations_are_brute_force(spark, small, threshold, longest, share, kept):
    docs = spark.read.parquet(f"{small}/documents.parquet").select("lang", "text").limit(100)
    rows = [tuple(r) for r in docs.collect()] + [(None, t) for t in NASTY * 3] + [("en", None), ("und", "a b a b a b")]
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(6)
    found = collocations.collocations(docs, threshold, longest, share, kept)
    assert sorted(map(tuple, found.collect())) == brute_phrases(rows, threshold, longest, share, kept)


def test_collocations_of_odd_rows(spark, odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select("lang", "text").collect()]
    found = collocations.collocations(odd_docs, 2)
    assert sorted(map(tuple, found.collect())) == brute_phrases(rows, 2, 5, 100, 2000)
    assert collocations.collocations(no_docs).collect() == []


def test_chunks_and_slices_lose_no_run():
    rng = np.random.default_rng(5)
    texts = [" ".join(rng.choice(["a", "b", "C,", "d.", "e\n", "f"], 400)) for _ in range(6)]
    wanted = collections.Counter()
    for text in texts:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text.translate(LOWER)):
            w = piece.split()
            wanted.update((n, tuple(w[i: i + n])) for n in (1, 2, 3) for i in range(len(w) - n + 1))
    for chunk, size in ((17, 9), (50, 1000), (10_000, 31)):
        stream, ids, found = collocations.RunStream(3, chunk, size), collocations.WordIds(), collections.Counter()

        def take(s):
            for n, starts in collocations.runs(ids(s.tokens), s.skip, 3):
                found.update((n, tuple(t.decode() for t in s.tokens[i: i + n])) for i in starts)

        for text in texts:
            for s in stream.add("en", text):
                take(s)
        take(stream)
        assert found == wanted


def test_summaries_keep_every_frequent_key():
    rng = np.random.default_rng(7)
    keys = rng.zipf(1.3, 200_000).astype(np.uint64) % np.uint64(5000)
    true = collections.Counter(keys.tolist())
    for threshold in (50, 400, 3000):
        capacity = len(keys) // threshold + 1
        summary = collocations.Summary(capacity)
        for part in np.array_split(keys, 97):
            k, c = np.unique(part, return_counts=True)
            summary.merge(k, c.astype(np.int64))
            summary.settle()
        assert len(summary.keys) <= capacity and summary.error < threshold
        kept = set(summary.at_least(threshold).tolist())
        assert {k for k, n in true.items() if n >= threshold} <= kept
        for k, n in zip(summary.keys.tolist(), summary.counts.tolist()):
            assert true[k] - summary.error <= n <= true[k]


def test_a_small_filter_loses_nothing(spark):
    keys = np.random.default_rng(1).integers(-2**63, 2**63 - 1, 5000)
    rows = spark.createDataFrame([(int(k),) for k in keys], "key long")
    for most in (1 << 29, 1 << 16):
        made = collocations.key_filter(rows, most)
        assert made.bits <= most and made.passes(keys.view(np.uint64)).all()
    other = np.random.default_rng(2).integers(-2**63, 2**63 - 1, 5000).view(np.uint64)
    assert collocations.key_filter(rows).passes(other).mean() < 0.02


def test_queries_read_whole_tables(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    tokens = queries.QUERIES["op12_token_files"](spark, small)
    assert tokens.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and tokens.count() == docs.count()
    assert queries.QUERIES["op11_target_resampling"](spark, small).count() == docs.count()
