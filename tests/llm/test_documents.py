"""Document operators against brute force on small tables, and on odd rows."""

from __future__ import annotations

import collections
import itertools
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from holdfast.llm import best_fit, language_kn, mixing, quality_knn, queries, secret_forest, simhash_tiles
from holdfast.llm.common import connected_components, running_start


def documents(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def closure(nodes, links):
    """Smallest node that links reach, for each node."""
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            if low[a] != m or low[b] != m:
                low[a] = low[b] = m
                changed = True
    return low


# shared helpers

def test_running_start_covers_each_group_without_gaps(spark):
    df = spark.range(500).select(
        (F.col("id") % 3).alias("g"), F.col("id").alias("k"), (F.col("id") % 5).alias("size"))
    rows = running_start(df, ["g"], F.col("size"), [F.col("k")], buckets=7).collect()
    assert len(rows) == 500
    for g in range(3):
        spans = sorted((r["start"], r["size"]) for r in rows if r["g"] == g and r["size"])
        assert spans[0][0] == 0
        assert all(a + n == b for (a, n), (b, _) in itertools.pairwise(spans))


@pytest.mark.parametrize("links", [
    [], [(1, 1)], [(5, 4), (4, 3), (3, 2), (2, 1), (9, 8)], [(10, i) for i in range(9)],
    [(i, i + 1) for i in range(0, 40)] + [(100, 20), (101, 102)],
])
def test_components(spark, links):
    found = {r["node"]: r["component"] for r in
             connected_components(spark.createDataFrame(links, "src long, dst long")).collect()}
    real = [x for x in links if x[0] != x[1]]
    assert found == closure({n for x in real for n in x}, real)


# fingerprints

def fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[i: i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(r, seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_brute(rows):
    prints = [fingerprint(text) for _, text in rows]
    links = [(i, j) for i, j in itertools.combinations(range(len(rows)), 2)
             if (prints[i] ^ prints[j]).bit_count() <= 2]
    low = closure(range(len(rows)), links)
    ids = collections.defaultdict(list)
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[low[i]].append(doc_id)
    return sorted(((d, f"{p:016x}", min(ids[low[i]], default=None)) for i, ((d, _), p) in
                   enumerate(zip(rows, prints))), key=str)


def test_simhash_query_is_brute_force(spark, small):
    rows = [tuple(r) for r in documents(spark, small).select("doc_id", "text").collect()]
    found = [tuple(r) for r in queries.simhash(spark, small).collect()]
    assert sorted(found, key=str) == simhash_brute(rows)


def test_simhash_of_odd_rows(spark, odd_docs, no_docs):
    rows = [tuple(r) for r in odd_docs.select("doc_id", "text").collect()]
    df = simhash_tiles.simhash_groups(odd_docs)
    found = [(r["doc_id"], f"{r['fp'] % 2**64:016x}", r["component_id"]) for r in df.collect()]
    assert sorted(found, key=str) == simhash_brute(rows)
    assert simhash_tiles.simhash_groups(no_docs).count() == 0


def test_tiles_find_all_links_of_close_fingerprints(spark):
    rng = np.random.default_rng(1)
    base = [int(x) for x in rng.integers(0, 2**63, 40)]
    near = {b ^ (1 << int(rng.integers(0, 63))) ^ (1 << int(rng.integers(0, 63))) for b in base * 4}
    values = sorted({*base, *near, 0, 1, 3, 7, 15})
    df = spark.createDataFrame([(v,) for v in values], "fp long")
    found = {r["node"]: r["component"] for r in
             connected_components(simhash_tiles.tile_links(df)).collect()}
    links = [(a, b) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= 2]
    assert {v: found.get(v, v) for v in values} == closure(values, links)


def test_keep_one_keeps_one_row_of_each_group(spark, odd_docs, no_docs):
    kept = simhash_tiles.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 3, 6, 7, 8, 9]
    assert simhash_tiles.keep_one(no_docs).count() == 0


# packing

def check_packing(rows, capacity):
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for spans in bins.values():
        spans.sort()
        assert spans[0][0] == 0 and sum(spans[-1]) <= capacity
        assert all(sum(a) == b[0] for a, b in itertools.pairwise(spans))
        assert sum(3 * n > capacity for _, n in spans) <= 2
    return bins


def test_packing_query(spark, small):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    rows = queries.packing(spark, small).collect()
    pieces = collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    texts = {r["doc_id"]: r["text"] for r in documents(spark, small).collect()}
    assert set(pieces) == set(texts)
    for doc_id, text in texts.items():
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        at = 0
        for n, r in enumerate(sorted(pieces[doc_id], key=lambda r: r["piece"])):
            part = np.array(ids[at: at + r["length"]], "<u4").tobytes()
            assert (r["piece"], r["start"], r["ids_crc32"]) == (n, at, zlib.crc32(part))
            assert n == 0 or r["length"] == 2048
            at += r["length"]
        assert at == len(ids) and len(pieces[doc_id]) == -(-at // 2048)
    bins = check_packing(rows, 2048)
    assert len(bins) <= 1.01 * sum(r["length"] for r in rows) / 2048 + 1


@pytest.mark.parametrize("counts, most", [
    ({10: 1}, 1), ({10: 7, 4: 3, 6: 3}, 10), ({6: 5, 5: 4, 4: 5, 1: 3}, 8), ({1: 25}, 3), ({3: 7}, 3),
    ({2: 1, 9: 2, 1: 2}, 3), ({}, 0),
])
def test_plan(counts, most):
    rows = best_fit.plan_bins(counts, 10)
    placed = [
        {"sequence_id": sequence + i, "offset": offset, "length": length, "item": (length, first + i)}
        for length, first, n, sequence, offset in rows for i in range(n)
    ]
    assert sorted(p["item"] for p in placed) == sorted((x, i) for x, n in counts.items() for i in range(n))
    assert len(check_packing(placed, 10)) == most


def test_plan_size_does_not_grow_with_items():
    few = best_fit.plan_bins({n: 1000 for n in range(1, 2049)}, 2048)
    many = best_fit.plan_bins({n: 10**9 for n in range(1, 2049)}, 2048)
    assert len(many) < 2 * len(few) < 100_000


@pytest.mark.parametrize("text", [
    "a  b\n\nc\t d ", "it's they'll 'S 12a!! \u00a0 x\u2003 y", "\x1c a \x85b", "<|endoftext|> x", "ñ é\r\n ß 日本 語!?",
    " lead", "x\u00a0 y", "a\x0b\x0cb", "",
    "A b, c.\nD e's\nf", "\na b", "a b\n", "a \nb", "12 a1 !?x\nß9", " ", "\n",
])
def test_encoder_gives_the_ids_of_the_tokenizer(text):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    ids = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert best_fit.make_encoder(path)(text) == np.array(ids, "<u4").tobytes()


@pytest.mark.parametrize("text", [
    "a<|endoftext|>b", "x" + " " * 1_500_000 + "y", "x" + "\n " * 800_000, "ab" * 300_000,
    "\x1c a\x85b\u3000c\ufeff", "\u6f22\u5b57 \u0661\u0662 I'll we'VE  \r\n\r\n",
], ids=["special", "spaces", "breaks", "long", "rare", "scripts"])
def test_encoder_on_unusual_texts(text):
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    ids = Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids
    assert best_fit.make_encoder(path)(text) == np.array(ids, "<u4").tobytes()


def test_packing_of_odd_rows(spark, odd_docs, no_docs):
    path = queries.tokenizer_path()
    packed = best_fit.pack(odd_docs, path, 256, with_ids=True)
    rows = packed.collect()
    check_packing(rows, 256)
    assert sum(r["piece"] == 0 for r in rows) == odd_docs.count()
    assert [r["length"] for r in rows if r["doc_id"] in (3, 4)] == [1, 1]
    whole = best_fit.sequences(packed).collect()
    assert sum(len(r["ids"]) for r in whole) == sum(r["length"] for r in rows)
    assert best_fit.pack(no_docs, path).count() == 0


# mixing

def share_out(sizes, weights, total):
    """Targets by giving out the excess again and again."""
    target, free = dict.fromkeys(sizes, 0.0), set(sizes)
    while free:
        left = total - sum(target[s] for s in sizes if s not in free)
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > 2 * sizes[s]}
        target |= share
        if not over:
            break
        target |= {s: 2.0 * sizes[s] for s in over}
        free -= over
    return target


def test_mixing_query(spark, small):
    rows = queries.mix(spark, small).collect()
    sources = {r["doc_id"]: (r["source"], r["text"]) for r in documents(spark, small).collect()}
    assert len(rows) == len(sources)
    sizes, taken = collections.Counter(), collections.Counter()
    for r in rows:
        source, text = sources[r["doc_id"]]
        assert r["size"] == len((text or "").encode().split()) and 0 <= r["taken"] <= 2 * r["size"]
        sizes[source] += r["size"]
        taken[source] += r["taken"]
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    target = share_out(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}, 1.5 * sum(sizes.values()))
    for r in rows:
        source = sources[r["doc_id"]][0]
        assert r["target"] == pytest.approx(target[source]) and r["source_size"] == sizes[source]
    for s in names:
        assert abs(taken[s] - target[s]) <= 2 * mixing.BLOCK
    again = queries.mix(spark, small).repartition(3).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows))


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 10, "c": 10}, {"a": 1, "b": 1000}, {"a": 0, None: 7}])
def test_targets(spark, sizes):
    keyed = {("n" if s is None else f"a{s}"): n for s, n in sizes.items()}
    rows = mixing.targets(spark.createDataFrame(list(keyed.items()), "source_key string, source_size long"))
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(keyed))}
    want = share_out(keyed, weights, 1.5 * sum(keyed.values()))
    assert {r["source_key"]: r["target"] for r in rows.collect()} == pytest.approx(want)


@pytest.mark.parametrize("n", [1, 2, 7, 64, 1000])
def test_permutation(spark, n):
    df = spark.range(n).select(F.col("id"), F.col("id").alias("i"), F.lit(n).cast("long").alias("n"))
    rows = mixing.permuted(df, "i", "n", [F.lit("salt")]).collect()
    assert sorted(r["i"] for r in rows) == list(range(n))
    assert n < 64 or sum(r["i"] == r["id"] for r in rows) < n / 10


def test_shards_draw_sources_at_their_shares(spark):
    sizes = spark.createDataFrame([("aa", 320_000), ("ab", 640_000), ("ac", 3_200_000)],
                                  "source_key string, source_size long")
    sources = mixing.targets(sizes).selectExpr(
        "*", "cast(source_size / 32 as long) blocks", "cast(target / 32 as long) quota",
    ).withColumn("first_slot", F.expr("coalesce(sum(quota) over (order by rank rows between unbounded "
                                      "preceding and 1 preceding), 0)")
                 ).withColumn("slots", F.expr("sum(quota) over ()"))
    slots = mixing.slots(sources)
    row = slots.agg(F.count("*"), F.countDistinct("slot"), F.max("slot")).first()
    assert row[0] == row[1] == row[2] + 1
    counts = collections.defaultdict(collections.Counter)
    for r in slots.groupBy("shard", "source_key").count().collect():
        counts[r["shard"]][r["source_key"]] = r["count"]
    share = {r["source_key"]: r["quota"] / row[0] for r in sources.collect()}
    full = [c for c in counts.values() if sum(c.values()) == mixing.SHARD_SLOTS]
    assert len(full) > 20 and len({c["aa"] for c in full}) > 5
    for c in full:
        for s, p in share.items():
            assert abs(c[s] - 4096 * p) < 6 * (4096 * p * (1 - p)) ** 0.5
    reuse = slots.groupBy("source_key", "epoch", "block").count().agg(F.max("count")).first()[0]
    assert reuse == 1


def test_mixing_of_odd_rows(spark, odd_docs, no_docs):
    rows = mixing.taken_words(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert all(r["taken"] == 0 for r in rows if r["size"] == 0)
    mixed = mixing.mixed_documents(odd_docs)
    assert mixed.columns == odd_docs.columns
    total = sum(len((r["text"] or "").split()) for r in mixed.collect())
    assert total == sum(r["taken"] for r in rows)
    assert mixing.taken_words(no_docs).count() == mixing.mixed_documents(no_docs).count() == 0


def test_mixed_documents_hold_the_words_taken(spark, small):
    docs = documents(spark, small)
    want = {r["doc_id"]: r["taken"] for r in mixing.taken_words(docs).collect() if r["taken"]}
    found = collections.Counter()
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in mixing.mixed_documents(docs).collect():
        words = r["text"].encode().split()
        assert not collections.Counter(words) - collections.Counter(texts[r["doc_id"]].encode().split())
        found[r["doc_id"]] += len(words)
    assert sum(found.values()) == pytest.approx(sum(want.values()), rel=0.02)


# quality

def test_quality_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    rows = queries.quality(spark, folder).join(labels, "doc_id").filter("held_out").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    good = [r["predicted"] for r in rows if r["quality"] == 1]
    bad = [r["predicted"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.98 * len(good) and sum(bad) <= 0.1 * len(bad)


def test_quality_votes_are_brute_force(spark, small):
    docs = documents(spark, small)
    model = quality_knn.fit(docs, spark.read.parquet(f"{small}/labels.parquet"))
    found = {r["doc_id"]: r["quality_score"] for r in quality_knn.score(docs, model).collect()}
    for r in docs.limit(25).collect():
        near = model.vectors @ model.latent(quality_knn.features(r["text"])[None])[0]
        top = np.argsort(-near, kind="stable")[: model.neighbours]
        pull = np.maximum(near[top], 0).astype(float) ** 8
        assert found[r["doc_id"]] == pytest.approx((pull * model.labels[top]).sum() / pull.sum(), abs=1e-3)


def test_quality_does_not_depend_on_length(spark):
    text = "spam " * 40 + "some other words of a text, each of them once or twice here. "
    short, long = quality_knn.features(text), quality_knn.features(text * 200)
    assert long[-1] > 65535 and long[-1] == 200 * short[-1]
    shares = [np.sqrt(x / x.sum()) for x in (short, long)]
    assert np.abs(shares[0] - shares[1]).max() < 0.03
    row = quality_knn.counted(spark.createDataFrame([(1.0, text * 200)], "label double, text string")).first()
    assert np.array_equal(np.frombuffer(zlib.decompress(row["counts"]), np.float32), long)


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([(1, 1), (2, 0), (6, 1), (None, 1), (9, None)], "doc_id long, quality int")
    model = quality_knn.fit(odd_docs, labels)
    rows = quality_knn.score(odd_docs, model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r["quality_score"] <= 1 for r in rows)
    assert quality_knn.score(no_docs, model).count() == 0
    none = quality_knn.fit(no_docs, labels)
    assert {r["quality_score"] for r in quality_knn.score(odd_docs, none).collect()} == {0.5}


# language

def test_every_language_is_learned_however_rare(spark):
    """Forty scripts of unequal size, one with a single document: none is crowded out."""
    rng = np.random.default_rng(8)
    starts = [0x0370, 0x0430, 0x0561, 0x05D0, 0x0628, 0x0905, 0x0E01, 0x10D0, 0x1200, 0x13A0]
    rows = []
    for k in range(40):
        letters = [chr(starts[k % 10] + 4 * (k // 10) + i) for i in range(6)]
        for _ in range(1 if k == 39 else 4 if k == 38 else 40):
            text = " ".join("".join(rng.choice(letters, 5)) for _ in range(30))
            rows.append((len(rows), text, f"l{k:02d}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_kn.fit(docs)
    assert model.languages == sorted({r[2] for r in rows})
    found = {r["doc_id"]: r["lang_pred"] for r in language_kn.predict(docs, model).collect()}
    assert all(found[i] == lang for i, _, lang in rows if lang in ("l38", "l39"))
    assert np.mean([found[i] == lang for i, _, lang in rows]) > 0.95
    few = language_kn.fit(docs, sample_all=100)
    assert few.languages == model.languages


def test_language_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.1"
    docs = documents(spark, folder)
    rows = queries.language(spark, folder).join(docs.select("doc_id", "lang", "text"), "doc_id").collect()
    assert len(rows) == docs.count() and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.995 * len(held)
    assert sum(r["rejected"] for r in held) <= 0.02 * len(held)


def test_kneser_ney_is_a_distribution():
    rng = np.random.default_rng(3)
    codes = np.concatenate(([0], rng.integers(2, 6, 400), [0])).astype(np.uint64)
    keys, counts = np.unique(language_kn.grams(codes), return_counts=True)
    model = language_kn.KneserNey.fit(keys, counts, 6)
    for context in (keys[5] >> np.uint64(12), np.uint64(0), np.uint64((5 << 24) | (5 << 12) | 5)):
        tails = (context << np.uint64(12)) | np.arange(6, dtype=np.uint64)
        assert np.exp(model.log_prob(tails)).sum() == pytest.approx(1, abs=0.02)


def test_language_of_odd_rows(spark, odd_docs, no_docs):
    model = language_kn.fit(odd_docs)
    rows = {r["doc_id"]: r for r in language_kn.predict(odd_docs, model).collect()}
    assert {rows[i]["lang_pred"] for i in (3, 4, 5, 7)} == {"und"}
    assert rows[9]["lang_pred"] == "de" and rows[1]["lang_pred"] == "en"
    assert language_kn.predict(no_docs, model).count() == 0
    none = language_kn.fit(no_docs)
    assert {r["lang_pred"] for r in language_kn.predict(odd_docs, none).collect()} == {"und"}


# secrets

def test_secret_query_finds_assigned_tokens(spark):
    import re

    folder = "/root/testdata/sf0.01"
    rows = queries.secrets(spark, folder).filter("is_secret").collect()
    found = collections.Counter(r["doc_id"] for r in rows)
    want = collections.Counter()
    for r in documents(spark, folder).collect():
        n = len(re.findall(r'(?i)token = "[0-9a-f]{40}"', r["text"] or ""))
        if n:
            want[r["doc_id"]] = n
    assert found == want


def test_forest_expression_is_the_forest(spark):
    forest = secret_forest.Forest(2, (0, 1, 2, 3, 4, 5), (0.5, 0.5, 0.5, 0.5, 0.5, float("inf")),
                                  (0.0, 0.2, 0.4, 0.6, 0.1, 0.3, 0.5, 0.7))
    rng = np.random.default_rng(2)
    rows = [(x.tolist(),) for x in rng.random((40, len(secret_forest.FEATURES)))]
    df = spark.createDataFrame(rows, "f array<double>").select("f", forest.probability(F.col("f")).alias("p"))
    for r in df.collect():
        total = 0.0
        for t in range(2):
            node = 0
            for _ in range(2):
                node = 2 * node + (2 if r["f"][forest.features[3 * t + node]] > forest.cuts[3 * t + node] else 1)
            total += forest.chances[4 * t + node - 3]
        assert r["p"] == pytest.approx(total / 2)


def test_secrets_of_odd_rows(spark, odd_docs, no_docs):
    token = "0a1b2c3d4e5f60718293a4b5c6d7e8f901234567"
    rows = [
        (i, f'some words token = "{token[i % 20:] + token[: i % 20]}" then 1234567890123456 end', "x/y.py", 7)
        for i in range(40)
    ] + [(50, f"commit {token} and 9876543210987654", None, 1), (None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long")
    forest = secret_forest.fit_on(docs)
    found = secret_forest.scan(docs, forest).collect()
    assert len(found) == 82 and sum(r["is_secret"] for r in found) == 40
    clean = {r["doc_id"]: r for r in secret_forest.redact(docs, forest).collect()}
    assert clean[3]["text"] == 'some words token = "[SECRET]" then 1234567890123456 end'
    assert clean[3]["n_chars"] == len(clean[3]["text"]) and token in clean[50]["text"]
    assert secret_forest.redact(odd_docs, forest).exceptAll(odd_docs).count() == 0
    assert secret_forest.scan(no_docs, secret_forest.fit_on(no_docs)).count() == 0
