"""Vector, URL and archive operators against brute force on small tables, and on odd rows."""

from __future__ import annotations

import base64
import collections
import hashlib
import io
import itertools
import zipfile

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.llm import collision_search, nn_descent, queries, url_rank, zipped_archive


def vectors(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    return np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], np.float64)


def cosines(x):
    norm = np.sqrt((x * x).sum(axis=1))
    return (x @ x.T) / norm[:, None] / norm[None, :]


# search

def test_search_recall_and_scores(spark):
    folder = "/root/testdata/sf0.1"
    ids, x = vectors(spark, folder)
    near = cosines(x)
    rows = queries.search(spark, folder).collect()
    found = collections.defaultdict(list)
    for r in rows:
        found[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    place = {v: i for i, v in enumerate(ids)}
    asked = [v for v in ids if v % 50 == 0]
    assert sorted(found) == sorted(asked)
    hits = 0
    for q in asked:
        got = sorted(found[q])
        assert [g[0] for g in got] == [1, 2, 3, 4, 5]
        assert all(g[2] == pytest.approx(near[place[q], place[g[1]]], abs=1e-12) for g in got)
        others = np.delete(ids, place[q])
        best = others[np.lexsort((others, -np.delete(near[place[q]], place[q])))[:5]]
        hits += len({g[1] for g in got} & set(best))
    assert hits >= 0.9 * 5 * len(asked)


def test_search_of_odd_rows(spark, odd_vectors):
    rows = collision_search.nearest(odd_vectors, F.col("vec_id") % 50 == 0, 3).collect()
    found = collections.defaultdict(list)
    for r in sorted(rows, key=lambda r: (r["query_id"], r["rank"])):
        found[r["query_id"]].append(r["vec_id"])
    assert found == {50: [3, 100, 4], 100: [3, 50, 4], 150: [12]}
    assert collision_search.nearest(odd_vectors.limit(0), F.col("vec_id") % 50 == 0).count() == 0


def test_search_among_many_copies(spark):
    rng = np.random.default_rng(5)
    rows = [(i, [1.0, 0.5, 0.0, 0.2]) for i in range(200)]
    rows += [(200 + i, v.tolist()) for i, v in enumerate(rng.standard_normal((100, 4)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    found = collision_search.nearest(df, F.col("vec_id") == 150, 5).orderBy("rank").collect()
    assert [r["vec_id"] for r in found] == [0, 1, 2, 3, 4]


# near duplicates

def brute_links(ids, x, threshold=0.9):
    near = cosines(x) >= threshold
    np.fill_diagonal(near, False)
    low = {}
    for i, v in enumerate(ids):
        if i in low:
            continue
        reach, todo = {i}, [i]
        while todo:
            for j in np.nonzero(near[todo.pop()])[0]:
                if int(j) not in reach:
                    reach.add(int(j))
                    todo.append(int(j))
        low |= dict.fromkeys(reach, min(ids[list(reach)]))
    return {int(v): (int(near[i].sum()), int(low[i])) for i, v in enumerate(ids)}


def planted(rng, dim=32):
    base = rng.standard_normal((300, dim))
    parts = [base]
    for i, n in enumerate((1, 2, 5, 40, 80)):
        parts.append(base[i] + 0.05 * rng.standard_normal((n, dim)))
    parts.append(np.repeat(base[10:11], 30, axis=0))
    chain = [base[20]]
    for _ in range(6):
        chain.append(chain[-1] + 0.35 * rng.standard_normal(dim))
    parts.append(np.array(chain))
    return np.concatenate(parts).astype(np.float32)


def test_near_duplicates_are_brute_force(spark):
    x = planted(np.random.default_rng(7))
    ids = np.random.default_rng(8).permutation(len(x))
    df = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, x)], "vec_id long, embedding array<float>")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in nn_descent.near_duplicates(df).collect()}
    assert found == brute_links(ids, x.astype(np.float64))


def test_near_duplicate_query(spark, small):
    ids, x = vectors(spark, small)
    rows = queries.embedding_dedup(spark, small).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in rows} == brute_links(ids, x)
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in rows)


def test_near_duplicates_of_odd_rows(spark, odd_vectors):
    rows = nn_descent.near_duplicates(odd_vectors).collect()
    found = sorted((tuple(r) for r in rows), key=str)
    assert len(found) == odd_vectors.count()
    by_id = {r[0]: r for r in found}
    assert by_id[50][1:] == (3, 3, False) and by_id[3][1:] == (3, 3, True) and by_id[4][1:] == (3, 3, False)
    assert by_id[5][1:3] == (2, 5) and by_id[12][1:] == (1, 12, True)
    for i in (6, 7, 8, 9, 10, 13):
        assert by_id[i][1:] == (0, i, True)
    assert by_id[None][1:] == (0, None, False)
    assert nn_descent.near_duplicates(odd_vectors.limit(0)).count() == 0


# urls

def plain_rule(url):
    if url is None or "://" not in url:
        return "", "", None
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host, tail = rest[:end], rest[end:]
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host)
    path = tail[: min([tail.find(c) for c in "?#" if c in tail], default=len(tail))]
    best = None
    for verdict, rule in url_rank.RULES:
        name, start = rule.split("/", 1)
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start):
            if best is None or len(rule) > len(best[1]):
                best = (verdict, rule)
    return host, path, best


def test_url_query_follows_the_rules(spark, small):
    pages = {r["page_id"]: r["url"] for r in spark.read.parquet(f"{small}/pages.parquet").collect()}
    rows = queries.url_filter(spark, small).collect()
    assert len(rows) == len(pages)
    for r in rows:
        host, path, best = plain_rule(pages[r["page_id"]])
        assert (r["host"], r["path"]) == (host, path)
        assert r["rule"] == (best[1] if best else None)
        assert r["verdict"] == best[0] if best else r["verdict"] in ("allow", "block")


def test_urls_of_odd_rows(spark):
    urls = [None, "", "no host", "http://", "http://NET", "http://net/", "HTTPS://a.Net?x/", "ftp://u@example.NET/en/a#b",
            "x://example.com/de/?q", "http://org/fr", "http://a.org/fr/x\ny", "http://notnet/", "a://b://c/d", "://net/q"]
    rows = [(i, u, None if i % 2 else "<a href=x>", 1.0) for i, u in enumerate(urls)] + [(None, "http://net/", None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, trust double")
    found = url_rank.filter_urls(pages).collect()
    assert len(found) == len(rows)
    for r in found:
        host, path, best = plain_rule(urls[r["page_id"]] if r["page_id"] is not None else "http://net/")
        assert (r["host"], r["path"], r["rule"]) == (host, path, best and best[1])
        assert r["verdict"] == best[0] if best else r["verdict"] in ("allow", "block")
    assert url_rank.filter_urls(pages.limit(0)).count() == 0


def test_scores_are_brute_force_page_rank(spark):
    rng = np.random.default_rng(4)
    hosts = [f"h{i}" for i in range(12)]
    links = sorted({(hosts[a], hosts[b]) for a, b in rng.integers(0, 12, (40, 2)) if a != b})
    seeds = [("h0", 1.0, 0.0), ("h1", 0.5, 0.5), ("h2", 0.0, 1.0)]
    scores = url_rank.host_scores(
        spark.createDataFrame(seeds, "host string, allowed double, blocked double"),
        spark.createDataFrame([(a, b, 1) for a, b in links], "src string, dst string, links long"),
    )
    found = {r["host"]: (r["trust"], r["distrust"]) for r in scores.collect()}
    for column, flip in ((1, False), (2, True)):
        ways = [(b, a) if flip else (a, b) for a, b in links]
        out = collections.Counter(a for a, _ in ways)
        start = {s[0]: s[column] for s in seeds}
        rank = dict(start)
        for _ in range(url_rank.ROUNDS):
            fresh = collections.Counter(start)
            for a, b in ways:
                fresh[b] += 0.85 * rank.get(a, 0.0) / out[a]
            rank = fresh
        for h in hosts:
            assert found.get(h, (0.0, 0.0))[column - 1] == pytest.approx(rank.get(h, 0.0))


def test_distrust_spreads_to_hosts_that_link_to_blocked_ones(spark):
    spam = '<a href="http://bad.net/x"> <a href="//worse.net/y">'
    good = "<a href='https://m.example.net/en/1'>"
    rows = [(1, "http://bad.net/1", ""), (2, "http://worse.net/1", ""), (3, "http://farm.info/1", spam),
            (4, "http://kind.info/1", good), (5, "http://m.example.net/en/1", "<a href=http://kind.info/>"), (6, "http://lone.info/", "")]
    found = {r["page_id"]: r["verdict"] for r in
             url_rank.filter_urls(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert found == {1: "block", 2: "block", 3: "block", 4: "allow", 5: "allow", 6: "allow"}


# archives

def want_records(rows, min_bytes=0):
    groups = collections.defaultdict(list)
    for page_id, html in rows:
        groups[html or ""].append(page_id)
    out = []
    for html, ids in groups.items():
        raw = html.encode()
        digest = base64.b32encode(hashlib.sha1(raw).digest()).decode()
        known = [i for i in ids if i is not None]
        best = max(known) if known else None
        left = False
        for i in sorted(ids, key=lambda i: (i is not None, i or 0), reverse=True):
            response = len(raw) < min_bytes or not left
            left = True
            out.append((i, len(raw), digest, "response" if response else "revisit", None if response else best))
    return sorted(out, key=str)


def test_archive_query_round_trip(spark, small):
    pages = spark.read.parquet(f"{small}/pages.parquet")
    pages = pages.select("page_id", "html").collect()
    found = sorted((tuple(r) for r in queries.archives(spark, small).collect()), key=str)
    assert found == want_records([tuple(r) for r in pages])


def test_archives_of_odd_rows(spark):
    rows = [(1, "http://a/b c\r\nd", "same", 1), (9, None, "same", 2), (9, None, "same", 2), (3, "u", None, 3),
            (4, "u", "", 4), (None, "u", "same", 5), (5, "ü", "Größe \r\n\r\n x", 6), (None, None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, sha1 int")
    for least in (0, 2):
        found = sorted((tuple(r) for r in zipped_archive.round_trip(pages, least).collect()), key=str)
        assert found == want_records([(r[0], r[2]) for r in rows], least)
    assert zipped_archive.round_trip(pages.limit(0)).count() == 0


class Kept(io.BytesIO):
    def close(self):
        pass


def ranges(raw):
    return lambda offset, n: raw[offset: offset + n]


@pytest.mark.parametrize("note", [b"", b"a comment with PK\x05\x06 in it"])
def test_directories_written_by_others(note):
    stream = io.BytesIO()
    with zipfile.ZipFile(stream, "w", zipfile.ZIP_STORED) as z:
        z.writestr("a.txt", b"first")
        with z.open("b.bin", "w", force_zip64=True) as f:
            f.write(b"second")
        z.writestr("c", b"packed " * 50, zipfile.ZIP_DEFLATED)
        z.comment = note
    raw = stream.getvalue()
    members = zipped_archive.read_directory(ranges(raw), len(raw))
    assert list(members) == ["a.txt", "b.bin", "c"]
    start = zipped_archive.data_start(ranges(raw), members["b.bin"])
    assert raw[start: start + members["b.bin"].size] == b"second"
    with pytest.raises(ValueError, match="compressed"):
        zipped_archive.data_start(ranges(raw), members["c"])


def test_own_packages_are_read_by_others():
    stream = Kept()
    writer = zipped_archive.PackageWriter(stream)
    for name, parts in (("x/ä", [b"one", b"two"]), ("empty", [])):
        writer.begin(name)
        for part in parts:
            writer.add(part)
        writer.finish()
    writer.close()
    with zipfile.ZipFile(io.BytesIO(stream.getvalue())) as z:
        assert z.testzip() is None and z.read("x/ä") == b"onetwo" and z.read("empty") == b""
    raw = stream.getvalue()
    assert [m.size for m in zipped_archive.read_directory(ranges(raw), len(raw)).values()] == [6, 0]


@pytest.mark.parametrize("raw", [b"", b"not a package at all", b"PK\x05\x06"])
def test_broken_packages(raw):
    with pytest.raises(ValueError):
        zipped_archive.read_directory(ranges(raw), len(raw))


def test_groups_whose_lists_are_full_still_meet(spark):
    """Two dense groups, far more links inside each than a list holds, and links between them."""
    rng = np.random.default_rng(12)
    centre, other = np.eye(32)[0], np.eye(32)[1]
    angle = 0.42
    second = np.cos(angle) * centre + np.sin(angle) * other
    x = np.concatenate([c + 0.022 * rng.standard_normal((200, 32)) for c in (centre, second)]).astype(np.float32)
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    across = near[:200, 200:].mean()
    assert 0.05 < across < 0.9 and near[:200, :200].sum() == 200 * 199
    rows = [(i, list(map(float, v))) for i, v in enumerate(x)]
    found = nn_descent.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), 0.9).collect()
    assert {r["component_id"] for r in found} == {0}
    assert {r["vec_id"]: r["n_links"] for r in found} == dict(enumerate(near.sum(axis=1).tolist()))
