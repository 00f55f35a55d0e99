"""The pipeline: stages in order, what each keeps, and its rows."""

from __future__ import annotations

import re

import corpus_pipeline
import pytest
import xxhash


def fingerprint(text: str | None) -> int:
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    runs = [b" ".join(words[i: i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(run, 42) for run in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest_of_groups(rows) -> set[int]:
    """The smallest doc_id of every group of fingerprints linked at 2 or fewer bits, all pairs compared."""
    names: dict[int, int] = {}
    for r in rows:
        fp = fingerprint(r["text"])
        names[fp] = min(names.get(fp, r["doc_id"]), r["doc_id"])
    links = [(a, b) for a in names for b in names if a < b and (a ^ b).bit_count() <= 2]
    for _ in names:
        before = dict(names)
        for a, b in links:
            names[a] = names[b] = min(names[a], names[b])
        if names == before:
            break
    return set(names.values())


def test_stages(spark, small):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "quality_classifier", "simhash_near_dedup", "secret_scan", "source_mixture", "best_fit_packing"]
    docs = spark.read.parquet(f"{small}/documents.parquet")
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{small}/labels.parquet").collect()}
    steps = dict(corpus_pipeline.STAGES)

    good = steps["quality_classifier"](spark, docs, small).cache()
    kept = {r["doc_id"] for r in good.collect()}
    assert good.columns == docs.columns
    fine = [d for d, q in labels.items() if q == 1]
    assert sum(d in kept for d in fine) >= 0.95 * len(fine)

    single = steps["simhash_near_dedup"](spark, good, small).cache()
    assert {r["doc_id"] for r in single.collect()} == smallest_of_groups(good.collect())

    safe = steps["secret_scan"](spark, single, small).cache()
    assert safe.count() == single.count()
    assert not [r for r in safe.collect() if re.search(r'token = "[0-9a-f]{40}"', r["text"] or "")]

    mixed = steps["source_mixture"](spark, safe, small).cache()
    assert mixed.columns == docs.columns and mixed.count() > 0
    packed = steps["best_fit_packing"](spark, mixed, small)
    assert packed.filter("piece = 0").count() == mixed.count()


def test_run(spark, small):
    rows = corpus_pipeline.run(spark, small)
    assert {"doc_id", "piece", "sequence_id", "offset"} <= set(rows.columns) and rows.count() > 0


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stages_on_odd_rows_and_empty_tables(spark, small, odd_docs, no_docs, name, stage):
    odd, none = stage(spark, odd_docs, small), stage(spark, no_docs, small)
    assert none.collect() == [] and none.columns == odd.columns
    if name != "best_fit_packing":
        assert odd.columns == odd_docs.columns
    if name == "secret_scan":
        assert odd.count() == odd_docs.count()
    if name == "simhash_near_dedup":
        assert sorted(r["doc_id"] or 0 for r in odd.collect()) == [0, 1, 3, 6, 7, 8, 9]
    assert set(r["doc_id"] for r in odd.collect()) <= {None, *range(1, 10)}
