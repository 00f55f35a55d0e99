"""Secrets in texts: candidates by shape, false positives removed by a random forest.

DataFrame functions only: candidates, features and the votes of the fitted trees are expressions, so
a document is judged where it is read, without a shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.session import stage_table

SHAPE = r"(?<![A-Za-z0-9+/_=\-])(?=[A-Za-z+/_=\-]*+[0-9])[A-Za-z0-9+/_=\-]{16,}+"
BEFORE, AFTER = 48, 24
TREES, DEPTH, FINDINGS = 20, 6, 20_000
MASK = "[SECRET]"

#: Words that stand before secrets, before harmless hashes, and in placeholders.
SECRET_WORDS = "token|secret|key|passw(?:or)?d|pwd|auth|bearer|credential|api"
HASH_WORDS = "commit|sha\\d*|md5|hash|digest|checksum|uuid|guid|revision|etag"
DICTIONARY = (
    "example|sample|dummy|placeholder|changeme|password|secret|token|test|your|here|with|this|that|"
    "name|user|admin|default|value|string|index|page|file|image|data|http|www|html|the|and|key"
)

FEATURES = (
    "log_length", "digits", "uppers", "lowers", "symbols", "changes", "repeats", "vowel_steps",
    "hex", "coverage", "path_depth", "path_test", "word_secret", "word_hash", "word_example",
    "assigned", "quoted",
)


def _count(text: Column, pattern: str) -> Column:
    return F.regexp_count(text, F.lit(pattern)).cast("double")


def _flag(text: Column, pattern: str) -> Column:
    return text.rlike(pattern).cast("double")


def _features(token: Column, before: Column, after: Column, path: Column) -> Column:
    size = F.greatest(F.length(token), F.lit(1)).cast("double")
    low = F.lower(before)
    rest = F.length(F.regexp_replace(F.lower(token), DICTIONARY, "")).cast("double")
    values = (
        F.log2(size), _count(token, "[0-9]") / size, _count(token, "[A-Z]") / size,
        _count(token, "[a-z]") / size, _count(token, "[^A-Za-z0-9]") / size,
        _count(token, "[a-z](?=[^a-z])|[A-Z](?=[^A-Z])|[0-9](?=[^0-9])") / size,
        _count(token, "(.)(?=\\1)") / size, _count(F.lower(token), "[aeiou](?=[b-df-hj-np-tv-z])") / size,
        _flag(token, "^(?:[0-9a-f]+|[0-9A-F]+)$"), F.lit(1.0) - rest / size,
        _count(path, "[/\\\\.]"), _flag(F.lower(path), "test|example|sample|doc|fixture"),
        _flag(low, f"(?:{SECRET_WORDS})[a-z0-9_]*\\W*$"), _flag(low, f"(?:{HASH_WORDS})\\W*$"),
        _flag(low, "example|sample|dummy|placeholder|test"), _flag(before, "[:=]\\s*[\"']?$"),
        (_flag(before, "[\"']$") * _flag(after, "^[\"']")),
    )
    return F.array(*values)


def with_candidates(docs: DataFrame, path: str | None = "source") -> DataFrame:
    """Adds ``_gaps``, ``_tokens`` and ``_features`` (arrays; null for null texts) to ``docs``.

    The gaps are what lies between the tokens, so the text is gap, token, gap, ... in turn.
    """
    where = F.coalesce(F.col(path).cast("string"), F.lit("")) if path else F.lit("")
    cut = docs.withColumn("_tokens", F.regexp_extract_all("text", F.lit(SHAPE), F.lit(0))).withColumn(
        "_gaps", F.split("text", SHAPE, -1)
    )
    gaps = F.col("_gaps")
    near = F.transform("_tokens", lambda t, i: F.struct(
        t.alias("token"), F.right(gaps[i], F.lit(BEFORE)).alias("before"),
        F.left(gaps[i + 1], F.lit(AFTER)).alias("after"),
    ))
    return cut.withColumn("_features", F.transform(
        near, lambda c: _features(c["token"], c["before"], c["after"], where)
    ))


def weak_labels(features: Column) -> Column:
    """1 for findings that are assigned to a secret's name, 0 for numbers, hashes and placeholders, else null.

    Stands in for labels by hand where a corpus has none.
    """
    f = {name: features[i] for i, name in enumerate(FEATURES)}
    named = (f["word_secret"] == 1) & (f["assigned"] == 1)
    mixed = (f["digits"] > 0) & (f["digits"] < 0.95) & (f["coverage"] < 0.3)
    plain = (f["digits"] + f["symbols"] >= 0.999) | (f["coverage"] >= 0.5)
    return F.when(named & mixed, 1.0).when(
        plain | (f["word_hash"] == 1) | (f["word_example"] == 1) & ~named, 0.0
    )


@dataclass(frozen=True)
class Forest:
    """Complete binary trees laid end to end: node i of a tree has the children 2i + 1 and 2i + 2.

    ``chances`` holds the leaves of the lowest level. Without trees the forest is a constant.
    """

    depth: int
    features: tuple[int, ...]
    cuts: tuple[float, ...]
    chances: tuple[float, ...]
    constant: float = 0.0

    def probability(self, features: Column) -> Column:
        if not self.chances:
            return F.lit(self.constant)
        inner, leaves = 2**self.depth - 1, 2**self.depth
        trees = len(self.chances) // leaves
        which = F.lit(np.array(self.features, np.int32))
        cuts = F.lit(np.array(self.cuts, np.float64))
        chances = F.lit(np.array(self.chances, np.float64))

        def vote(total: Column, tree: Column) -> Column:
            def step(node: Column, _: Column) -> Column:
                at = tree * inner + node
                right = features[which[at]] > cuts[at]
                return node * 2 + F.when(right, 2).otherwise(1)

            leaf = F.aggregate(F.sequence(F.lit(1), F.lit(self.depth)), F.lit(0), step) - inner
            return total + chances[tree * leaves + leaf]

        return F.aggregate(F.sequence(F.lit(0), F.lit(trees - 1)), F.lit(0.0), vote) / trees


def _read_tree(node, depth: int) -> tuple[list, list, list]:
    """(features, cuts, chances) of a tree filled up to ``depth``; a leaf above that is repeated."""
    inner = 2**depth - 1
    features, cuts, chances = [0] * inner, [float("inf")] * inner, [0.0] * (inner + 1)

    def fill(place: int, node, leaf: float | None) -> None:
        if leaf is None and node.getClass().getSimpleName() == "LeafNode":
            stats = [float(x) for x in node.impurityStats().stats()]
            leaf = stats[1] / sum(stats) if len(stats) > 1 and sum(stats) else 0.0
        if place >= inner:
            chances[place - inner] = leaf
            return
        if leaf is None:
            features[place], cuts[place] = node.split().featureIndex(), float(node.split().threshold())
        fill(2 * place + 1, None if leaf is not None else node.leftChild(), leaf)
        fill(2 * place + 2, None if leaf is not None else node.rightChild(), leaf)

    fill(0, node, None)
    return features, cuts, chances


def fit(findings: DataFrame, findings_limit: int = FINDINGS, trees: int = TREES, depth: int = DEPTH,
        seed: int = 42) -> Forest:
    """A forest from labelled findings: the columns ``FEATURES`` and ``label`` (0, 1; null is left out).

    Learns from a bounded sample, the ``findings_limit`` findings of each label with the smallest hashes of
    their features. With one label only, or none, the forest is that label, or 0.
    """
    clean = findings.filter(F.col("label").isNotNull()).select(
        F.col("label").cast("double").alias("label"), *FEATURES
    ).fillna(0.0).groupBy("label", *FEATURES).agg(F.count("*").alias("n"))
    place = F.xxhash64(*FEATURES)
    parts = [
        clean.filter(F.col("label") == y).orderBy(place, *FEATURES).limit(findings_limit)
        for y in (0.0, 1.0)
    ]
    sample = stage_table(parts[0].unionByName(parts[1]), "findings")
    kinds = {r["label"] for r in sample.select("label").distinct().collect()}
    if len(kinds) < 2:
        return Forest(depth, (), (), (), max(kinds, default=0.0))
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(
        sample.withColumn("weight", F.least("n", F.lit(1000)).cast("double"))
    )
    model = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, weightCol="weight", featureSubsetStrategy="sqrt"
    ).fit(data.coalesce(1))
    read = [_read_tree(tree.rootNode(), depth) for tree in model._java_obj.trees()]
    return Forest(depth, *(tuple(x for part in side for x in part) for side in zip(*read)))


def fit_on(docs: DataFrame, path: str | None = "source", **settings) -> Forest:
    """A forest from the findings of ``docs`` with ``weak_labels``."""
    own = docs.select("text", *([path] if path else []))
    found = with_candidates(own, path).filter(F.size("_features") > 0).select(
        F.explode("_features").alias("f")
    )
    columns = [F.col("f")[i].alias(name) for i, name in enumerate(FEATURES)]
    return fit(found.select(*columns, weak_labels(F.col("f")).alias("label")), **settings)


def scan(docs: DataFrame, forest: Forest, path: str | None = "source", threshold: float = 0.5) -> DataFrame:
    """(doc_id, place, length, digest, score, is_secret): every candidate of every whole text.

    ``place`` numbers the candidates of a text from 0; ``digest`` is the md5 of the candidate, so the
    report holds no secrets. Null, empty and candidate-free texts give no rows; rows that repeat are
    reported each; null ids stay null.
    """
    own = docs.select("doc_id", "text", *([path] if path else []))
    scored = with_candidates(own, path).withColumn(
        "_scores", F.transform("_features", forest.probability)
    )
    found = F.arrays_zip("_tokens", "_scores")
    return (
        scored.filter(F.size("_tokens") > 0)
        .select(F.col("doc_id").cast("long"), F.posexplode(found).alias("place", "f"))
        .select("doc_id", "place", F.length("f._tokens").alias("length"),
                F.md5("f._tokens").alias("digest"), F.col("f._scores").alias("score"))
        .withColumn("is_secret", F.col("score") >= threshold)
    )


def redact(docs: DataFrame, forest: Forest, path: str | None = "source", threshold: float = 0.5) -> DataFrame:
    """``docs`` with every secret replaced by a mask; texts without one stay as they are.

    ``n_chars``, if there, is counted anew where a text changed.
    """
    where = F.col(path).cast("string") if path else F.lit("")
    own = docs.select(F.struct(*docs.columns).alias("doc"), "text", where.alias("path"))
    scored = with_candidates(own, "path").withColumn(
        "_secret", F.transform("_features", lambda f: forest.probability(f) >= threshold)
    )
    tokens, secret = F.col("_tokens"), F.col("_secret")
    parts = F.transform("_gaps", lambda g, i: F.concat(
        g, F.when(i < F.size(tokens), F.when(secret[i], F.lit(MASK)).otherwise(tokens[i])).otherwise("")
    ))
    changed = F.coalesce(F.exists("_secret", lambda s: s), F.lit(False))
    masked = scored.select("doc", changed.alias("changed"), F.when(
        changed, F.array_join(parts, "")).otherwise(F.col("text")).alias("text"))
    fresh = {"text": F.col("text")}
    if "n_chars" in docs.columns:
        fresh["n_chars"] = F.when(
            F.col("changed"), F.length("text").cast(docs.schema["n_chars"].dataType)
        ).otherwise(F.col("doc.n_chars"))
    return masked.select(*[
        fresh[c].alias(c) if c in fresh else F.col("doc")[c].alias(c) for c in docs.columns
    ])
