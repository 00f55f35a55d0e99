"""Quality by votes of the nearest labelled documents in a latent-semantic space."""

from __future__ import annotations

import operator
import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pyspark.sql.types import DoubleType, StructField, StructType

from holdfast.llm.common import small_batches

FEATURES = 2048
REFERENCES = 4096
DIMENSIONS = 64
NEIGHBOURS = 15
REPEAT_WEIGHT = 40
_MIX = np.uint32(2654435761)


def features(text: str | None) -> np.ndarray:
    """How often each hashed run of three bytes occurs in the whole text; last, its words that repeat the one before."""
    data = (text or "").encode()
    raw = np.frombuffer(data, np.uint8)
    counts = np.zeros(FEATURES)
    for start in range(0, max(len(raw) - 2, 0), 1 << 20):
        part = raw[start: start + (1 << 20) + 2].astype(np.uint32)
        runs = (part[:-2] << 16) | (part[1:-1] << 8) | part[2:]
        hashed = ((runs * _MIX) >> np.uint32(8)) % np.uint32(FEATURES - 1)
        counts += np.bincount(hashed, minlength=FEATURES)
    words = data.split()
    counts[-1] = REPEAT_WEIGHT * sum(map(operator.eq, words, words[1:]))
    return counts.astype(np.float32)


def _unit(x: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)


@dataclass
class LatentVotes:
    weights: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    neighbours: int

    def latent(self, counts: np.ndarray) -> np.ndarray:
        return _unit(_unit(np.sqrt(counts) * self.weights) @ self.basis)

    def score(self, counts: np.ndarray) -> np.ndarray:
        """Share of similarity with which the nearest references vote for label 1."""
        prior = float(self.labels.mean()) if len(self.labels) else 0.5
        out = np.full(len(counts), prior)
        if not len(self.labels):
            return out
        latent = self.latent(counts)
        k = min(self.neighbours, len(self.labels))
        for start in range(0, len(latent), 256):
            near = latent[start: start + 256] @ self.vectors.T
            top = np.argpartition(-near, k - 1, axis=1)[:, :k]
            pull = np.maximum(np.take_along_axis(near, top, axis=1), 0.0).astype(float) ** 8
            total = pull.sum(axis=1)
            vote = (pull * self.labels[top]).sum(axis=1)
            out[start: start + 256] = np.where(total > 0, vote / np.maximum(total, 1e-30), prior)
        return np.clip(out, 0.0, 1.0)


def counted(docs: DataFrame) -> DataFrame:
    """(label, counts binary): the features of every row of (label, text) as 32-bit floats, so that no count is cut, compressed."""
    import pyarrow as pa

    def count(batches):
        for batch in batches:
            rows = [zlib.compress(features(t.as_py()).tobytes(), 1) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.binary())],
                                             names=["label", "counts"])

    return small_batches(docs).mapInArrow(count, "label double, counts binary")


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", references: int = REFERENCES,
        dimensions: int = DIMENSIONS, neighbours: int = NEIGHBOURS) -> LatentVotes:
    """Fits the space and its references on texts of ``docs`` with a ``label`` in ``labels``, both by doc_id.

    The sample is bounded: the ``references`` labels with the smallest hashes of their ids; null labels
    and ids are left out. The space is spanned by the leading singular vectors of the sample's
    square-rooted, inversely weighted counts. No labelled text: every text scores 0.5.
    """
    picked = (
        labels.select(F.col("doc_id").cast("long"), F.col(label).cast("double").alias("label")).dropna()
        .distinct().orderBy(F.xxhash64("doc_id", F.lit(5)), "doc_id", "label").limit(references)
    )
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(picked), "doc_id")
    rows = counted(texts.select("label", "text")).distinct()
    found = rows.orderBy(F.xxhash64("counts"), "label").limit(references).collect()  # about 1 kB a row
    if not found:
        empty = np.zeros((0, dimensions), np.float32)
        return LatentVotes(np.ones(FEATURES, np.float32), np.zeros((FEATURES, dimensions), np.float32),
                           empty, np.zeros(0), neighbours)
    labels = np.array([r["label"] for r in found])
    x = np.empty((len(found), FEATURES), np.float32)  # the one matrix of the fit, changed in place
    for i, row in enumerate(found):
        x[i] = np.frombuffer(zlib.decompress(row["counts"]), np.float32)
    del found
    seen = np.count_nonzero(x, axis=0)
    weights = np.log((1 + len(x)) / (1 + seen)).astype(np.float32) + np.float32(0.1)
    np.sqrt(x, out=x)
    x *= weights
    norm = np.sqrt(np.einsum("ij,ij->i", x, x))
    x /= np.where(norm > 0, norm, 1)[:, None]
    basis = np.linalg.qr(np.random.default_rng(1).standard_normal((FEATURES, dimensions + 16)))[0]
    for _ in range(30):  # subspace iteration towards the leading singular vectors
        basis = np.linalg.qr(x.T @ (x @ basis.astype(np.float32)))[0]
    basis = np.ascontiguousarray(basis[:, :dimensions]).astype(np.float32)
    return LatentVotes(weights, basis, _unit(x @ basis), labels, neighbours)


def score(docs: DataFrame, model: LatentVotes) -> DataFrame:
    """``docs`` with ``quality_score`` (0 to 1, higher: label 1 likelier) of every whole text.

    The references travel as a broadcast of at most ``references`` rows; each batch of documents is
    multiplied with all of them in blocks. Null and empty texts are near nothing and get the share of label
    1 in the sample. A column of that name is replaced.
    """
    import pyarrow as pa

    shared = docs.sparkSession.sparkContext.broadcast(model)

    def voted(batches):
        for batch in batches:
            texts = batch.column(batch.schema.get_field_index("text"))
            out = np.zeros(len(texts))
            for start in range(0, len(texts), 256):
                part = texts.slice(start, 256)
                out[start: start + 256] = shared.value.score(np.stack([features(t.as_py()) for t in part]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(out)], names=[*batch.schema.names, "quality_score"]
            )

    rest = docs.drop("quality_score")
    schema = StructType([*rest.schema.fields, StructField("quality_score", DoubleType())])
    return small_batches(rest).mapInArrow(voted, schema)
