"""Language identification by interpolated Kneser-Ney models over characters."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import small_batches
from holdfast.session import stage_table

ORDER, BITS = 4, 16
GAP, UNKNOWN, FIRST = 0, 1, 2
SAMPLE_DOCS = 2000
SAMPLE_ALL, SAMPLE_LEAST = 200_000, 50
MAX_SYMBOLS = (1 << BITS) - 2
_BUCKETS = 256
_MASK = np.uint64((1 << BITS) - 1)


def folds(key: str, parts: int):
    """crc32 of the id as text, by which rows are held out; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % parts


def symbols(text: str, known: np.ndarray) -> np.ndarray:
    """Codes of the lower-cased letters of ``text``; every run of other characters is one gap."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    if not len(points):
        return np.zeros(0, np.uint64)
    at = np.searchsorted(known, points)
    at[at == len(known)] = 0
    code = np.where(known[at] == points, at + FIRST, GAP)
    strange = code == GAP
    if strange.any():
        rare = np.unique(points[strange])
        letters = np.array([p for p in rare.tolist() if chr(p).isalpha()], np.uint32)
        if len(letters):
            code[np.isin(points, letters)] = UNKNOWN
    code = np.concatenate(([GAP], code, [GAP]))
    keep = np.ones(len(code), bool)
    keep[1:] = (code[1:] != GAP) | (code[:-1] != GAP)
    return code[keep].astype(np.uint64)


def grams(codes: np.ndarray, n: int = ORDER) -> np.ndarray:
    """Keys of all runs of ``n`` codes, after ``n - 1`` gaps; each key holds its codes exactly."""
    padded = np.concatenate((np.zeros(n - 1, np.uint64), codes))
    out = np.zeros(len(codes), np.uint64)
    for i in range(n):
        out = (out << np.uint64(BITS)) | padded[i: i + len(codes)]
    return out


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` in the sorted ``keys``; -1 where missing."""
    if not len(keys):
        return np.full(len(wanted), -1)
    at = np.searchsorted(keys, wanted)
    at[at == len(keys)] = 0
    return np.where(keys[at] == wanted, at, -1)


@dataclass
class KneserNey:
    """Sorted arrays of keys for each order, with log probabilities and weights of shorter contexts."""

    keys: list[np.ndarray]
    logs: list[np.ndarray]
    contexts: list[np.ndarray]
    weights: list[np.ndarray]
    base: float

    @classmethod
    def fit(cls, keys: np.ndarray, counts: np.ndarray, n_symbols: int) -> KneserNey:
        base = 1.0 / max(n_symbols, 1)
        levels = [(keys, counts.astype(float))]
        for n in range(ORDER - 1, 0, -1):  # continuation counts: how many types end in the shorter run
            tail = levels[0][0] & np.uint64((1 << (BITS * n)) - 1)
            levels.insert(0, tuple(map(np.asarray, _counted(tail))))
        out = cls([], [], [], [], base)
        for n, (k, c) in enumerate(levels, 1):
            context = k >> np.uint64(BITS)
            names, at = np.unique(context, return_inverse=True)
            total = np.bincount(at, c)
            ones, twos = (c == 1).sum(), (c == 2).sum()
            cut = min(max(ones / (ones + 2 * twos), 0.1), 0.9) if ones + twos else 0.5
            weight = np.bincount(at, np.minimum(c, cut)) / total
            lower = out._prob(k & np.uint64((1 << (BITS * (n - 1))) - 1), n - 1)
            p = np.maximum(c - cut, 0) / total[at] + weight[at] * lower
            out.keys.append(k)
            out.logs.append(np.log(p))
            out.contexts.append(names)
            out.weights.append(np.log(np.maximum(weight, 1e-12)))
        return out

    def _prob(self, keys: np.ndarray, n: int) -> np.ndarray:
        return np.exp(self.log_prob(keys, n))

    def log_prob(self, keys: np.ndarray, n: int = ORDER) -> np.ndarray:
        if n == 0:
            return np.full(len(keys), np.log(self.base))
        at = _find(self.keys[n - 1], keys)
        out = np.where(at >= 0, self.logs[n - 1][at] if len(self.logs[n - 1]) else 0.0, 0.0)
        missing = np.nonzero(at < 0)[0]
        if len(missing):
            left = keys[missing]
            place = _find(self.contexts[n - 1], left >> np.uint64(BITS))
            back = np.where(place >= 0, self.weights[n - 1][place], 0.0)
            shorter = left & np.uint64((1 << (BITS * (n - 1))) - 1)
            out[missing] = back + self.log_prob(shorter, n - 1)
        return out


def _counted(keys: np.ndarray):
    return np.unique(keys, return_counts=True)


@dataclass
class LanguageModel:
    languages: list[str]
    known: np.ndarray
    models: list[KneserNey]
    limits: np.ndarray


def fit(docs: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_all: int = SAMPLE_ALL) -> LanguageModel:
    """Models of every ``lang`` of ``docs`` (doc_id, text, lang); null langs and texts teach nothing.

    At most ``sample_docs`` documents a language are read, those with the smallest hashes, and of many languages so many
    fewer (but 50 at least) that all together are about ``sample_all``: the bound of the model's size. All
    runs of four characters in them count, and every language is learned, from one document if there is no more. A fifth
    of the sample is set aside to calibrate: a text is rejected where its cross-entropy is above that of
    999 in 1000 of its language there.
    """
    place = F.xxhash64("doc_id", "text")
    labelled = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        "doc_id", "text", F.col("lang").cast("string"), place.alias("_h")
    )
    languages = labelled.select("lang").distinct().count()
    sample_docs = min(sample_docs, max(SAMPLE_LEAST, sample_all // max(languages, 1)))
    # The smallest of every bucket first, so that no task sorts a whole language.
    first = labelled.select("lang", "_h", F.pmod(F.xxhash64("_h"), F.lit(_BUCKETS)).alias("_bucket"))
    for bucket in ("_bucket", F.col("_bucket") % 16, F.lit(0)):
        place_in = F.row_number().over(Window.partitionBy("lang", bucket).orderBy("_h"))
        first = first.withColumn("_n", place_in).filter(F.col("_n") <= sample_docs)
    cuts = first.groupBy("lang").agg(F.max("_h").alias("cut"), F.min("_h").alias("low")).collect()  # a row a language
    if not cuts:
        return LanguageModel([], np.array([ord("a")], np.uint32), [], np.zeros(0))
    limits = docs.sparkSession.createDataFrame([tuple(r) for r in cuts], "lang string, cut long, low long")
    chosen = labelled.join(F.broadcast(limits), "lang").filter("_h <= cut")
    learns = (F.pmod("_h", F.lit(5)) != 0) | (F.col("_h") == F.col("low"))
    sample = stage_table(chosen.select("doc_id", "text", "lang", learns.alias("learns")), "language_sample")
    learn = sample.filter("learns").select("lang", "text")
    known = _alphabet(learn)
    found = _gram_counts(learn, known).toArrow()  # the runs of the sample, 16 bytes and a name each
    names = found.column("lang").combine_chunks().dictionary_encode()
    codes, keys, counts = names.indices.to_numpy(), found.column("key").to_numpy().view(np.uint64), found.column("n").to_numpy()
    order = np.lexsort((keys, codes))
    codes, keys, counts = codes[order], keys[order], counts[order]
    words = names.dictionary.to_pylist()
    languages, models = sorted(words), []
    for lang in languages:
        first_at, end = np.searchsorted(codes, [words.index(lang), words.index(lang) + 1])
        models.append(KneserNey.fit(keys[first_at:end], counts[first_at:end], len(known) + FIRST))
    model = LanguageModel(languages, known, models, np.full(len(languages), np.inf))
    if not languages:
        return model
    held = predict(sample.filter("not learns").select("doc_id", "text", "lang"), model, keep=("lang",))
    cuts = {
        r["lang"]: r["cut"] for r in held.filter("lang = lang_pred").groupBy("lang")
        .agg(F.percentile_approx("entropy", 0.999, 10000).alias("cut")).collect()
    }
    spare = max(cuts.values(), default=np.inf)
    model.limits = np.array([cuts.get(lang, spare) for lang in languages])
    return model


def _alphabet(texts: DataFrame) -> np.ndarray:
    """Code points of the most frequent letters, sorted."""
    import pyarrow as pa

    def letters(batches):
        for batch in batches:
            joined = "".join(t.as_py() for t in batch.column(1)).lower()
            points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
            names, n = np.unique(points, return_counts=True)
            keep = np.array([chr(p).isalpha() for p in names.tolist()], bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names[keep].astype(np.int64)), pa.array(n[keep].astype(np.int64))],
                names=["point", "n"],
            )

    counted = small_batches(texts).mapInArrow(letters, "point long, n long").groupBy("point").agg(
        F.sum("n").alias("n")
    )
    rows = counted.orderBy(F.desc("n"), "point").limit(MAX_SYMBOLS).collect()
    return np.sort(np.array([r["point"] for r in rows] or [ord("a")], np.uint32))


def _gram_counts(texts: DataFrame, known: np.ndarray) -> DataFrame:
    import pyarrow as pa

    def counted(batches):
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            for lang in sorted(set(langs)):
                keys = [
                    grams(symbols(batch.column(1)[int(i)].as_py(), known))
                    for i in np.nonzero(langs == lang)[0]
                ]
                names, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(names), pa.string()), pa.array(names.astype(np.int64)),
                     pa.array(n.astype(np.int64))], names=["lang", "key", "n"],
                )

    return small_batches(texts).mapInArrow(counted, "lang string, key long, n long").groupBy(
        "lang", "key"
    ).agg(F.sum("n").alias("n"))


def predict(docs: DataFrame, model: LanguageModel, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, lang_pred, score, entropy, rejected, *keep): the language of every whole text.

    The language with the lowest cross-entropy per character wins, ties to the smaller name. ``score``
    weighs the languages by their cross-entropies (a share of 1). Null texts and texts without a
    letter are ``und`` with score 0 and are rejected; so is every text if no language was learned.
    ``rejected`` also marks texts that fit their language worse than the calibration allows; these keep
    their language, and half their score.
    """
    import pyarrow as pa

    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)  # bounded by the sample

    def scored(batches):
        m = shared.value
        for batch in batches:
            codes = []
            for text in batch.column(1):
                c = symbols(text.as_py() or "", m.known)
                codes.append(c if (c != GAP).any() else c[:0])
            n = len(codes)
            pred, score = ["und"] * n, np.zeros(n)
            entropy, rejected = np.full(n, np.nan), np.ones(n, bool)
            full = [i for i in range(n) if len(codes[i]) and m.languages]
            for group in _groups_of(full, codes):
                runs, at = np.unique(np.concatenate([grams(codes[i]) for i in group]), return_inverse=True)
                logs = np.stack([-model.log_prob(runs) for model in m.models])
                sizes = np.array([len(codes[i]) for i in group])
                starts = np.concatenate(([0], np.cumsum(sizes)[:-1]))
                means = np.stack([np.add.reduceat(x[at], starts) for x in logs]) / sizes
                best = means.argmin(axis=0)
                lowest = means.min(axis=0)
                share = 1 / np.exp((lowest - means) * 8).sum(axis=0)
                bad = lowest > m.limits[best]
                for j, i in enumerate(group):
                    pred[i] = m.languages[best[j]]
                    score[i] = share[j] / 2 if bad[j] else share[j]
                    entropy[i], rejected[i] = lowest[j], bad[j]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(pred, pa.string()), pa.array(score),
                 pa.array(entropy, from_pandas=True), pa.array(rejected), *batch.columns[2:]],
                names=["doc_id", "lang_pred", "score", "entropy", "rejected", *keep],
            )

    kept = "".join(f", {name} string" for name in keep)
    texts = docs.select(F.col("doc_id").cast("long"), "text", *keep)
    return small_batches(texts).mapInArrow(
        scored, "doc_id long, lang_pred string, score double, entropy double, rejected boolean" + kept
    )


def _groups_of(rows: list[int], codes: list[np.ndarray], most: int = 500_000):
    """Runs of rows with about ``most`` characters together."""
    group: list[int] = []
    total = 0
    for i in rows:
        group.append(i)
        total += len(codes[i])
        if total >= most:
            yield group
            group, total = [], 0
    if group:
        yield group
