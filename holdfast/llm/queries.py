"""The operators of this package over the driver's tables, as registered queries with their digests."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.llm import (
    best_fit, collision_search, collocations, language_kn, mixing, nn_descent, quality_knn, secret_forest,
    simhash_tiles, target_resampling, token_files, twins, url_rank, zipped_archive,
)
from holdfast.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER, WORD_TOKENIZER = "byte_bpe_50k.json", "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return secret_forest.scan(docs, secret_forest.fit_on(docs))


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rank.filter_urls(table(spark, sf_dir, "pages"))


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents"), tokenizer_path(), 2048)


def search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collision_search.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nn_descent.near_duplicates(table(spark, sf_dir, "embeddings"), 0.9)


def archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zipped_archive.round_trip(table(spark, sf_dir, "pages"))


def mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken_words(table(spark, sf_dir, "documents"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = language_kn.folds("doc_id", 3) == 1
    labels = table(spark, sf_dir, "labels").filter(~held_out)
    scored = quality_knn.score(docs.select("doc_id", "text"), quality_knn.fit(docs, labels, "quality"))
    score = F.col("quality_score")
    return scored.select(
        "doc_id", held_out.alias("held_out"), score.alias("score"),
        (score >= 0.5).cast("int").alias("predicted"),
    )


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash_tiles.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = language_kn.folds("doc_id", 5) == 0
    model = language_kn.fit(docs.filter(~held_out))
    return language_kn.predict(docs, model).select(
        "doc_id", held_out.alias("held_out"), "lang_pred", "score", "entropy", "rejected"
    )


def resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return target_resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.round_trip(table(spark, sf_dir, "documents"), tokenizer_path(WORD_TOKENIZER), 2)


def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    "op1_secret_forest": secrets,
    "op2_url_rank": url_filter,
    "op3_best_fit": packing,
    "op4_collision_search": search,
    "op5_nn_descent": embedding_dedup,
    "op6_zipped_warc": archives,
    "op7_mixing": mix,
    "op8_quality_knn": quality,
    "op9_simhash_tiles": simhash,
    "op10_language_kn": language,
    "op11_target_resampling": resampling,
    "op12_token_files": tokens,
    "op13_collocations": phrases,
}

ORACLES: dict[str, str] = {
    "op11_target_resampling": twins.RESAMPLING,
    "op13_collocations": twins.COLLOCATIONS,
}
