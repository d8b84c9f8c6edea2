"""The operators over the given tables: one query each, with the parameters of production."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quotidian.llm import (
    bitplane, ctw, fmindex, importance, language, lexical, licenses, mixing, negatives, neighbours, recompression,
    simhash, suffixes,
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    return importance.classify(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op2_conditional_random_field(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(table(spark, folder, "documents")).drop("spans")


def op3_fm_index_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return fmindex.report(table(spark, folder, "documents"), table(spark, folder, "benchmark"), width=10)


def op4_stable_projection_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.search(table(spark, folder, "embeddings"), step=50, k=5)


def op5_suffix_bucket_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.digests(table(spark, folder, "documents"), window=50)


def op6_recompression_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return recompression.digests(table(spark, folder, "documents"), window=13)


def op7_systematic_sampling(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mixed(table(spark, folder, "documents"))


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op8_bit_plane_token_files(spark: SparkSession, folder: str) -> DataFrame:
    return bitplane.write_and_read(table(spark, folder, "documents"), tokenizer_path())


def op9_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), shingle=3, distance=2)


def op10_context_tree_weighting(spark: SparkSession, folder: str) -> DataFrame:
    return ctw.score(table(spark, folder, "documents"))


def op11_aho_corasick_ranking(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.rank(table(spark, folder, "documents"), table(spark, folder, "benchmark"), keep=50)


def op12_license_similarity_join(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan(table(spark, folder, "documents"))


def op13_hilbert_zone_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return negatives.mine(table(spark, folder, "embeddings"), step=50, positives=5, negatives=3)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_importance_resampling, op2_conditional_random_field, op3_fm_index_decontamination,
        op4_stable_projection_neighbours, op5_suffix_bucket_dedup, op6_recompression_dedup,
        op7_systematic_sampling, op8_bit_plane_token_files, op9_simhash_near_dedup, op10_context_tree_weighting,
        op11_aho_corasick_ranking, op12_license_similarity_join, op13_hilbert_zone_negatives,
    )
}

ORACLES: dict[str, str] = {
    "op7_systematic_sampling": mixing.SQL,
    "op11_aho_corasick_ranking": lexical.SQL,
    "op12_license_similarity_join": licenses.SQL,
    "op13_hilbert_zone_negatives": negatives.SQL,
}
