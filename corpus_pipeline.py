"""The corpus pipeline: from raw documents to token files, one operator of quotidian.llm per stage.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet in the shared
folder and reads it again as the next stage's docs. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quotidian.llm import bitplane, fmindex, importance, mixing, simhash
from quotidian.llm.queries import table, tokenizer_path
from quotidian.llm.scratch import saved


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the importance sample leaves out go."""
    return importance.keep_sampled(docs, table(spark, sf_dir, "labels"))


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays."""
    return simhash.keep_one(docs, shingle=3, distance=2)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The words of benchmark windows are cut out; every document stays."""
    return fmindex.remove(docs, table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mixing.emit(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the shared folder, and what was read back from them."""
    return bitplane.write_and_read(docs, tokenizer_path())


STAGES = [
    ("quality classifier", quality_classifier),
    ("SimHash near-dedup", simhash_near_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("mixing sources to target weights", mixing_sources),
    ("token-ID / binary output", token_output),
]

#: Weights learned from all texts, XXH64 and byte-pair encoding have no form in SQL; tests/llm has
#: brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.lower().replace(" ", "-").replace("/", "-"))
    return docs
