"""The corpus pipeline: raw documents to files of token ids, in five stages.

Every stage takes what the stage before kept, and its decisions take effect: rejected, repeated and
contaminated documents go, the mix repeats or leaves out documents, and the rest is written as token ids. Each stage is written and read again, so a lost executor repeats no finished stage.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from vocalis.llm import catalog, common, decontaminate, mixing, near_dups, quality, token_files


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality.keep(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return near_dups.one_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without contamination by the benchmark."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them; a document taken twice is two rows."""
    return mixing.mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids written to files and read back: doc_id, start, n_tokens, ids_crc32, file, frame."""
    return token_files.tokens(docs, public_tokenizers.path(catalog.WRITTEN_WITH))


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("source mix", source_mix),
    ("token files", token_output),
]
#: SQL cannot express the near-duplicate and token stages; the tests hold the rows against a brute-force run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order on ``documents``; file names differ between runs and are left out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = common.written(stage(spark, docs, sf_dir))
    return docs.select("doc_id", "start", "n_tokens", "ids_crc32")
