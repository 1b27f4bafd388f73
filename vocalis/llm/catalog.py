"""One query per operator on the given tables, with production parameters; their SQL is in ``oracle``."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalis.llm import (
    conversations, decontaminate, licenses, merkle, mixing, near_dups, pii, quality, sharding, token_counts, token_files, toxicity, urls,
)
from vocalis.session import workspace

#: Vocabulary files by the places where the operators look for them; a parameter, never part of the repository.
COUNTED_WITH = "piece_bpe_32k.model"
WRITTEN_WITH = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents", "doc_id", "text")


def op1_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.detections(_documents(spark, sf_dir)))


def op2_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark", "item_id", "text"))


def op2_benchmark_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.near_report(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark", "item_id", "text"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counts(_documents(spark, sf_dir), public_tokenizers.path(COUNTED_WITH))


def op4_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.groups(_documents(spark, sf_dir))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    texts, marks = toxicity.training_rows(docs, _table(spark, sf_dir, "labels", "doc_id", "toxic"))
    return toxicity.scores(docs, toxicity.train(texts, marks))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.summary(pii.detect(_documents(spark, sf_dir)))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.verdicts(_documents(spark, sf_dir))


def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.plan(_table(spark, sf_dir, "documents", "doc_id", "text", "source"), keep=["doc_id"])
    return rows.select("row.doc_id", "size", "source_size", "target", "taken")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sharding.shards(_documents(spark, sf_dir), workspace(spark))
    return rows.select(
        F.col("key").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = token_files.tokens(_documents(spark, sf_dir), public_tokenizers.path(WRITTEN_WITH))
    return rows.select("doc_id", "start", "n_tokens", "ids_crc32")


def op11_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judged(_table(spark, sf_dir, "pages", "page_id", "url")).drop("score")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repair_damaged(_table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(_table(spark, sf_dir, "documents", *merkle.COLUMNS))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_license_scans, op2_benchmark_decontamination, op2_benchmark_proximity, op3_token_counts, op4_minhash_near_dedup,
        op5_toxicity, op6_pii, op7_quality_rules, op8_source_mix, op9_sharding, op10_token_files,
        op11_url_filter, op12_conversation_repair, op13_merkle_manifest,
    )
}
