"""Reports kept up to date: what a batch adds to them is counted once, when the batch is new.

Every writing of a batch is never changed after it has been committed, so its counts by source, topic and sentiment stay true and
are kept in a folder of their own, one part per writing. A report adds up the parts of the writings that the store's newest
list names: of a batch that was replaced, removed or put together with others the old parts are simply not asked
any more. A part that a lost run left unfinished has no mark of success and is written again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vocalis.operators.report import SENTIMENTS
from vocalis.sources import commits, tables
from vocalis.sources.tables import ATTEMPT

#: ``topic`` is null in the counts of rows, which count once whatever their topics.
PART = "source string, topic string, sentiment string, count long"


def counts(rows: DataFrame) -> DataFrame:
    """The counts of labelled texts in one pass: by source and sentiment, and once more for every topic."""
    topics = F.coalesce("topics", F.array().cast("array<string>"))
    every = F.concat(F.array(F.lit(None).cast("string")), topics)
    unfolded = rows.select("source", F.explode(every).alias("topic"), "sentiment")
    return unfolded.groupBy("source", "topic", "sentiment").agg(F.count(F.lit(1)).alias("count"))


def _is_whole(spark: SparkSession, folder: str, attempt: str) -> bool:
    mark = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{ATTEMPT}={attempt}/_SUCCESS")
    return mark.getFileSystem(spark._jsc.hadoopConfiguration()).exists(mark)


def refresh(spark: SparkSession, store: str, folder: str) -> list[str]:
    """Count the writings of ``store`` that ``folder`` has no part of, and return their batches; no other one is read."""
    new = [pair for pair in commits.read(spark, store) if not _is_whole(spark, folder, pair[1])]
    for pair in new:
        part = counts(tables.read_attempts(spark, store, [pair]))
        part.write.mode("overwrite").parquet(f"{folder}/{ATTEMPT}={pair[1]}")
    return [batch for batch, _ in new]


def merged(spark: SparkSession, store: str, folder: str, source: str | None = None) -> DataFrame:
    """(source, topic, sentiment, count) of the whole store from its parts; of all writings, so ``refresh`` comes first."""
    paths = [f"{folder}/{ATTEMPT}={attempt}" for _, attempt in commits.read(spark, store)]
    parts = spark.read.schema(PART).parquet(*paths) if paths else spark.createDataFrame([], PART)
    parts = parts if source is None else parts.where(F.col("source") == source)
    return parts.groupBy("source", "topic", "sentiment").agg(F.sum("count").alias("count"))


def reports(spark: SparkSession, store: str, folder: str, source: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The tables of ``opinions.reports``, from the parts in ``folder``, which are brought up to date."""
    refresh(spark, store, folder)
    rows = merged(spark, store, folder, source)
    shares = rows.where(F.col("topic").isNull()).drop("topic")
    shares = shares.withColumn("share", F.col("count") / F.sum("count").over(W.partitionBy("source")))
    known = rows.where(F.col("topic").isNotNull() & F.col("sentiment").isNotNull())
    columns = [F.sum(F.when(F.col("sentiment") == s, F.col("count")).otherwise(F.lit(0))).alias(s) for s in SENTIMENTS]
    return shares, known.groupBy("source", "topic").agg(*columns).orderBy("source", "topic")
