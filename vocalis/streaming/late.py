"""Windowed counts that lose no row: rows behind the watermark are kept aside and correct their window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vocalis.streaming import micro
from vocalis.streaming.live import in_utc, window_edges

COUNTS, LATE = "counts", "late"


def _dealt(rows: DataFrame, time: str, width: str, lateness: str, seen: int | None) -> DataFrame:
    """Rows with the edges of their window and ``late``; a row without a time has no window and is late."""
    instant = in_utc(rows, time)
    spans = rows.withColumn("_instant", instant).withColumn("_span", F.window(F.coalesce("_instant", F.timestamp_seconds(F.lit(0))), width))
    behind = F.lit(False) if seen is None else F.col("_span.end") <= F.timestamp_micros(F.lit(seen)) - F.expr(f"interval {lateness}")
    edges = window_edges(rows, time, "_span")
    edges = [F.when(F.col("_instant").isNotNull(), e).alias(name) for e, name in zip(edges, ("window_start", "window_end"))]
    return spans.select(*rows.columns, *edges, (F.col("_instant").isNull() | behind).alias("late"), "_instant")


def into_counts(
    stream: DataFrame, time: str, keys: Sequence[str], width: str, lateness: str, path: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Counts per tumbling window and keys at ``path``, and the rows that came after their window had closed.

    A window is closed for a micro-batch if it ends ``lateness`` or more before the greatest time of the micro-batches
    before. Every micro-batch adds its own counts, so the stream holds no state, and each row is counted once, on time or
    late. The stream's columns must not be named as those that are added (window_start, window_end, late).
    """

    def write(rows: DataFrame, number: int, folder: str) -> None:
        spark = rows.sparkSession
        known = [f"{f}/{COUNTS}" for f in micro.folders(spark, path)]
        seen = spark.read.parquet(*known).agg(F.max("greatest")).first()[0] if known else None
        dealt = _dealt(rows, time, width, lateness, seen)
        groups = dealt.groupBy("window_start", "window_end", *keys, "late")
        groups.agg(F.count(F.lit(1)).alias("count"), F.max(F.unix_micros("_instant")).alias("greatest")).write.parquet(f"{folder}/{COUNTS}")
        dealt.where("late").drop("late", "_instant").write.parquet(f"{folder}/{LATE}")

    return micro.merged(stream, path, checkpoint, write, **trigger)


def counts(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """(window_start, window_end, keys, on_time, late, count): every window as it was when it closed, what came late, and both.

    Rows without a time are no part of any window; they are among ``late_rows``. Fails before the first micro-batch.
    """
    rows = spark.read.parquet(*[f"{f}/{COUNTS}" for f in micro.folders(spark, path)]).where("window_start is not null")
    part = lambda wanted: F.sum(F.when(F.col("late") == wanted, F.col("count")).otherwise(0))
    sums = rows.groupBy("window_start", "window_end", *keys)
    return sums.agg(part(False).alias("on_time"), part(True).alias("late"), F.sum("count").alias("count"))


def late_rows(spark: SparkSession, path: str, schema: T.StructType, time: str) -> DataFrame:
    """The rows that came late, with their window, and those without a time."""
    edge = schema[time].dataType
    whole = T.StructType([*schema.fields, T.StructField("window_start", edge), T.StructField("window_end", edge)])
    known = [f"{f}/{LATE}" for f in micro.folders(spark, path)]
    return spark.read.schema(whole).parquet(*known) if known else spark.createDataFrame([], whole)
