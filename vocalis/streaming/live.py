"""The same steps on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vocalis.plans.opinions import Settings, label_texts
from vocalis.sources import sinks


def label_stream(
    stream: DataFrame, column: str, valences: DataFrame, settings: Settings = Settings(), **options
) -> DataFrame:
    """Cleaned, tagged and labelled texts of a stream; no state, because a text is scored within its row.

    With a valence table too large for the plan use ``label_into_store``.
    """
    return label_texts(stream, column, valences, settings, **options)


def windowed_counts(stream: DataFrame, time: str, keys: list[str], width: str, lateness: str) -> DataFrame:
    """Rows per tumbling window and keys; rows later than ``lateness`` are not counted any more.

    Windows are cut in UTC; a time without zone is read as
    UTC and given back without one.
    """
    timed = stream.withColumn(time, in_utc(stream, time)).withWatermark(time, lateness)
    counts = timed.groupBy(F.window(time, width).alias("span"), *keys).agg(F.count(F.lit(1)).alias("count"))
    start, end = window_edges(stream, time, "span")
    return counts.select(start.alias("window_start"), end.alias("window_end"), *keys, "count")


def _zoneless(df: DataFrame, time: str) -> bool:
    return isinstance(df.schema[time].dataType, T.TimestampNTZType)


def in_utc(df: DataFrame, time: str) -> Column:
    """The instant of a time; one without zone is read as UTC."""
    instant = F.convert_timezone(F.lit("UTC"), F.current_timezone(), F.col(time)) if _zoneless(df, time) else F.col(time)
    return instant.cast("timestamp")


def window_edges(df: DataFrame, time: str, span: str) -> list[Column]:
    """Start and end of a window over ``in_utc``, without zone if the time of ``df`` has none."""

    def edge(name: str) -> Column:
        value = F.col(f"{span}.{name}")
        return F.convert_timezone(F.current_timezone(), F.lit("UTC"), value.cast("timestamp_ntz")) if _zoneless(df, time) else value

    return [edge("start"), edge("end")]


def run_available(df: DataFrame, path: str, checkpoint: str) -> None:
    """Process what is there, write the rows that changed to a folder per micro-batch under ``path``, and stop.

    Windows that are still open at the end are written too; ``latest_counts`` reads the result.
    """

    def write(rows: DataFrame, number: int) -> None:
        rows.write.mode("overwrite").parquet(f"{path}/micro={number}")  # a repeated micro-batch replaces itself

    query = df.writeStream.foreachBatch(write).outputMode("update").option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()


def latest_counts(spark: SparkSession, path: str) -> DataFrame:
    """Every window and its keys with the count of the last micro-batch that changed it."""
    rows = spark.read.parquet(path)
    keys = [c for c in rows.columns if c not in ("count", "micro")]
    return rows.groupBy(*keys).agg(F.max_by("count", "micro").alias("count"))


def into_store(df: DataFrame, store: str, checkpoint: str, prefix: str, **trigger) -> StreamingQuery:
    """Write a labelled stream (with its ``source``) to the store that the batch runs write to.

    Every micro-batch is a batch of the store under ``prefix`` and its number, and replaces itself when
    it is repeated after a failure, so no text is stored twice. Numbers start anew with a checkpoint, so
    each stream needs a ``prefix`` of its own. ``sinks.compact`` puts many small batches together.
    """

    def write(rows: DataFrame, number: int) -> None:
        sinks.write_store(rows, store, f"{prefix}-{number}", "replace")

    query = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return query.trigger(**(trigger or {"availableNow": True})).start()


def label_into_store(
    stream: DataFrame, column: str, valences: DataFrame, store: str, checkpoint: str, prefix: str,
    settings: Settings = Settings(), **trigger,
) -> StreamingQuery:
    """Like ``into_store``, for a raw stream with a ``source``: texts are labelled in their micro-batch, so the
    valence table may be of any size."""

    def write(rows: DataFrame, number: int) -> None:
        labelled = label_texts(rows, column, valences, settings).withColumn("text", F.col(column))
        sinks.write_store(labelled, store, f"{prefix}-{number}", "replace")

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return query.trigger(**(trigger or {"availableNow": True})).start()
