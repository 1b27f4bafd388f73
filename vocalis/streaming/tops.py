"""The first rows of every group of a stream, kept up to date micro-batch by micro-batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from vocalis.operators import ranking
from vocalis.streaming import micro

VERSION = "_micro"


def _same(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> Column:
    """Equal groups; groups that are null are one group."""
    condition = F.lit(True)
    for c in columns:
        condition = condition & left[c].eqNullSafe(right[c])
    return condition


def _newest(rows: DataFrame, group: Sequence[str]) -> DataFrame:
    last = rows.groupBy(*group).agg(F.max(VERSION).alias(VERSION))
    return rows.join(last, _same(rows, last, [*group, VERSION]), "left_semi")


def merge(rows: DataFrame, number: int, group: Sequence[str], order: Sequence[Column], n: int, before: DataFrame | None) -> DataFrame:
    """The first ``n`` rows of every group that has rows in the micro-batch, from those and its first rows so far.

    The first rows of two parts hold the first rows of both together, so nothing else of the past is needed.
    """
    best = ranking.top_per_group(rows, group, order, n)
    if before is not None:
        touched = best.select(*group).distinct()
        old = before.join(touched, _same(before, touched, group), "left_semi").drop(VERSION)
        best = ranking.top_per_group(best.unionByName(old), group, order, n)
    return best.withColumn(VERSION, F.lit(number).cast("long"))


def into_tops(
    stream: DataFrame, path: str, checkpoint: str, group: Sequence[str], order: Sequence[Column], n: int, **trigger
) -> StreamingQuery:
    """Keeps the first ``n`` rows in ``order`` of every group of the stream at ``path``.

    A micro-batch reads the rows kept of the groups it touches and writes at most ``n`` rows for each of them; groups that it does
    not touch are not written. ``order`` should leave no ties. Repeated micro-batches count once.
    """

    def write(rows: DataFrame, number: int, folder: str) -> None:
        known = micro.folders(rows.sparkSession, path)
        before = _newest(rows.sparkSession.read.schema(_with_version(rows.schema)).parquet(*known), group) if known else None
        merge(rows, number, group, order, n, before).write.parquet(folder)

    return micro.merged(stream, path, checkpoint, write, **trigger)


def _with_version(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(VERSION, T.LongType())])


def tops(spark: SparkSession, path: str, schema: T.StructType, group: Sequence[str]) -> DataFrame:
    """The rows kept at ``path`` for a stream of this schema; none before its first micro-batch."""
    known = micro.folders(spark, path)
    if not known:
        return spark.createDataFrame([], schema)
    return _newest(spark.read.schema(_with_version(schema)).parquet(*known), group).drop(VERSION)


def fold(spark: SparkSession, path: str, schema: T.StructType, group: Sequence[str]) -> None:
    """Puts the rows kept in one folder, without those that later micro-batches replaced."""

    def write(folder: str) -> None:
        _newest(spark.read.schema(_with_version(schema)).parquet(*micro.folders(spark, path)), group).write.parquet(folder)

    micro.fold(spark, path, write)
