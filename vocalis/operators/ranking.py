"""Picking items and their best comments."""

from __future__ import annotations

import datetime
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vocalis.functions import values
from vocalis.operators.stages import computed_once

MIN_SECONDS = 60
TOP_VIDEOS = 50
TOP_COMMENTS = 200
LOOKBACK_DAYS = 30


def recent(df: DataFrame, column: str, anchor: datetime.datetime | Column, days: int = LOOKBACK_DAYS) -> DataFrame:
    """Rows whose time is at most ``days`` before ``anchor``."""
    since = F.lit(anchor) if isinstance(anchor, datetime.datetime) else anchor
    return df.where(F.col(column) >= since - F.make_dt_interval(F.lit(days)))


def matching(df: DataFrame, column: str, query: str) -> DataFrame:
    """Rows whose text contains ``query``, in any case."""
    return df.where(F.contains(F.lower(F.col(column)), F.lit(query.lower())))


def eligible_videos(details: DataFrame, min_seconds: float = MIN_SECONDS) -> DataFrame:
    """Video details as typed columns, without short videos and videos that cannot be commented on.

    Reads ``id, title, views, comments, duration`` (all text; other columns are kept) and gives
    ``id, title, view_count, comment_count, comments_enabled, duration``.
    """
    others = [c for c in details.columns if c not in ("views", "comments", "duration")]
    timed = computed_once(details, duration=values.iso_seconds(F.col("duration")))
    videos = timed.where(F.col("duration") > min_seconds)
    videos = videos.withColumn("comment_count", values.digits_or_zero(F.col("comments")))
    videos = videos.withColumn("comments_enabled", F.col("comment_count") > 0).where("comments_enabled")
    view_count = values.strict_count(F.col("views")).alias("view_count")
    return videos.select(*others, view_count, "comment_count", "comments_enabled", "duration")


def one_per_key(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The row of each key that comes last in ``order``.

    An aggregate, so the copies of a key shrink to one inside each task before they are shuffled.
    """
    others = [c for c in df.columns if c != key]
    best = F.max_by(F.struct(*others), F.struct(*order)).alias("_row")
    return df.groupBy(key).agg(best).select(key, "_row.*").select(*df.columns)


def with_details(ids: DataFrame, details: DataFrame, key: str = "id") -> DataFrame:
    """Details of the listed ids; an id listed twice counts once, an id without details is left out."""
    return details.join(ids.select(key).distinct(), key, "left_semi").select(*details.columns)


def top_rows(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows in ``order``: each task keeps its own ``n``, then one task merges them."""
    return df.orderBy(*order).limit(n)


def top_videos(videos: DataFrame, n: int = TOP_VIDEOS, dedupe: str = "before", landed: Sequence[str] = ()) -> DataFrame:
    """The ``n`` videos with the most views; equal views go by id.

    ``dedupe='before'`` counts a video once. ``dedupe='after'`` ranks the rows as they came and keeps, of
    the copies of a video among the ``n``, the last one in that order, the one with the fewest views, so
    that fewer than ``n`` videos may remain; ``landed`` names the columns that tell in which order copies arrived.
    """
    arrival = list(landed)
    order = [F.desc("view_count"), F.asc("id")]
    if dedupe == "before":
        return top_rows(one_per_key(videos, "id", [*arrival, "view_count"]), order, n)
    if dedupe == "after":
        best = top_rows(videos, [*order, *[F.asc(c) for c in arrival]], n)
        return one_per_key(best.withColumn("_low", -F.col("view_count")), "id", ["_low", *arrival]).drop("_low")
    raise ValueError(f"unknown dedupe {dedupe!r}")


def top_per_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, splits: int | None = None
) -> DataFrame:
    """The first ``n`` rows of every group in ``order``.

    Done in two steps, because one group may hold a third of all rows: the tasks that read a group
    are dealt out to ``splits`` sub-groups (as many as the session has shuffle partitions, unless
    given), each of which keeps its first ``n``; the second step ranks at most ``n * splits`` rows per group. Every row of the answer is among the first ``n`` of
    its sub-group, so the answer is exact however the rows are dealt.
    """
    groups = list(group)
    kept = df.columns
    splits = splits or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = df.withColumn("_split", F.pmod(F.spark_partition_id(), F.lit(splits)))
    first = W.partitionBy(*groups, "_split").orderBy(*order)
    survivors = dealt.withColumn("_rank", F.row_number().over(first)).where(F.col("_rank") <= n).select(*kept)
    last = W.partitionBy(*groups).orderBy(*order)
    return survivors.withColumn("_rank", F.row_number().over(last)).where(F.col("_rank") <= n).select(*kept)


def comments_of(videos: DataFrame, comments: DataFrame) -> DataFrame:
    """Comments of the given videos, with the video's title; a video without comments gives no row.

    ``videos`` has an ``id`` once per row. An ordinary join: the planner sends the videos to every task if
    they are as small as they usually are, and else splits the skewed keys.
    """
    titles = videos.select(F.col("id").alias("video_id"), F.col("title").alias("video_title"))
    return comments.join(titles, "video_id")


def top_comments(comments: DataFrame, n: int = TOP_COMMENTS, splits: int | None = None) -> DataFrame:
    """Per video the ``n`` comments with the most likes; equal likes stay in the order they arrived."""
    order = [F.desc("likes"), F.asc("page_no"), F.asc("pos")]
    return top_per_group(comments, ["video_id"], order, n, splits)


def flat_comments(comments: DataFrame) -> DataFrame:
    """One row per comment: video, title, text."""
    return comments.select("video_id", "video_title", F.col("text").alias("comment"))
