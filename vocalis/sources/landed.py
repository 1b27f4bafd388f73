"""Reading landed API pages: one JSON document per page, exploded to one row per item."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalis import lexicons
from vocalis.functions import values


def read_pages(spark: SparkSession, path: str, schema, whole_files: bool = False) -> DataFrame:
    """Pages under ``path``, one per line, or with ``whole_files`` one document per file, however it is laid out.

    Fields that a page lacks are null. A page that cannot be read fails the query.
    """
    return spark.read.schema(schema).json(path, mode="FAILFAST", multiLine=whole_files)


def _items(pages: DataFrame, *columns: str) -> DataFrame:
    """The items of the pages in order of arrival; a page must tell its number, as ties go by it."""
    page_no = values.required(F.col("page_no"), "page_no").alias("page_no")
    return pages.select(*columns, page_no, F.posexplode("items").alias("pos", "item"))


def video_ids(pages: DataFrame) -> DataFrame:
    """Ids on the search pages, in order of arrival; a page without items gives none."""
    items = _items(pages)
    return items.select(F.col("item.id.videoId").alias("id"), "page_no", "pos").where("id is not null")


def video_details(pages: DataFrame) -> DataFrame:
    """One row per video on the detail pages; counts and duration are still text."""
    items = _items(pages)
    return items.select(
        F.col("item.id").alias("id"),
        F.col("item.snippet.title").alias("title"),
        values.strict_time(F.col("item.snippet.publishedAt")).alias("published_at"),
        F.col("item.statistics.viewCount").alias("views"),
        F.col("item.statistics.commentCount").alias("comments"),
        F.col("item.contentDetails.duration").alias("duration"),
        "page_no",
        "pos",
    )


def video_comments(pages: DataFrame) -> DataFrame:
    """One row per top-level comment; page and position keep the order of arrival."""
    items = _items(pages, "video_id")
    comment = "item.snippet.topLevelComment.snippet"
    return items.select(
        "video_id",
        F.col(f"{comment}.textDisplay").alias("text"),
        values.strict_count(F.col(f"{comment}.likeCount")).alias("likes"),
        F.col(f"{comment}.authorDisplayName").alias("author"),
        "page_no",
        "pos",
    )


def headlines(listings: DataFrame, subreddits: Sequence[str] = tuple(lexicons.SUBREDDITS)) -> DataFrame:
    """Titles of the posts in the listed subreddits."""
    return listings.where(F.col("subreddit").isin(*subreddits)).select(F.col("title").alias("headline"))
