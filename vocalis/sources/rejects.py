"""Reading landed pages without failing on what cannot be read: bad items go to a reject table, with the reason.

A strict run fails on the first bad value. With rejects every item is read once, into a written table that says
for each item what is wrong with it; good items are the part without reasons, rejects the part with some. So kept and
rejected items always add up to the items read, whatever fails or is repeated in between.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vocalis import schemas
from vocalis.session import workspace
from vocalis.sources import chains

#: The field of a page that holds its text if it is no page.
UNREADABLE = "_unreadable"
WHOLE_NUMBER = r"^\s*[+-]?[0-9]+\s*$"


class Split(NamedTuple):
    """``kept`` as the strict reader gives it, ``rejected`` (origin, reasons, raw), and how many rows were read, kept and rejected."""

    kept: DataFrame
    rejected: DataFrame
    counts: dict[str, int]


def read_pages(spark: SparkSession, path: str, schema: T.StructType, whole_files: bool = False, chain: list[str] | None = None) -> DataFrame:
    """Pages under ``path`` with their file as ``_origin``; what is no page has its text in UNREADABLE, and else nulls.

    With ``chain``, the columns that tell chains of pages apart, a page that has landed again counts once.
    """
    marked = T.StructType([*schema.fields, T.StructField(UNREADABLE, T.StringType())])
    pages = spark.read.schema(marked).json(path, mode="PERMISSIVE", columnNameOfCorruptRecord=UNREADABLE, multiLine=whole_files)
    pages = pages.withColumn("_origin", F.input_file_name())
    if chain is None:
        return pages
    numbered = F.col(UNREADABLE).isNull() & F.col("page_no").isNotNull()
    return chains.once(pages.where(numbered), chain).unionByName(pages.where(~numbered))


def split(rows: DataFrame, checks: dict[str, Column], raw: Column, origin: Column, columns: list[Column]) -> Split:
    """Rows that pass all ``checks`` (what is wrong -> condition; null is false) as ``columns``, and the others with their reasons.

    Rows are computed once, and counted while they are written.
    """
    reasons = F.array_compact(F.array(*[F.when(F.coalesce(wrong, F.lit(False)), F.lit(name)) for name, wrong in checks.items()]))
    kept = F.struct(*columns)
    marked = rows.select(reasons.alias("reasons"), raw.alias("raw"), origin.alias("origin"), kept.alias("row"))
    marked = marked.select("reasons", "origin", F.when(F.size("reasons") > 0, F.col("raw")).alias("raw"), F.when(F.size("reasons") == 0, F.col("row")).alias("row"))
    seen, path = Observation(), workspace(rows.sparkSession)
    bad = F.sum((F.size("reasons") > 0).cast("long"))
    marked.observe(seen, F.count(F.lit(1)).alias("read"), F.coalesce(bad, F.lit(0)).alias("rejected")).write.parquet(path)
    stored = rows.sparkSession.read.schema(marked.schema).parquet(path)
    counts = {"read": seen.get["read"], "kept": seen.get["read"] - seen.get["rejected"], "rejected": seen.get["rejected"]}
    return Split(stored.where(F.size("reasons") == 0).select("row.*"), stored.where(F.size("reasons") > 0).select("origin", "reasons", "raw"), counts)


def _items(pages: DataFrame, *columns: str) -> DataFrame:
    """Every item of every page; a page that cannot be read is one row, and so is one without items if its number is missing."""
    empty = F.col(UNREADABLE).isNotNull() | (F.col("page_no").isNull() & (F.coalesce(F.size("items"), F.lit(0)) <= 0))
    none = F.array(F.lit(None).cast(pages.schema["items"].dataType.elementType))
    items = F.when(empty, none).otherwise(F.col("items"))
    return pages.select(*columns, "page_no", UNREADABLE, "_origin", F.posexplode(items).alias("pos", "item"))


def _not_whole(text: Column) -> Column:
    return text.isNotNull() & (~text.rlike(WHOLE_NUMBER) | F.trim(text).try_cast("long").isNull())


def _number(text: Column) -> Column:
    return F.coalesce(F.trim(text).try_cast("long"), F.lit(0).cast("long"))


def _checked(items: DataFrame, checks: dict[str, Column], columns: list[Column]) -> Split:
    page = {"unreadable page": F.col(UNREADABLE).isNotNull(), "page without a number": F.col(UNREADABLE).isNull() & F.col("page_no").isNull()}
    readable = F.col(UNREADABLE).isNull()
    raw = F.coalesce(F.col(UNREADABLE), F.to_json("item"))
    return split(items, {**page, **{name: readable & wrong for name, wrong in checks.items()}}, raw, F.col("_origin"), columns)


def video_ids(spark: SparkSession, path: str, whole_files: bool = False) -> Split:
    """As ``landed.video_ids``, but with the items that have no id, so that all items are accounted for."""
    items = _items(read_pages(spark, path, schemas.SEARCH_PAGE, whole_files, []))
    return _checked(items, {}, [F.col("item.id.videoId").alias("id"), "page_no", "pos"])


def video_details(spark: SparkSession, path: str, whole_files: bool = False) -> Split:
    """As ``landed.video_details``; times that are none, and views that are no whole number, are rejects."""
    items = _items(read_pages(spark, path, schemas.DETAIL_PAGE, whole_files))
    published, views = F.col("item.snippet.publishedAt"), F.col("item.statistics.viewCount")
    checks = {"no time": published.isNotNull() & published.try_cast("timestamp").isNull(), "views are no whole number": _not_whole(views)}
    columns = [
        F.col("item.id").alias("id"), F.col("item.snippet.title").alias("title"), published.try_cast("timestamp").alias("published_at"),
        views.alias("views"), F.col("item.statistics.commentCount").alias("comments"), F.col("item.contentDetails.duration").alias("duration"), "page_no", "pos",
    ]
    return _checked(items, checks, columns)


def video_comments(spark: SparkSession, path: str, whole_files: bool = False) -> Split:
    """As ``landed.video_comments``; likes that are no whole number are rejects."""
    items = _items(read_pages(spark, path, schemas.COMMENT_PAGE, whole_files, ["video_id"]), "video_id")
    comment = "item.snippet.topLevelComment.snippet"
    likes = F.col(f"{comment}.likeCount")
    columns = [
        "video_id", F.col(f"{comment}.textDisplay").alias("text"), _number(likes).alias("likes"), F.col(f"{comment}.authorDisplayName").alias("author"), "page_no", "pos",
    ]
    return _checked(items, {"likes are no whole number": _not_whole(likes)}, columns)


def headlines(spark: SparkSession, path: str, whole_files: bool = False) -> Split:
    """Posts of all subreddits (subreddit, title); only lines that cannot be read are rejects."""
    rows = read_pages(spark, path, schemas.LISTING, whole_files)
    return split(rows, {"unreadable page": F.col(UNREADABLE).isNotNull()}, F.col(UNREADABLE), F.col("_origin"), [F.col("subreddit"), F.col("title")])
