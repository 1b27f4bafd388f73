"""The whole chain: landed pages -> labelled texts -> store -> report."""

from __future__ import annotations

import datetime
import functools
from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalis import lexicons, schemas
from vocalis.lexicons import PolarityRules
from vocalis.operators import keywords, ranking, report, scoring, stages
from vocalis.sources import chains, landed, rejects, sinks, tables

HEADLINES, COMMENTS = "headlines", "comments"


@dataclass(frozen=True)
class Settings:
    """What a run reads apart from its pages. Stop words (word), topics (topic, keyword) and models (model) may be tables of any size."""

    stopwords: Iterable[str] | DataFrame = tuple(lexicons.STOPWORDS)
    topics: Mapping[str, Sequence[str]] | DataFrame = field(default_factory=lambda: dict(lexicons.TOPICS))
    models: Sequence[str] | DataFrame = tuple(lexicons.PHONE_MODELS)
    mention: str = lexicons.MENTION
    search: str | None = None  # for landed pages that no search made, as a search has matched titles already
    whole_files: bool = False  # pages are one document per file, not one per line
    pages: str = "once"  # a page that landed again counts once; "complete" also fails if a chain of pages lacks one
    subreddits: Sequence[str] = tuple(lexicons.SUBREDDITS)
    days: int = ranking.LOOKBACK_DAYS
    min_seconds: float = ranking.MIN_SECONDS
    n_videos: int = ranking.TOP_VIDEOS
    n_comments: int = ranking.TOP_COMMENTS
    dedupe: str = "before"
    repeats: str = "first"
    rules: PolarityRules = field(default_factory=PolarityRules)


def label_texts(
    df: DataFrame,
    column: str,
    valences: DataFrame,
    settings: Settings = Settings(),
    tags: bool = True,
    keep: Column | None = None,
    **options,
) -> DataFrame:
    """Clean, tag and label one text column: ``df`` plus ``cleaned, phone_models, topics, sentiment``.

    All row-local: with an inlined valence table the texts are read once and never shuffled. Rows
    that fail ``keep``, a condition on ``cleaned``, are dropped before the costly steps. Without
    ``tags`` no topics or models are looked for, as the optimizer cannot leave them out later.
    """
    rows = stages.clean_rows(df, column, settings.stopwords, keep_words=True)
    rows = rows if keep is None else rows.where(keep)
    if tags:
        rows = keywords.tag_rows(rows, settings.topics, settings.models)
    rules = settings.rules
    if not isinstance(settings.stopwords, DataFrame):
        rules = rules.reachable(settings.stopwords)
    return scoring.label_rows(rows, valences, rules=rules, repeats=settings.repeats, **options)


def best_comments(
    search: DataFrame, details: DataFrame, comments: DataFrame, anchor: datetime.datetime, settings: Settings = Settings()
) -> DataFrame:
    """Raw comments (``video_id, video_title, comment``) of the most viewed recent videos."""
    found = ranking.recent(details, "published_at", anchor, settings.days)
    if settings.search:
        found = ranking.matching(found, "title", settings.search)
    videos = ranking.eligible_videos(ranking.with_details(search, found), settings.min_seconds)
    videos = ranking.top_videos(videos, settings.n_videos, settings.dedupe, ("page_no", "pos"))
    picked = ranking.top_comments(ranking.comments_of(videos, comments), settings.n_comments)
    return ranking.flat_comments(picked)


def headline_texts(listings: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """Distinct titles of the settings' subreddits; those that cannot hold the mention are left out early."""
    titles = landed.headlines(listings, settings.subreddits)
    return stages.distinct_texts(titles.where(stages.may_mention(F.col("headline"), settings.mention)))


def store_rows(
    headlines: DataFrame, comments: DataFrame, valences: DataFrame, settings: Settings = Settings()
) -> DataFrame:
    """Labelled headlines and comments in the shape of the store, from one pass over both.

    Only headlines must hold the mention in their cleaned text.
    """
    texts = headlines.select(F.col("headline").alias("text"), F.lit(HEADLINES).alias("source"))
    texts = texts.unionByName(comments.select(F.col("comment").alias("text"), F.lit(COMMENTS).alias("source")))
    wanted = (F.col("source") != HEADLINES) | F.col("cleaned").contains(settings.mention)
    return label_texts(texts, "text", valences, settings, keep=wanted).select(*schemas.LABELLED.fieldNames(), "source")


def run(
    spark: SparkSession,
    landing: str,
    store: str,
    batch: str,
    anchor: datetime.datetime,
    valences: DataFrame,
    settings: Settings = Settings(),
    mode: str = "append",
    reject_folder: str | None = None,
) -> dict[str, dict[str, int]]:
    """One batch: read the pages under ``landing``, write their labelled texts to ``store``.

    Expects the folders ``search``, ``details``, ``comments`` and ``listings``. Both sources are
    written by one job, so an error in either fails the whole batch. Anything that cannot be read is an error, unless
    there is a ``reject_folder``: then it is written there as a table (origin, reasons, raw) by folder and batch, and
    the counts of items read, kept and rejected are returned by folder.
    """
    counts: dict[str, dict[str, int]] = {}
    if reject_folder is None:
        headlines, comments = read_batch(spark, landing, anchor, settings)
    else:
        headlines, comments, bad, counts = read_with_rejects(spark, landing, anchor, settings)
        bad.withColumn("batch", F.lit(batch)).write.partitionBy("folder", "batch").mode("overwrite").option("partitionOverwriteMode", "dynamic").parquet(reject_folder)
    sinks.write_store(store_rows(headlines, comments, valences, settings), store, batch, mode)
    return counts


def read_batch(
    spark: SparkSession, landing: str, anchor: datetime.datetime, settings: Settings = Settings()
) -> tuple[DataFrame, DataFrame]:
    """Raw headlines and raw comments out of the pages under ``landing``."""

    def pages(name: str, schema) -> DataFrame:
        return landed.read_pages(spark, f"{landing}/{name}", schema, settings.whole_files)

    def chain(name: str, schema, keys: list[str]) -> DataFrame:
        if settings.pages not in ("once", "complete"):
            raise ValueError(f"unknown pages {settings.pages!r}")
        return (chains.once if settings.pages == "once" else chains.complete)(pages(name, schema), keys)

    search = landed.video_ids(chain("search", schemas.SEARCH_PAGE, []))
    details = landed.video_details(pages("details", schemas.DETAIL_PAGE))
    comments = landed.video_comments(chain("comments", schemas.COMMENT_PAGE, ["video_id"]))
    listings = pages("listings", schemas.LISTING)
    return headline_texts(listings, settings), best_comments(search, details, comments, anchor, settings)


def read_with_rejects(
    spark: SparkSession, landing: str, anchor: datetime.datetime, settings: Settings = Settings()
) -> tuple[DataFrame, DataFrame, DataFrame, dict[str, dict[str, int]]]:
    """As ``read_batch`` without failing on what cannot be read: also the rejects by ``folder``, and counts by folder."""
    readers = {"search": rejects.video_ids, "details": rejects.video_details, "comments": rejects.video_comments, "listings": rejects.headlines}
    read = {name: reader(spark, f"{landing}/{name}", settings.whole_files) for name, reader in readers.items()}
    bad = [part.rejected.withColumn("folder", F.lit(name)) for name, part in read.items()]
    ids = read["search"].kept.where("id is not null")
    comments = best_comments(ids, read["details"].kept, read["comments"].kept, anchor, settings)
    headlines = headline_texts(read["listings"].kept, settings)
    return headlines, comments, functools.reduce(DataFrame.unionByName, bad), {name: part.counts for name, part in read.items()}


def export_stages(
    headlines: DataFrame,
    comments: DataFrame,
    valences: DataFrame,
    folder: str,
    settings: Settings = Settings(),
    compression: str = "none",
) -> None:
    """Every stage of one batch as text files: raw and clean tables as CSV, tagged and labelled ones as JSON Lines.

    Each stage is computed once and the next one reads what was exported. ``compression`` is one that Spark's readers undo by
    themselves, such as ``gzip``; a stage of large batches then takes about a third of the disk.
    """
    spark = headlines.sparkSession
    for name, raw, column in ((HEADLINES, headlines, "headline"), (COMMENTS, comments, "comment")):
        raw.write.mode("overwrite").option("compression", sinks.COMPRESSION).parquet(f"{folder}/{name}/rows")
        kept = spark.read.schema(raw.schema).parquet(f"{folder}/{name}/rows")
        sinks.write_csv(kept, f"{folder}/{name}/raw", compression)
        sinks.write_csv(stages.clean_table(kept, column, settings.stopwords), f"{folder}/{name}/clean", compression)
    again = [spark.read.schema(df.schema).parquet(f"{folder}/{name}/rows") for name, df in ((HEADLINES, headlines), (COMMENTS, comments))]
    rows = store_rows(*again, valences, settings)
    for name in (HEADLINES, COMMENTS):
        labelled = rows.where(F.col("source") == name).select(*schemas.LABELLED.fieldNames())
        sinks.write_jsonl(labelled, f"{folder}/{name}/labelled", compression)
        tagged = tables.read_jsonl(rows.sparkSession, f"{folder}/{name}/labelled", schemas.LABELLED)
        sinks.write_jsonl(tagged.select(*schemas.TAGGED.fieldNames()), f"{folder}/{name}/tagged", compression)


def reports(spark: SparkSession, store: str, source: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The share-of-sentiment table and the topic by sentiment matrix, of one source or of each."""
    rows = tables.read_store(spark, store, source).select("source", "topics", "sentiment")
    by = ["source"]
    return report.sentiment_distribution(rows, by), report.topic_matrix(rows, by)


def write_reports(spark: SparkSession, store: str, folder: str) -> None:
    """Both report tables of every source under ``folder``."""
    distribution, matrix = reports(spark, store)
    sinks.write_report(distribution.withColumn("percent", report.percent(F.col("share"))), f"{folder}/distribution")
    sinks.write_report(matrix, f"{folder}/matrix")
