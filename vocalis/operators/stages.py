"""Table steps: distinct headlines, cleaning, mention filter, tagging."""

from __future__ import annotations

import functools
import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocalis import lexicons
from vocalis.functions import tags, text
from vocalis.functions.lookup import INLINE_LIMIT, inline_lookup
from vocalis.session import workspace


def computed_once(df: DataFrame, **values: Column) -> DataFrame:
    """``df`` with the named columns, computed one time per row however often they are used later.

    The optimizer copies a projected expression into every filter and projection that reads it,
    also into those it infers itself. It does not look into a generator, so costly columns (the
    words of a text, its score) are made by unfolding an array of one struct: no row is added or lost.
    """
    others = [c for c in df.columns if c not in values]
    row = F.struct(*[value.alias(name) for name, value in values.items()])
    return df.select(*others, F.inline(F.array(row)))


def distinct_texts(*tables: DataFrame, column: str = "headline") -> DataFrame:
    """The distinct exact texts (case-sensitive) of one column over all the tables.

    Copies collapse inside each task before the shuffle, so a text held by a third of all rows
    crosses the network once per task.
    """
    return functools.reduce(DataFrame.unionByName, [t.select(column) for t in tables]).distinct()


def clean_rows(
    df: DataFrame,
    column: str,
    stopwords: Iterable[str] | DataFrame = lexicons.STOPWORDS,
    mention: str | None = None,
    keep_words: bool = False,
) -> DataFrame:
    """``df`` plus ``cleaned``; rows with a null text, or with nothing left of it, are dropped.

    With ``mention`` only rows whose cleaned text contains it stay. ``keep_words`` also leaves the
    array ``words`` in the table, for the scorer. Stop words may be a table (word) of any size.
    """
    rows = df.where(F.col(column).isNotNull())
    if mention is not None:
        rows = rows.where(may_mention(F.col(column), mention))
    if isinstance(stopwords, DataFrame):
        rows = without_words(computed_once(rows, words=text.words(F.col(column), ())), stopwords)
    else:
        rows = computed_once(rows, words=text.words(F.col(column), stopwords))
    rows = rows.where(F.size("words") > 0)
    rows = computed_once(rows, cleaned=F.array_join("words", " "))
    if mention is not None:
        rows = mentions(rows, mention)
    return rows if keep_words else rows.drop("words")


def without_words(df: DataFrame, stopwords: DataFrame, column: str = "words", inline_limit: int = INLINE_LIMIT) -> DataFrame:
    """``df`` without the words of a table (word) of any size in its array ``column``; the others keep their order.

    A table of at most ``inline_limit`` words is carried in the plan: texts are neither written nor shuffled. Beyond that,
    each place of each distinct text meets the table by an anti-join, and the places that are left are put in
    order again within their text. Texts are told by a digest, so copies are one before they are taken apart. Rows are
    written to the shared folder first; a stream takes such a table in its micro-batches.
    """
    listed = stopwords.where("word is not null").select("word", F.lit(1).alias("listed"))
    find = inline_lookup(listed, "word", inline_limit)
    if find is not None:
        return computed_once(df, **{column: F.filter(column, lambda w: find(w).isNull())}).select(*df.columns)
    spark, path = df.sparkSession, workspace(df.sparkSession)
    computed_once(df, _digest=F.unhex(F.md5(F.to_json(F.struct(column)).cast("binary")))).write.parquet(path)
    rows = spark.read.parquet(path)
    texts = rows.select("_digest", column).dropDuplicates(["_digest"])
    places = texts.select(F.col("_digest").alias("_known"), F.posexplode(column).alias("_place", "_word"))
    left = places.join(stopwords.select(F.col("word").alias("_word")), "_word", "left_anti")
    kept = left.groupBy("_known").agg(F.sort_array(F.collect_list(F.struct("_place", "_word"))).alias("_kept"))
    joined = rows.join(kept, rows["_digest"] == kept["_known"], "left")
    words = F.coalesce(F.transform("_kept", lambda x: x["_word"]), F.array().cast("array<string>"))
    return joined.withColumn(column, F.when(F.col(column).isNotNull(), words)).select(*df.columns)


def clean_table(df: DataFrame, column: str, stopwords: Iterable[str] = lexicons.STOPWORDS) -> DataFrame:
    """Only the raw text and its cleaned form, as ``<column>`` and ``cleaned_<column>``."""
    return clean_rows(df.select(column), column, stopwords).withColumnRenamed("cleaned", f"cleaned_{column}")


def may_mention(raw: Column, word: str) -> Column:
    """False only for raw text whose cleaned form cannot contain ``word``.

    A single word of letters and digits survives cleaning only inside an unbroken run of the raw
    text, so the raw text, lower-cased, contains it as well. Spares most rows the cleaning.
    """
    return F.contains(F.lower(raw), F.lit(word)) if re.fullmatch(r"[a-z0-9]+", word) else F.lit(True)


def mentions(df: DataFrame, word: str = lexicons.MENTION, column: str = "cleaned") -> DataFrame:
    """Rows whose cleaned text contains ``word`` anywhere."""
    return df.where(F.col(column).contains(word))


def tag_rows(
    df: DataFrame,
    column: str = "cleaned",
    topics: Mapping[str, Sequence[str]] = lexicons.TOPICS,
    models: Sequence[str] = lexicons.PHONE_MODELS,
    **options,
) -> DataFrame:
    """``df`` plus the arrays ``phone_models`` and ``topics``; empty where nothing is found."""
    rows = df.withColumn("phone_models", tags.tag_models(F.col(column), models))
    return computed_once(rows, topics=tags.tag(F.col(column), topics, **options))
