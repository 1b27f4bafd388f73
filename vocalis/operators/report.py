"""The report tables: sentiment shares and the topic by sentiment matrix."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SENTIMENTS = ["Negative", "Neutral", "Positive"]


def sentiment_distribution(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per sentiment (null is a sentiment of its own) and their share of the total, per ``by``.

    The window runs over the counts, at most four rows per ``by`` group.
    """
    counts = df.groupBy(*by, "sentiment").agg(F.count(F.lit(1)).alias("count"))
    share = F.col("count") / F.sum("count").over(W.partitionBy(*by))
    return counts.withColumn("share", share)


def percent(share: Column) -> Column:
    """A share as the text a chart shows: one decimal and a per cent sign."""
    return F.format_string("%.1f%%", share * 100)


def topic_counts(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows per topic and sentiment; a row counts once for each of its topics, not at all without one."""
    mentions = df.where(F.col("topics").isNotNull()).select(*by, F.explode("topics").alias("topic"), "sentiment")
    return mentions.groupBy(*by, "topic", "sentiment").agg(F.count(F.lit(1)).alias("count"))


def topic_matrix(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per topic, one column per sentiment, 0 where there is no row; null sentiments are left out.

    The columns are known, so a count per column in one aggregate gives the pivot with one shuffle,
    of as many rows as there are topics in each task.
    """
    mentions = df.where(F.col("topics").isNotNull() & F.col("sentiment").isNotNull())
    mentions = mentions.select(*by, F.explode("topics").alias("topic"), "sentiment")
    columns = [F.count_if(F.col("sentiment") == name).alias(name) for name in SENTIMENTS]
    return mentions.groupBy(*by, "topic").agg(*columns).orderBy(*by, "topic")
