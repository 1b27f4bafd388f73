"""Scoring a table of texts against a valence table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocalis.functions import polarity
from vocalis.functions.lookup import INLINE_LIMIT, inline_lookup
from vocalis.lexicons import PolarityRules
from vocalis.operators.stages import computed_once
from vocalis.session import workspace


def score(
    df: DataFrame,
    valences: DataFrame,
    words: str = "words",
    rules: PolarityRules | None = None,
    repeats: str = "first",
    inline_limit: int = INLINE_LIMIT,
) -> DataFrame:
    """``df`` plus ``compound``, the polarity of its array column ``words``; null words give null.

    Any valence table will do, and every text is scored inside its row. A table of at most
    ``inline_limit`` tokens is carried in the plan: no shuffle, whatever the number of texts. Beyond
    that, the most frequent words of the texts are, and the places of all others ask the table by a join. Both give
    the same results and need nothing but the words. The second writes the rows to the shared folder
    first, so they are made once; it needs a table at rest, and a stream labels its micro-batches
    (``streaming.live.label_into_store``).
    """
    if repeats not in ("first", "each"):
        raise ValueError(f"unknown repeats {repeats!r}")
    rules = rules or PolarityRules()
    roles = polarity.roles(valences, rules)
    find = inline_lookup(roles, "token", inline_limit)
    if find is not None:
        rows = computed_once(df, _tokens=polarity.scored_words(F.col(words)))
        rows = computed_once(rows, _roles=F.transform("_tokens", find))
    elif df.isStreaming:
        raise ValueError("a stream is scored in its micro-batches with a valence table this large: label_into_store")
    else:
        rows = _with_joined_roles(df, words, polarity.one_role(roles))
    rows = computed_once(rows, _units=polarity.text_units(F.col("_tokens"), F.col("_roles"), rules, repeats))
    return rows.select(*df.columns, polarity.compound(F.col("_units")).alias("compound"))


def label_rows(df: DataFrame, valences: DataFrame, words: str = "words", **options) -> DataFrame:
    """``df`` without its ``words`` but with ``sentiment``."""
    scored = score(df, valences, words, **options)
    return scored.withColumn("sentiment", polarity.label(F.col("compound"))).drop("compound", words)


def _with_joined_roles(df: DataFrame, words: str, roles: DataFrame, leading: int = INLINE_LIMIT) -> DataFrame:
    """``df`` plus ``_tokens``, its scored words, and ``_roles``, the role of each of them, from a table of any size.

    The ``leading`` most frequent words of all texts are looked up in the row, with or without a role. Only the places of
    other words travel: each asks for its word's role once, and the answers, put in order of the places among the
    leading ones, are the roles. So no word that travels is frequent, and a row's words travel once.
    """
    spark, path = df.sparkSession, workspace(df.sparkSession)
    df.withColumn("_row", F.monotonically_increasing_id()).write.parquet(path)
    rows = spark.read.parquet(path)
    rows = computed_once(rows, _tokens=polarity.scored_words(F.col(words)))
    counted = rows.select(F.explode("_tokens").alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    first = counted.orderBy(F.desc("n"), "token").limit(leading).select("token", F.lit(1).alias("listed"))
    find = inline_lookup(first.join(roles, "token", "left"), "token", leading)
    places = rows.select("_row", F.posexplode("_tokens").alias("i", "token"))
    role = F.struct(F.lit(1.0).alias("listed"), *[F.col(n).cast("double").alias(n) for n in ("valence", "boost", "factor")])
    asked = places.where(find(F.col("token")).isNull()).join(roles, "token", "left").select("_row", F.struct("i", role.alias("r")).alias("answer"))
    found = asked.groupBy(F.col("_row").alias("_known")).agg(F.collect_list("answer").alias("_asked"))
    joined = rows.join(found, rows["_row"] == found["_known"], "left")

    listed = F.transform("_tokens", lambda t, i: F.struct(i.alias("i"), find(t).alias("r")))
    listed = F.filter(listed, lambda x: x["r"].isNotNull())
    in_order = F.transform(F.sort_array(F.concat(listed, "_asked")), lambda x: x["r"])
    every = F.when(F.col("_asked").isNull(), F.transform("_tokens", find)).otherwise(in_order)
    return computed_once(joined, _roles=every).drop("_row", "_known", "_asked")
