"""Mixing sources to target weights by systematic sampling.

Within its source every document is expected target / source size times. The expected copies are summed
up along the source in the order of size; one random offset is added per source, and a document is
emitted once for every whole number its interval of the sum crosses. So no document leaves its expected
number by one copy or more, and as neighbours have like sizes the words taken stay within about one
document of the target. Only DataFrame operations; the sums are distributed (``place_in_order``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vocalis.llm import common

WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST = 2
SEED = "mix-1"


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST) -> DataFrame:
    """The target of every source, from (source, source_size), one row each.

    Weights repeat over the sources by code point, null last. The targets add up to ``share`` of all
    sizes; none passes ``most`` times its source, and what is beyond goes to the others by weight until
    none is above: with the sources in the order of limit / weight, all before the first one whose limit
    is not reached stand at their limit.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.row_number().over(by_name) - 1) % len(weights) + 1)
    rows = sources.withColumn("_weight", weight).withColumn("_limit", F.col("source_size") * most)
    by_ratio = Window.orderBy(F.col("_limit") / F.col("_weight"), F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy()) * share
    left = total - F.coalesce(F.sum("_limit").over(before), F.lit(0))
    rows = rows.withColumn("_level", left / F.sum("_weight").over(after))
    open_level = F.when(F.col("_level") * F.col("_weight") < F.col("_limit"), F.col("_level"))
    level = F.first(open_level, ignorenulls=True).over(by_ratio.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    reached = F.least(F.col("_limit").cast("double"), F.col("_weight") * level)
    return rows.select("source", "source_size", F.coalesce(reached, F.col("_limit").cast("double")).alias("target"))


def offset(source: Column, seed: str = SEED) -> Column:
    """The source's random offset in [0, 1), the same in every run."""
    name = F.concat(F.lit(seed), F.coalesce(F.concat(F.lit("="), source), F.lit("")))
    return F.conv(F.substring(F.md5(name.cast("binary")), 1, 8), 16, 10).cast("double") / 2**32


def plan(
    docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
    weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: int = MOST, seed: str = SEED, keep: list[str] | None = None,
) -> DataFrame:
    """One row per document: ``row`` (the document), source, size, source_size, target, copies, taken.

    ``row`` keeps all columns, or those in ``keep``, whatever their names. A null or empty text has size 0: it may be emitted,
    with no words. A null source is a source of its own. Rows that share a key are separate documents
    and may share their places. An empty table gives no rows.
    """
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if keep is None or c in keep]).alias("row"),
        F.col(source).alias("source"), F.col(key).alias("key"), common.n_tokens(F.col(text)).alias("size"),
    )
    placed = common.place_in_order(sized, ["size", "key"], within="source")
    sources = placed.groupBy("source").agg(F.sum("size").alias("source_size"))
    aims = common.written(targets(sources, weights, share, most).withColumnRenamed("source", "_source"))
    rows = placed.join(aims, placed["source"].eqNullSafe(aims["_source"])).drop("_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at = lambda place: F.floor(rate * place + offset(F.col("source"), seed))
    rows = rows.withColumn("copies", at(F.col("_place") + 1) - at(F.col("_place")))
    taken = F.col("copies") * F.col("size")
    return rows.select("row", "source", "size", "source_size", "target", "copies", taken.alias("taken"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The documents of the mix, each as often as it is taken, with the columns of ``docs``."""
    copies = F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int")))
    return plan(docs, **options).select("row", copies.alias("_copy")).select("row.*")
