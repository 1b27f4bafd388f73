"""Connected components of a table of links, by distributed rounds; nothing of the links goes to the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocalis.llm import common


def components(links: DataFrame, most_rounds: int = 64) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b), the component being its smallest node.

    Alternating star rounds: every node hands the smallest node it knows to its larger neighbours, then to
    its smaller ones, until each node links to its smallest one alone. Rounds grow with the logarithm of the longest path.
    Every round is written, so a lost executor repeats one round. No row gathers the neighbours of a node.
    """
    both = links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    pairs = common.written(both.distinct())
    state = _state(pairs)
    for _ in range(most_rounds):
        pairs = common.written(_small_star(common.written(_large_star(pairs))))
        now = _state(pairs)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("the components did not settle")
    smallest = pairs.select("b").distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
        smallest.select(F.col("b").alias("node"), F.col("b").alias("component"))
    )


def _state(pairs: DataFrame) -> tuple:
    """Count and a sum of hashes; equal before and after a round if nothing changed."""
    code = F.xxhash64("a", "b").cast("decimal(20,0)")
    return tuple(pairs.agg(F.count(F.lit(1)), F.sum(code)).head())


def _large_star(pairs: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest node among the node and its neighbours."""
    sides = pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    lowest = sides.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("u"), F.least("a", "m").alias("m"))
    moved = sides.where(F.col("b") > F.col("a")).join(lowest, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.where(F.col("a") != F.col("b")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them; ``a`` is larger than ``b`` in every row."""
    lowest = pairs.groupBy("a").agg(F.min("b").alias("m")).withColumnRenamed("a", "u")
    moved = pairs.join(lowest, F.col("a") == F.col("u")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    own = lowest.select(F.col("u").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(own).where(F.col("a") != F.col("b")).distinct()
