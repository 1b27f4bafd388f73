"""The first rows by a number when there are millions of them: the cut is found by counting, and few rows are sorted.

Rows have a whole-number ``level`` that falls along the order (the number that rows are ranked by, or a coarser one such as its
whole part). Levels are counted in ranges, then in the range that holds the cut, until the cut is one level. Rows above it
belong to the answer without having moved. Only rows at the cut are put in order, by a range sort over all tasks, so no task
holds a group's answer, however large it is and however many rows are tied.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from vocalis.session import workspace

#: Ranges that levels are counted in at once are 2 ** RANGE_BITS to twice as many, for each group.
RANGE_BITS = 10
LEAST = -(2**63)


def _written(df: DataFrame) -> DataFrame:
    path = workspace(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _range_of(level: Column, low: Column, high: Column) -> Column:
    """The number of the level's range; ranges are a power of two wide, so nothing overflows."""
    width = F.greatest(F.lit(0), F.ceil(F.log2(high.cast("double") - low.cast("double") + 1)) - RANGE_BITS)
    return F.call_function("shiftright", level, width.cast("int"))


def _beside(rows: DataFrame, state: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Every row with the state of its group; without keys the state is one row at most, which becomes constants."""
    if keys:
        same = F.lit(True)
        for k in keys:
            same = same & F.col(k).eqNullSafe(F.col(f"{k}_"))
        named = state.select(*[F.col(k).alias(f"{k}_") for k in keys], *[c for c in state.columns if c not in keys])
        return rows.join(named, same, how).drop(*[f"{k}_" for k in keys])
    found = state.first()
    beside = rows.withColumns({c: F.lit(found[c] if found else None).cast("long") for c in state.columns})
    return beside if found or how == "left" else beside.where(F.lit(False))


def cuts(rows: DataFrame, keys: Sequence[str], level: str, n: int) -> DataFrame:
    """(keys, cut, need) of every group with more than ``n`` rows: its answer is all rows with a level above ``cut`` and
    ``need`` of the rows at it.

    Each pass is an aggregate of at most some thousand ranges a group, combined in the tasks; seven passes
    divide all whole numbers, and levels that lie close together take two.
    """
    state = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"), F.min(level).alias("low"), F.max(level).alias("high"))
    state = _written(state.where(F.col("rows") > n).select(*keys, "low", "high", F.lit(n).cast("long").alias("need")))
    while not state.where("low < high").isEmpty():
        found = _beside(rows.select(*keys, level), state.where("low < high"), keys).where(F.col(level).between(F.col("low"), F.col("high")))
        ranges = found.groupBy(*keys, "need", _range_of(F.col(level), F.col("low"), F.col("high")).alias("range"))
        counted = ranges.agg(F.count(F.lit(1)).alias("rows"), F.min(level).alias("low"), F.max(level).alias("high"))
        down = W.partitionBy(*keys).orderBy(F.desc("range")).rowsBetween(W.unboundedPreceding, W.currentRow)
        counted = counted.withColumn("upto", F.sum("rows").over(down))
        crossing = counted.where((F.col("upto") >= F.col("need")) & (F.col("upto") - F.col("rows") < F.col("need")))
        crossing = crossing.select(*keys, "low", "high", (F.col("need") - F.col("upto") + F.col("rows")).alias("need"))
        state = _written(state.where("low >= high").unionByName(crossing))
    return state.select(*keys, F.col("low").alias("cut"), "need")


def _first_in_order(rows: DataFrame, groups: Sequence[str], order: Sequence[Column], kept: Sequence[str]) -> DataFrame:
    """The rows whose place in their group is below their ``need``: places within the parts of a range sort, and counts of the parts before."""
    path = workspace(rows.sparkSession)
    parted = rows.repartitionByRange(*groups, *order).sortWithinPartitions(*groups, *order)
    parted.withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    placed = rows.sparkSession.read.parquet(path).withColumn("_part", F.shiftright("_at", 33))
    parts = placed.groupBy(*groups, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = W.partitionBy(*groups).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    parts = _written(parts.select(*groups, "_part", "_first", "_before"))
    place = F.col("_at") - F.col("_first") + F.col("_before")
    return _beside(placed, parts, [*groups, "_part"]).where(place < F.col("need")).select(*kept)


def first_per_group(df: DataFrame, groups: Sequence[str], level: Column, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of every group in ``order``, for an ``n`` of any size; the same rows as ``ranking.top_per_group``.

    ``level`` is a whole number that never rises along ``order``; null counts as the lowest. A group of at most ``n`` rows
    is kept whole; a null group is a group. Rows that tie in ``order`` may stand for each other. ``df`` is read
    once per pass, with the columns of groups and level only: write it first if it is costly.
    """
    keys = [f"_group{i}" for i in range(len(groups))]
    rows = df.withColumns({k: F.col(g) for k, g in zip(keys, groups)})
    rows = rows.withColumn("_level", F.coalesce(level.cast("long"), F.lit(LEAST)))
    cut = cuts(rows, keys, "_level", n)
    above = _beside(rows, cut, keys, "left").where(F.col("cut").isNull() | (F.col("_level") > F.col("cut"))).select(*df.columns)
    tied = _beside(rows, cut, keys).where(F.col("_level") == F.col("cut")).select(*df.columns, *keys, "need")
    return above.unionByName(_first_in_order(tied, keys, order, df.columns))


def first_rows(df: DataFrame, level: Column, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows of a whole table in ``order``, unsorted; see ``first_per_group``."""
    return first_per_group(df, [], level, order, n)
