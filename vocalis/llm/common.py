"""What the operators of this subpackage share: words, per-text Arrow passes, written tables, places in an order."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vocalis.session import workspace

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
#: A run of digits, a-z and characters beyond ASCII, in text that went through ``ascii_lower``.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN_WORDS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: A run of anything but ASCII white space.
TOKEN = r"[^\x20\x09-\x0D]+"
#: Texts handled at once in Python; bounds the memory beside the Arrow batch.
SLICE_ROWS = 256


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Texts that are all ASCII take the fast built-in."""
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def words(text: Column) -> Column:
    """The words of a text in order, A-Z lower-cased; none for a null text."""
    return F.array_remove(F.split(F.coalesce(ascii_lower(text), F.lit("")), BETWEEN_WORDS), "")


def n_tokens(text: Column) -> Column:
    """How many runs of anything but ASCII white space; 0 for a null text."""
    return F.coalesce(F.regexp_count(text, F.lit(TOKEN)), F.lit(0)).cast("long")


def written(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends here and no row is made twice."""
    path = workspace(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _find_package(df: DataFrame) -> None:
    """Python workers import this package from where the driver did; with a shipped package this changes nothing."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = df.sparkSession.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [root, env.get("PYTHONPATH", "")]))


def map_arrow(df: DataFrame, function: Callable[[Iterator[pa.RecordBatch]], Iterable[pa.RecordBatch]], schema: T.StructType) -> DataFrame:
    _find_package(df)
    return df.mapInArrow(function, schema)


def per_text(
    docs: DataFrame,
    make: Callable[[], Callable[[list[bytes]], dict[str, list]]],
    columns: str,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per document: its key, and the columns that a function of the whole text gives.

    ``make`` is called once per task and returns a function from UTF-8 texts (null as empty) to column
    values. Only key and text travel to Python, in Arrow batches; no shuffle.
    """
    schema = T.StructType([T.StructField(key, docs.schema[key].dataType), *T.StructType.fromDDL(columns).fields])
    arrow = to_arrow_schema(schema)

    def run(batches):
        function = make()
        for batch in batches:
            for start in range(0, batch.num_rows, SLICE_ROWS):
                part = batch.slice(start, SLICE_ROWS)
                values = function([t or b"" for t in part.column(1).to_pylist()])
                made = [pa.array(values[f.name], f.type) for f in list(arrow)[1:]]
                yield pa.RecordBatch.from_arrays([part.column(0).cast(arrow[0].type), *made], schema=arrow)

    return map_arrow(docs.select(F.col(key), F.col(text).cast("binary").alias("_text")), run, schema)


def place_in_order(rows: DataFrame, order: list[str], within: str | None = None) -> DataFrame:
    """``rows`` with ``_place``, the row's place from 0 in ``order`` (among the rows of the same ``within``).

    A distributed prefix sum: rows are range-partitioned and sorted once and written with their place in
    their partition; the counts of the partitions before are added. The counts are written, so the planner knows how small
    they are and does not shuffle the rows to join them. No task holds a whole group, however
    large, and only the counts, one per partition and group, meet in a window. Fully equal rows may
    change places with each other; nulls come first.
    """
    keys = [within, *order] if within else order
    parted = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn("_at", F.monotonically_increasing_id())
    placed = written(parted).withColumn("_part", F.shiftright("_at", 33))
    group = F.col(within) if within else F.lit(0)
    blocks = placed.groupBy("_part", group.alias("_group")).agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("_group").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    blocks = written(blocks.select(F.col("_part").alias("_part_"), "_group", "_first", "_before"))
    same = (placed["_part"] == blocks["_part_"]) & group.eqNullSafe(blocks["_group"])
    place = F.col("_at") - F.col("_first") + F.col("_before")
    return placed.join(blocks, same).withColumn("_place", place).drop("_part", "_at", "_part_", "_group", "_first", "_before")
