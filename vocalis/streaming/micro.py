"""Micro-batches that count exactly once in a result kept beside the stream.

The result is a folder of attempts and a committed list of them, as the store has. A micro-batch is named by its
stream's id, which the checkpoint keeps, and its number; one that the list names already was merged whole before the
failure after which the stream repeats it, and is passed over.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from vocalis.sources import commits
from vocalis.sources.tables import ATTEMPT

#: Merges the rows of a micro-batch (rows, number) and writes what comes of it to the folder.
Merge = Callable[[DataFrame, int, str], None]


def _stream_id(spark: SparkSession, checkpoint: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(checkpoint, "metadata")
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))["id"]
    finally:
        stream.close()


def _split(name: str) -> tuple[str, int]:
    stream, number = name.rsplit(":", 1)
    return stream, int(number)


def folders(spark: SparkSession, path: str) -> list[str]:
    """The folders of the micro-batches that count, in their order."""
    return [f"{path}/{ATTEMPT}={attempt}" for _, attempt in commits.read(spark, path)]


def merge_batch(rows: DataFrame, number: int, stream: str, path: str, merge: Merge) -> bool:
    """Merges one micro-batch unless it was merged before; whether it was merged now."""
    spark = rows.sparkSession
    listed = [_split(name) for name, _ in commits.read(spark, path)]
    if any(other != stream for other, _ in listed):
        raise ValueError(f"{path} is the result of another stream or of a lost checkpoint")
    if any(number <= known for _, known in listed):
        return False
    attempt = commits.new_attempt()
    merge(rows, number, f"{path}/{ATTEMPT}={attempt}")
    commits.commit(spark, path, lambda pairs: [*pairs, (f"{stream}:{number}", attempt)])
    return True


def merged(stream: DataFrame, path: str, checkpoint: str, merge: Merge, **trigger) -> StreamingQuery:
    """Starts a stream whose micro-batches are merged into the result at ``path``, which belongs to this stream alone."""

    def apply(rows: DataFrame, number: int) -> None:
        merge_batch(rows, number, _stream_id(rows.sparkSession, checkpoint), path, merge)

    query = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return query.trigger(**(trigger or {"availableNow": True})).start()


def fold(spark: SparkSession, path: str, write: Callable[[str], None]) -> None:
    """Puts the micro-batches merged so far together in one folder, which ``write`` fills; at a time when the stream rests."""
    listed = commits.read(spark, path)
    if len(listed) < 2:
        return
    attempt = commits.new_attempt()
    write(f"{path}/{ATTEMPT}={attempt}")

    def change(pairs: commits.Attempts) -> commits.Attempts:
        if pairs != listed:
            raise RuntimeError("a micro-batch was merged meanwhile")
        return [(listed[-1][0], attempt)]

    commits.commit(spark, path, change)
