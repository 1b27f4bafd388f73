"""Writing exports, report tables, and batches of the store."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalis import schemas
from vocalis.sources import commits, tables
from vocalis.sources.tables import ATTEMPT


#: Of the store: texts take about two thirds of what Spark's default takes.
COMPRESSION = "zstd"
#: An attempt with more files than this for each source, and smaller ones on average than this, is dealt anew by source.
MOST_FILES, SMALL_BYTES = 32, 1 << 20


def write_csv(df: DataFrame, path: str, compression: str = "none") -> None:
    """Overwrite a CSV export (header, quotes doubled inside quoted text)."""
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', compression=compression)


def write_jsonl(df: DataFrame, path: str, compression: str = "none") -> None:
    """Overwrite a JSON Lines export; the only text form that keeps array columns."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path, compression=compression)


def write_store(df: DataFrame, path: str, batch: str, mode: str = "append") -> None:
    """Add a batch of labelled texts to the store, partitioned by source and batch.

    ``mode='append'`` adds rows, also when the batch was written before. ``mode='replace'`` puts the
    rows in the place of all that the batch had, of any source. Either way the rows are written apart and
    become visible at once, when they are all there: a run that is lost half way leaves the store as it was and
    can be repeated. Each task writes the rows it has, a file for each of their sources, so no text is shuffled and no task
    holds all of a source. Only if that made many small files are rows dealt to tasks by source, in parts of even size.
    """
    if mode not in ("append", "replace"):
        raise ValueError(f"unknown mode {mode!r}")
    attempt = _write_attempt(df, path, batch)

    def change(listed: commits.Attempts) -> commits.Attempts:
        kept = [pair for pair in listed if mode == "append" or pair[0] != batch]
        return [*kept, (batch, attempt)]

    commits.commit(df.sparkSession, path, change)


def _write_attempt(df: DataFrame, path: str, batch: str) -> str:
    attempt = commits.new_attempt()
    rows = df.withColumn("batch", F.lit(batch)).select(*schemas.STORE.fieldNames())
    _write_rows(rows, path, attempt)
    if not _many_small(df.sparkSession, f"{path}/{ATTEMPT}={attempt}"):
        return attempt
    dealt = commits.new_attempt()  # the first one is named nowhere, and goes
    _write_rows(tables.read_attempts(df.sparkSession, path, [(batch, attempt)]).hint("rebalance", "source"), path, dealt)
    _remove(df.sparkSession, f"{path}/{ATTEMPT}={attempt}")
    return dealt


def _write_rows(rows: DataFrame, path: str, attempt: str) -> None:
    # a folder of its own, so that writers at the same time do not clear each other's unfinished files
    rows.write.partitionBy("source", "batch").option("compression", COMPRESSION).parquet(f"{path}/{ATTEMPT}={attempt}")


def _many_small(spark: SparkSession, folder: str) -> bool:
    """Whether an attempt has many small files for its sources."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    store = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found, sources = store.getContentSummary(path), len(store.listStatus(path))
    return found.getFileCount() > MOST_FILES * sources and found.getLength() < SMALL_BYTES * found.getFileCount()


def _remove(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def remove_batch(spark: SparkSession, path: str, batch: str) -> None:
    """Take a batch of every source out of the store; other batches are not touched. ``vacuum`` removes its files."""
    commits.commit(spark, path, lambda listed: [pair for pair in listed if pair[0] != batch])


def compact(spark: SparkSession, path: str, prefix: str, batch: str) -> None:
    """Put the batches whose names start with ``prefix`` together as ``batch``; for the many small ones of a stream.

    The new batch takes the place of the old ones in one step, so a reader sees every row once, before, during and
    after, and so does a reader after a run that was lost. What is put together is what the newest list named at
    the start; a batch that is written, replaced or removed meanwhile is left as it then is, and the run fails if that
    touches a batch it has read. The new name may not start with ``prefix``.
    """
    if batch.startswith(prefix):
        raise ValueError("the new batch must be named apart from the old ones")
    old = [pair for pair in commits.read(spark, path) if pair[0].startswith(prefix)]
    if not old:
        return
    attempt = _write_attempt(tables.read_attempts(spark, path, old).drop("batch"), path, batch)

    def change(listed: commits.Attempts) -> commits.Attempts:
        if not set(old) <= set(listed):
            raise RuntimeError("a batch was changed while it was put together with others")
        return [*(pair for pair in listed if pair not in old and pair[0] != batch), (batch, attempt)]

    commits.commit(spark, path, change)


def vacuum(spark: SparkSession, path: str) -> int:
    """Remove the files of attempts that the newest list does not name, and return how many there were.

    For a time without writers and without readers of older lists: what is being written is not named yet.
    """
    named = {attempt for _, attempt in commits.read(spark, path)}
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{ATTEMPT}=*")) or ()
    gone = [s.getPath() for s in found if s.getPath().getName().removeprefix(f"{ATTEMPT}=") not in named]
    for one in gone:
        files.delete(one, True)
    return len(gone)


def write_report(df: DataFrame, path: str) -> None:
    """A report table as Parquet and, from that, as CSV; the report is computed once."""
    df.write.mode("overwrite").parquet(f"{path}/parquet")
    write_csv(df.sparkSession.read.schema(df.schema).parquet(f"{path}/parquet"), f"{path}/csv")
