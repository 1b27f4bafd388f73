"""Reading stage tables, and the store of labelled texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vocalis import lexicons, schemas
from vocalis.sources import commits

#: Every writing of a batch has a folder of its own with this name.
ATTEMPT = "attempt"


def read_csv(spark: SparkSession, path: str, schema: T.StructType, missing_tokens: bool = True) -> DataFrame:
    """A CSV export. With ``missing_tokens`` the texts that stand for a missing value ("nan", "null") become null."""
    df = spark.read.schema(schema).csv(path, header=True, multiLine=True, quote='"', escape='"', mode="FAILFAST")
    if not missing_tokens:
        return df
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.when(~F.col(c).isin(*lexicons.MISSING_TOKENS), F.col(c)) for c in texts})


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line; a line that is none fails the query."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def read_attempts(spark: SparkSession, path: str, attempts: commits.Attempts) -> DataFrame:
    """The rows that some attempts wrote; others are not listed."""
    if not attempts:
        return spark.createDataFrame([], schemas.STORE)
    paths = [f"{path}/{ATTEMPT}={attempt}" for _, attempt in attempts]
    return spark.read.schema(schemas.STORE).option("basePath", path).parquet(*paths)


def read_store(spark: SparkSession, path: str, source: str | None = None, version: int | None = None) -> DataFrame:
    """The labelled texts of the committed batches; with ``source`` only that partition is listed and read.

    With ``version`` as of an earlier commit, as long as its files are there.
    """
    df = read_attempts(spark, path, commits.read(spark, path, version))
    return df if source is None else df.where(F.col("source") == source)
