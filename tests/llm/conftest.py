import os

import pytest
from pyspark.sql import types as T

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

LONG = "the quick brown fox jumps over a lazy dog near that old stone bridge " * 3000
PLAIN = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen"

ROWS = [
    (1, PLAIN, "en", "a", 1),
    (2, PLAIN, "en", "a", 1),  # a tie
    (2, PLAIN, "en", "a", 1),  # a repeated row
    (3, None, None, None, None),
    (4, "", "en", "b", 0),
    (5, " \n\t ", "en", "b", 4),
    (None, "no key here, mail me@x.org", "en", "c", 3),
    (6, LONG, "en", None, 9),
    (7, "Mixed CASE Été İstanbul — naïve words 😀 Apache License and CC-BY", "fr", "c", 2),
    (8, "word", "en", "c", 1),
    (None, None, None, None, None),
]
#: Extra columns with the names that the operators use themselves.
CLASHING = ["size", "row", "key", "taken", "copies", "node", "component", "word", "place", "item", "_text", "_key", "_place", "_at", "part", "file", "a.b"]


def schema(extra=()):
    names = ["lang", "source"]
    fields = [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
    fields += [T.StructField(n, T.StringType()) for n in names] + [T.StructField("n_chars", T.LongType())]
    return T.StructType(fields + [T.StructField(c, T.StringType()) for c in extra])


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls in every column, empty and very long texts, ties, repeated rows, clashing names."""
    return spark.createDataFrame([(*r, *(c for c in CLASHING)) for r in ROWS], schema(CLASHING)).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], schema(CLASHING))


@pytest.fixture(scope="session")
def documents(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")
