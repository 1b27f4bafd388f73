"""Reports kept up to date, and word lists as tables."""

import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vocalis import lexicons, schemas
from vocalis.functions import text
from vocalis.operators import keywords, stages
from vocalis.plans import opinions, summaries
from vocalis.sources import sinks


def rows(spark, seed, n=40, sources="ab"):
    rng = random.Random(seed)
    shape = T.StructType([*schemas.LABELLED.fields, T.StructField("source", T.StringType())])
    made = [("t", "t", [], rng.sample(["x", "y", "z"], rng.randrange(4)), rng.choice(["Positive", "Negative", "Neutral", None]), rng.choice(sources)) for _ in range(n)]
    return spark.createDataFrame([(*m[:3], m[3] if rng.random() < 0.9 else None, *m[4:]) for m in made], shape)


def same(spark, store, folder, source=None):
    kept, direct = summaries.reports(spark, store, folder, source), opinions.reports(spark, store, source)
    for a, b in zip(kept, direct):
        assert a.columns == b.columns
        assert sorted(map(repr, a.collect())) == sorted(map(repr, b.collect()))


def test_reports_follow_every_change_of_the_store(spark, tmp_path):
    store, folder = str(tmp_path / "s"), str(tmp_path / "f")
    steps = [
        lambda: sinks.write_store(rows(spark, 1), store, "live-1"),
        lambda: sinks.write_store(rows(spark, 2), store, "live-2"),
        lambda: sinks.write_store(rows(spark, 3), store, "live-2"),
        lambda: sinks.write_store(rows(spark, 4, sources="b"), store, "live-1", "replace"),
        lambda: sinks.compact(spark, store, "live-", "all"),
        lambda: sinks.write_store(rows(spark, 5, 0), store, "none"),
        lambda: sinks.remove_batch(spark, store, "all"),
    ]
    for step in steps:
        step()
        same(spark, store, folder)
    same(spark, store, folder, "a")


def test_only_new_writings_are_read(spark, tmp_path, monkeypatch):
    store, folder = str(tmp_path / "s"), str(tmp_path / "f")
    for i in range(3):
        sinks.write_store(rows(spark, i), store, f"w{i}")
    assert summaries.refresh(spark, store, folder) == ["w0", "w1", "w2"] and summaries.refresh(spark, store, folder) == []
    sinks.write_store(rows(spark, 9), store, "w1", "replace")
    read, seen = summaries.tables.read_attempts, []
    monkeypatch.setattr(summaries.tables, "read_attempts", lambda spark, path, pairs: seen.extend(pairs) or read(spark, path, pairs))
    summaries.reports(spark, store, folder)
    assert [batch for batch, _ in seen] == ["w1"]
    plan = summaries.merged(spark, store, folder)
    assert all("/f/" in name for name in plan.inputFiles())


def test_an_unfinished_part_is_written_again(spark, tmp_path):
    store, folder = str(tmp_path / "s"), str(tmp_path / "f")
    sinks.write_store(rows(spark, 1), store, "w")
    summaries.refresh(spark, store, folder)
    part = next((tmp_path / "f").iterdir())
    (part / "_SUCCESS").unlink()
    assert summaries.refresh(spark, store, folder) == ["w"]
    same(spark, store, folder)


TEXTS = ["The camera is amazing, the best", "no good no", None, "the the", "", "battery the screen the camera", "battery the screen the camera", "one"]


@pytest.mark.parametrize("stop", [["the", "is", "no", "absent"], [], ["the"]])
def test_stop_words_as_a_table(spark, stop):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i long, t string").repartition(3)
    table = spark.createDataFrame([(w,) for w in [*stop, *stop]], "word string")
    listed = stages.clean_rows(df, "t", stop, keep_words=True)
    found = stages.clean_rows(df, "t", table, keep_words=True)
    assert found.columns == listed.columns
    assert sorted(map(repr, found.collect())) == sorted(map(repr, listed.collect()))
    assert stages.clean_rows(df.where("false"), "t", table).collect() == []


def test_a_million_stop_words(spark):
    table = spark.range(1_000_000).select(F.concat(F.lit("w"), F.col("id")).alias("word"))
    df = spark.createDataFrame([(1, "W5 keep w999999 this w1000000 w0"), (2, "w1 w2")], "i long, t string")
    assert [(r.i, r.cleaned) for r in stages.clean_rows(df, "t", table).collect()] == [(1, "keep this w1000000")]


def test_settings_take_tables(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "i long, t string")
    valences = lexicons.valence_table(spark)
    listed = opinions.Settings(stopwords=["the", "is"], topics={"b": ["battery"], "a": ["camera", "cam"]}, models=["one", "good"])
    as_tables = opinions.Settings(
        stopwords=spark.createDataFrame([("the",), ("is",)], "word string"), topics=keywords.keyword_table(spark, listed.topics),
        models=spark.createDataFrame([(0, "one"), (1, "good")], "rank int, model string"),
    )
    expected = opinions.label_texts(df, "t", valences, listed)
    for settings in (as_tables, opinions.Settings(stopwords=as_tables.stopwords, topics=listed.topics, models=as_tables.models)):
        found = opinions.label_texts(df, "t", valences, settings)
        assert sorted(found.columns) == sorted(expected.columns)
        assert sorted(map(repr, found.select(expected.columns).collect())) == sorted(map(repr, expected.collect()))
    assert df.select(text.words(F.col("t"), ()).alias("w")).count() == len(TEXTS)


def test_few_stop_words_are_looked_up_in_the_row(spark):
    """A short table neither writes nor shuffles the texts, and removes what the join removes."""
    df = spark.createDataFrame([(1, ["a", "the", "b", "the"]), (2, ["the"]), (3, []), (4, None)], "i long, words array<string>")
    table = spark.createDataFrame([("the",), ("the",), (None,), ("x",)], "word string")
    short, joined = stages.without_words(df, table), stages.without_words(df, table, inline_limit=0)
    assert sorted(map(repr, short.collect())) == sorted(map(repr, joined.collect()))
    assert {r.i: r.words for r in short.collect()} == {1: ["a", "b"], 2: [], 3: [], 4: None}
    assert "Exchange" not in short._jdf.queryExecution().executedPlan().toString()
