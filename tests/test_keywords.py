"""Large keyword lists as tables give what the in-row tags give."""

import random

import pytest
from pyspark.sql import functions as F

from vocalis.functions import tags
from vocalis.operators import keywords

LETTERS = "abcde0 "


def word(rng, most=6):
    return "".join(rng.choice(LETTERS[:-1]) for _ in range(rng.randint(1, most)))


def texts(spark, rng, n=120):
    rows = [(i, " ".join(word(rng) for _ in range(rng.choice([1, 3, 20, 80])))) for i in range(n)] + [(n, None), (n, ""), (0, "a"), (0, "a")]
    return spark.createDataFrame(rows, "i long, cleaned string").repartition(3)


@pytest.mark.parametrize("mode, tagged", [("token", keywords.tag_words), ("substring", keywords.tag_anywhere)])
def test_equal_to_the_in_row_form(spark, mode, tagged):
    rng = random.Random(8)
    forms = lambda: " ".join(word(rng, 4) for _ in range(rng.choice([1, 1, 1, 2, 3])))
    topics = {f"t{i % 41}": [] for i in range(700)}
    for i in range(700):
        topics[f"t{i % 41}"].append(rng.choice([forms(), forms(), "Upper", "two  spaces", " a", "é", ""]) if i % 9 == 0 else forms())
    df = texts(spark, rng)
    expected = df.select("i", "cleaned", tags.tag(F.col("cleaned"), topics, mode=mode).alias("topics"))
    found = tagged(df, keywords.keyword_table(spark, topics))
    assert found.columns == ["i", "cleaned", "topics"]
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))
    assert sum(len(r.topics) for r in found.collect()) > 500


@pytest.mark.parametrize("tagged", [keywords.tag_words, keywords.tag_anywhere])
def test_nothing_to_find(spark, tagged):
    df, none = texts(spark, random.Random(1), 5), keywords.keyword_table(spark, {"t": ["X", "not here", "zzz", "z"]})
    assert all(r.topics == [] for r in tagged(df, none).collect())
    assert all(r.topics == [] for r in tagged(df, none.where("false")).collect())
    assert tagged(df.where("false"), none).collect() == []


def test_a_hundred_thousand_keywords(spark):
    """The list is joined: no constant of its size is in the plan, and no row loops over it."""
    table = spark.range(100_000).select((F.col("id") % 50).cast("string").alias("topic"), F.concat(F.lit("k"), F.hex("id")).alias("keyword"))
    table = table.withColumn("keyword", F.lower("keyword"))
    df = spark.createDataFrame([(1, "k1869f x k0"), (2, "akffz k"), (3, "none")], "i long, cleaned string")
    by_word = {r.i: r.topics for r in keywords.tag_words(df, table).collect()}
    anywhere = {r.i: r.topics for r in keywords.tag_anywhere(df, table).collect()}
    assert by_word == {1: ["0", "49"], 2: [], 3: []}
    assert anywhere[2] == ["15", "5"] and set(by_word[1]) <= set(anywhere[1]) and anywhere[3] == []
    plan = keywords.tag_words(df, table)._jdf.queryExecution().executedPlan().toString()
    assert "k1869f" not in plan and "BatchEvalPython" not in plan


def test_long_texts_stay_linear(spark):
    df = spark.createDataFrame([(1, "abc " * 100_000 + "needle")], "i long, cleaned string")
    table = keywords.keyword_table(spark, {"n": ["needle", "abc abc abc d"], "a": ["bc ab"]})
    assert keywords.tag_anywhere(df, table).first().topics == ["n", "a"]
    assert keywords.tag_words(df, table).first().topics == ["n"]


@pytest.mark.parametrize("leading", [0, 5, 100_000])
def test_several_lists_in_one_pass(spark, leading):
    """Whether words and keywords are broadcast or joined, each list gives what the in-row form gives."""
    rng = random.Random(3)
    forms = lambda: " ".join(word(rng, 3) for _ in range(rng.choice([1, 1, 2, 2, 3, 4])))
    lists = {name: {f"{name}{i}": [forms() for _ in range(12)] for i in range(9)} for name in ("p", "q")}
    df = texts(spark, rng, 60).union(spark.createDataFrame([(7, "ab  cd a"), (8, " ab cd "), (9, "é ab cdé")], "i long, cleaned string"))
    expected = df.select("*", *[tags.tag(F.col("cleaned"), topics).alias(name) for name, topics in lists.items()])
    tables = {name: keywords.keyword_table(spark, topics) for name, topics in lists.items()}
    found = keywords.tag_lists(df, tables, leading=leading)
    assert sorted(map(repr, found.collect())) == sorted(map(repr, expected.collect()))


def test_the_different_words_are_searched_not_the_texts(spark, monkeypatch):
    searched, inside = [], keywords._inside
    monkeypatch.setattr(keywords, "_inside", lambda words, table: searched.append(words.count()) or inside(words, table))
    df = spark.range(500).select("id", F.lit("battery of the camera battery").alias("cleaned"))
    found = keywords.tag_anywhere(df, keywords.keyword_table(spark, {"b": ["atter"], "c": ["y of"]}))
    assert searched == [4] and {tuple(r.topics) for r in found.collect()} == {("b", "c")}
