import random

import model
from pyspark.sql import functions as F

from vocalis import lexicons
from vocalis.functions import text
from vocalis.operators import stages

STOP = ["the", "t", "don"]
EDGE_ROWS = [
    ("Don't  STOP", "stop"),
    ("1️⃣ first", "first"),
    ("1⃣first 2", "first 2"),
    ("\U0001f600ok", "ok"),
    ("café 100%", "caf 100"),
    ("A\u00a0b", "a b"),
    ("A\ufeffb", "a b"),
    ("x\u001cy", "x y"),
    ("\u0130stanbul \u212aelvin", "stanbul elvin"),
    ("a_b-c", "a b c"),
    ("line\nbreak\ttab", "line break tab"),
    ("!!!", ""),
    ("", ""),
    ("the THE The", ""),
    ("null nan", "null nan"),
]


def cleaned(spark, texts, stop):
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return [r["c"] for r in df.select("i", text.clean(F.col("t"), stop).alias("c")).orderBy("i").collect()]


def test_edge_rows(spark):
    assert cleaned(spark, [t for t, _ in EDGE_ROWS], STOP) == [c for _, c in EDGE_ROWS]


def test_null_stays_null_and_no_stopwords(spark):
    assert cleaned(spark, [None, "The end"], []) == [None, "the end"]


def test_random_strings_agree_with_the_model(spark):
    rng = random.Random(7)
    alphabet = "aAzZ09 the\t\n\u00a0\u001c\u0085 \u0130\u0131\u212a\u017f\u00df\u00e9\u00c0" + "1\ufe0f\u20e3#*'_-\U0001f600\U0001f44d\u200d"
    texts = ["".join(rng.choices(alphabet, k=rng.randint(0, 40))) for _ in range(2000)]
    stop = ["the", "a", "z0"]
    got = cleaned(spark, texts, stop)
    assert got == [" ".join(model.words(t, stop)) for t in texts]
    assert cleaned(spark, got, stop) == got


def test_every_character_is_cleaned_as_in_the_model(spark):
    points = [c for c in range(1, 0x110000) if not 0xD800 <= c <= 0xDFFF and c != 0xFEFF]  # decode eats the mark
    rows = spark.createDataFrame([(points[i : i + 1000],) for i in range(0, len(points), 1000)], "p array<int>")
    marked = F.concat(F.lit("x"), F.expr("decode(unhex(lpad(hex(p), 8, '0')), 'utf-32')"), F.lit("y"))
    kept = rows.select(F.explode("p").alias("p")).select("p", text.clean(marked, []).alias("c")).where("c <> 'x y'")
    got = {r["p"]: r["c"] for r in kept.collect()}
    assert got == {ord(c): f"x{c.lower()}y" for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"}


def test_stop_list_removes_the_words_the_scorer_would_use():
    assert {"not", "but", "very", "no", "like", "thanks"} <= set(lexicons.STOPWORDS)
    assert not {"never", "without", "cannot", "least"} & set(lexicons.STOPWORDS)
    assert len(lexicons.ENGLISH_STOPWORDS) == 179
    assert len(set(lexicons.COMMENT_STOPWORDS)) == 124  # one more entry of two words can match no token


def test_blank_and_null_rows_are_dropped(spark):
    df = spark.createDataFrame([("ok",), ("😀ok",), (None,), ("",), ("fine day",)], "comment string")
    rows = stages.clean_table(df, "comment").collect()
    assert [tuple(r) for r in rows] == [("fine day", "fine day")]
    assert rows[0].asDict().keys() == {"comment", "cleaned_comment"}


def test_mention_filter_keeps_what_the_cleaned_text_contains(spark):
    texts = ["My iPhone", "xIPHONE16x", "i phone", "İPHONE", "ıphone", "iph­one", None, "android", "i̇phone"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    kept = {r["t"] for r in stages.clean_rows(df, "t", ["my"], mention="iphone").collect()}
    assert kept == {t for t in texts if t and "iphone" in " ".join(model.words(t, ["my"]))}
    two_words = {r["t"] for r in stages.clean_rows(df, "t", ["my"], mention="i phone").collect()}
    assert two_words == {t for t in texts if t and "i phone" in " ".join(model.words(t, ["my"]))}
    assert {r["t"] for r in stages.mentions(stages.clean_rows(df, "t", ["my"]), "iphone").collect()} == kept


def test_cleaning_runs_once_per_row_and_in_the_jvm(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = stages.clean_rows(docs, "text").select("doc_id", "cleaned")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
    assert "INSET" in plan
    assert "Python" not in plan and "Exchange" not in plan


def test_distinct_is_case_sensitive(spark):
    a = spark.createDataFrame([("A",), ("a",), ("A",)], "headline string")
    b = spark.createDataFrame([("a",), ("b",)], "headline string")
    assert sorted(r[0] for r in stages.distinct_texts(a, b).collect()) == ["A", "a", "b"]
