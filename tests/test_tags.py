import model
import pytest
from pyspark.sql import functions as F

from vocalis import lexicons
from vocalis.functions import tags
from vocalis.operators import stages

ROWS = [
    ("samsung camera better", ["samsung"], ["camera"]),
    ("ios update soon", [], ["OS"]),
    ("new ram cpu", [], []),
    ("multi tasking", [], []),
    ("white flag", [], ["performance"]),
    ("great performance", [], ["CPU", "RAM", "performance"]),
    ("size", [], ["dimensions", "screen size"]),
    ("iphone", [], []),
    ("screen size battery life", [], ["dimensions", "screen size", "battery"]),
    ("nokia huawei xiaomi", ["huawei", "xiaomi", "nokia"], []),
    (None, [], []),
]


def table(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, cleaned string")


def test_default_lists(spark):
    rows = stages.tag_rows(table(spark, [r[0] for r in ROWS])).orderBy("i").collect()
    assert [(r["phone_models"], r["topics"]) for r in rows] == [(m, t) for _, m, t in ROWS]


def test_dead_keywords():
    live = tags.live_keywords(lexicons.TOPICS)
    assert sum(len(v) for v in lexicons.TOPICS.values()) == 78
    assert sum(len([k for k in v if k == k.lower() and "-" not in k and not k[0].isdigit()]) for v in lexicons.TOPICS.values()) == 63
    assert sum(map(len, live.values())) == 60  # three more contain a shorter keyword of their topic
    assert live["resolution"] == ["resolution", "pixel", "retina"]


def test_pruning_changes_nothing_on_cleaned_text(spark, sf_dir):
    pages = stages.clean_rows(spark.read.parquet(f"{sf_dir}/pages.parquet"), "html")
    rows = stages.tag_rows(pages).select("cleaned", "topics").collect()
    assert any(r["topics"] for r in rows)
    assert [r["topics"] for r in rows] == [model.topics(r["cleaned"], lexicons.TOPICS) for r in rows]


def test_normalized_keywords(spark):
    rows = stages.tag_rows(table(spark, ["new ram cpu", "multi tasking", "4k", "ios"]), normalize_keywords=True)
    found = [r["topics"] for r in rows.orderBy("i").collect()]
    assert found == [["CPU", "RAM"], ["performance"], ["resolution"], ["OS"]]


def test_whole_words(spark):
    topics = {"a": ["lag", "battery life"], "b": ["size"]}
    df = table(spark, ["white flag", "lag", "battery lifetime", "long battery life", "size lag", None])
    found = df.select("i", tags.tag(F.col("cleaned"), topics, mode="token").alias("t")).orderBy("i").collect()
    assert [r["t"] for r in found] == [[], ["a"], [], ["a"], ["a", "b"], []]
    with pytest.raises(ValueError):
        tags.tag(F.col("cleaned"), topics, mode="fuzzy")


def test_many_keywords_give_the_same(spark, monkeypatch, sf_dir):
    pages = stages.clean_rows(spark.read.parquet(f"{sf_dir}/pages.parquet"), "html")
    few = pages.select("page_id", tags.tag(F.col("cleaned")).alias("t")).orderBy("page_id").collect()
    monkeypatch.setattr(tags, "EXPRESSION_LIMIT", 0)
    assert pages.select("page_id", tags.tag(F.col("cleaned")).alias("t")).orderBy("page_id").collect() == few


def test_no_usable_keyword(spark):
    assert table(spark, ["x"]).select(tags.tag(F.col("cleaned"), {"a": ["X"]}).alias("t")).first()["t"] == []
