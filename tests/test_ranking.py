import datetime
import random

import pytest
from pyspark.sql import functions as F

from vocalis.operators import ranking

DETAIL = "id string, title string, views string, comments string, duration string"


def test_eligible_videos(spark):
    rows = [
        ("a", "t", "5", "3", "PT61S"), ("b", "t", "5", "3", "PT60S"), ("c", "t", None, "3", "PT2M"),
        ("d", "t", "5", "12a", "PT2M"), ("e", "t", "5", "-3", "PT2M"), ("f", "t", "5", "0", "PT2M"),
        ("g", "t", "5", None, "PT2M"), ("h", "t", "5", "1", "bad"),
    ]
    kept = ranking.eligible_videos(spark.createDataFrame(rows, DETAIL)).orderBy("id").collect()
    assert [(r.id, r.view_count, r.comment_count, r.comments_enabled, r.duration) for r in kept] == [
        ("a", 5, 3, True, 61.0),
        ("c", 0, 3, True, 120.0),
    ]


def test_bad_view_text_fails(spark):
    with pytest.raises(Exception, match="not a whole number"):
        ranking.eligible_videos(spark.createDataFrame([("a", "t", "many", "3", "PT61S")], DETAIL)).collect()


def test_recent_and_matching(spark):
    anchor = datetime.datetime(2024, 2, 1, tzinfo=datetime.timezone.utc)
    rows = [("a", "iPhone 16 test", anchor - datetime.timedelta(days=30)), ("b", "IPHONE 16", anchor - datetime.timedelta(days=30, seconds=1)), ("c", "x", anchor)]
    df = spark.createDataFrame(rows, "id string, title string, published_at timestamp")
    assert {r.id for r in ranking.recent(df, "published_at", anchor).collect()} == {"a", "c"}
    assert {r.id for r in ranking.matching(df, "title", "iPhone 16").collect()} == {"a", "b"}


VIDEOS = [("b", 10, 1), ("a", 10, 2), ("c", 30, 3), ("c", 20, 4), ("d", 5, 5), ("e", 0, 6)]


def test_top_videos(spark):
    df = spark.createDataFrame(VIDEOS, "id string, view_count long, seen int")
    before = ranking.top_videos(df, 3, "before", ["seen"]).collect()
    assert sorted((r.id, r.view_count) for r in before) == [("a", 10), ("b", 10), ("c", 20)]
    after = ranking.top_videos(df, 3, "after", ["seen"]).collect()
    assert sorted((r.id, r.view_count) for r in after) == [("a", 10), ("c", 20)]
    copies = [("c", 20, 1), ("c", 30, 2), ("a", 5, 3)]  # the copy with fewest views is last in the ranked order
    after = ranking.top_videos(spark.createDataFrame(copies, "id string, view_count long, seen int"), 3, "after", ["seen"])
    assert sorted((r.id, r.view_count) for r in after.collect()) == [("a", 5), ("c", 20)]
    with pytest.raises(ValueError):
        ranking.top_videos(df, 3, "never")


def test_top_videos_is_a_top_k_plan(spark, sf_dir):
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("view_count"))
    plan = ranking.top_rows(orders, [F.desc("view_count"), F.asc("id")], 50)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_with_details_keeps_each_detail_row(spark):
    ids = spark.createDataFrame([("a",), ("a",), ("b",), ("z",)], "id string")
    details = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), ("c", 4)], "id string, n int")
    assert sorted(tuple(r) for r in ranking.with_details(ids, details).collect()) == [("a", 1), ("a", 2), ("b", 3)]


@pytest.mark.parametrize("n", [1, 5, 200])
def test_top_per_group_with_a_hot_group(spark, n):
    rng = random.Random(n)
    rows = [(("hot" if rng.random() < 0.5 else f"v{rng.randint(0, 40)}"), rng.randint(0, 30), i // 100, i % 100) for i in range(6000)]
    df = spark.createDataFrame(rows, "video_id string, likes int, page_no int, pos int").repartition(13)
    want = []
    for group in {r[0] for r in rows}:
        want += sorted((r for r in rows if r[0] == group), key=lambda r: (-r[1], r[2], r[3]))[:n]
    got = [tuple(r) for r in ranking.top_comments(df, n, splits=4).collect()]
    assert sorted(got) == sorted(want)
    if n == 200:
        assert sum(r[0] == "hot" for r in got) == 200


def test_top_per_group_plan_cuts_before_the_shuffle(spark, sf_dir):
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_partkey", "l_orderkey", "l_extendedprice")
    df = ranking.top_per_group(lines, ["l_partkey"], [F.desc("l_extendedprice"), F.asc("l_orderkey")], 5)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4  # partial and final, in both steps


def test_comments_of_top_videos(spark):
    videos = spark.createDataFrame([("a", "A", 3), ("b", "B", 2), ("none", "N", 1)], "id string, title string, view_count int")
    comments = spark.createDataFrame([("a", "x"), ("b", "y"), ("z", "w")], "video_id string, text string")
    joined = ranking.comments_of(videos, comments)
    large = spark.range(30_000_000).select(F.col("id").cast("string").alias("id"), F.col("id").cast("string").alias("title"))
    wide = spark.range(40_000_000).select(F.col("id").cast("string").alias("video_id"), F.lit("x").alias("text"))
    plan = ranking.comments_of(large, wide)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    flat = ranking.flat_comments(joined)
    assert sorted(tuple(r) for r in flat.collect()) == [("a", "A", "x"), ("b", "B", "y")]
    assert flat.columns == ["video_id", "video_title", "comment"]
