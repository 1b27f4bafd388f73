import datetime
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from vocalis import lexicons, schemas
from vocalis.functions import text
from vocalis.operators import stages
from vocalis.plans import opinions
from vocalis.session import clear_workspaces, workspace
from vocalis.sources import landed, sinks, tables
from vocalis.streaming import live

ANCHOR = datetime.datetime(2024, 10, 1, tzinfo=datetime.timezone.utc)


def detail(video, views="100", comments="5", duration="PT5M", title="iPhone 16 review", day="2024-09-20"):
    statistics = {k: v for k, v in (("viewCount", views), ("commentCount", comments)) if v is not None}
    return {
        "id": video,
        "snippet": {"title": title, "publishedAt": f"{day}T00:00:00Z"},
        "statistics": statistics,
        "contentDetails": {"duration": duration},
    }


def thread(text, likes=None):
    inner = {"textDisplay": text, "authorDisplayName": "someone"}
    if likes is not None:
        inner["likeCount"] = likes
    return {"snippet": {"topLevelComment": {"snippet": inner}}}


@pytest.fixture
def landing(tmp_path):
    pages = {
        "search": [
            {"page_no": 0, "nextPageToken": "n", "items": [{"id": {"videoId": v}} for v in ("v1", "v2", "short", "old")]},
            {"page_no": 1, "items": [{"id": {"videoId": v}} for v in ("v1", "gone", "off")]},
            {"page_no": 2},
        ],
        "details": [
            {"page_no": 0, "items": [detail("v1"), detail("v2", views=None, title="iPhone16 Pro review"), detail("short", duration="PT60S")]},
            {"page_no": 1, "items": [detail("v1", views="120"), detail("old", day="2024-08-01"), detail("off", comments=None)]},
            {"page_no": 2, "items": [detail("unasked", views="9999")]},
        ],
        "comments": [
            {"video_id": "v1", "page_no": 0, "items": [thread("The camera is amazing!", 3), thread("ok", "9"), thread("terrible battery 😀")]},
            {"video_id": "v1", "page_no": 1, "items": [thread("samsung price is better", 3)]},
            {"video_id": "v2", "page_no": 0, "items": [thread("never good")]},
            {"video_id": "unasked", "page_no": 0, "items": [thread("bad")]},
        ],
        "listings": [
            {"subreddit": "apple", "title": "iPhone screen is great"},
            {"subreddit": "technology", "title": "iPhone screen is great"},
            {"subreddit": "iphone", "title": "Android news"},
            {"subreddit": "cooking", "title": "iPhone cake"},
            {"subreddit": "iphone", "title": None},
        ],
    }
    for name, documents in pages.items():
        folder = tmp_path / "landing" / name
        folder.mkdir(parents=True)
        (folder / "pages.json").write_text("\n".join(json.dumps(d) for d in documents))
    return str(tmp_path / "landing")


EXPECTED = {
    ("headlines", "iPhone screen is great", "iphone screen great", "", "screen size", "Positive"),
    ("comments", "The camera is amazing!", "camera amazing", "", "camera", "Positive"),
    ("comments", "terrible battery 😀", "terrible battery", "", "battery", "Negative"),
    ("comments", "samsung price is better", "samsung price better", "samsung", "price", "Positive"),
    ("comments", "never good", "never good", "", "", "Negative"),
}


def stored(spark, store, source=None):
    rows = tables.read_store(spark, store, source)
    return rows.select(
        "source", "text", "cleaned", F.array_join("phone_models", "|"), F.array_join("topics", "|"), "sentiment"
    ).collect()


def test_run_and_reports(spark, landing, tmp_path):
    store, valences = str(tmp_path / "store"), lexicons.valence_table(spark)
    opinions.run(spark, landing, store, "w1", ANCHOR, valences)
    rows = [tuple(r) for r in stored(spark, store)]
    assert sorted(rows) == sorted(EXPECTED)
    opinions.run(spark, landing, store, "w1", ANCHOR, valences)
    assert len(stored(spark, store)) == 2 * len(EXPECTED)
    opinions.run(spark, landing, store, "w1", ANCHOR, valences, mode="replace")
    opinions.run(spark, landing, store, "w2", ANCHOR, valences, mode="replace")
    assert len(stored(spark, store)) == 2 * len(EXPECTED)
    distribution, matrix = opinions.reports(spark, store, "comments")
    assert {(r.sentiment, r["count"]) for r in distribution.collect()} == {("Positive", 4), ("Negative", 4)}
    assert [tuple(r) for r in matrix.collect()] == [
        ("comments", "battery", 2, 0, 0), ("comments", "camera", 0, 0, 2), ("comments", "price", 0, 0, 2),
    ]
    opinions.write_reports(spark, store, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out/matrix/parquet")).count() == 4
    csv = spark.read.csv(str(tmp_path / "out/distribution/csv"), header=True)
    assert {r["percent"] for r in csv.where("source = 'headlines'").collect()} == {"100.0%"}


def test_stage_exports(spark, landing, tmp_path):
    headlines, comments = opinions.read_batch(spark, landing, ANCHOR)
    out = str(tmp_path / "stages")
    opinions.export_stages(headlines, comments, lexicons.valence_table(spark), out)
    raw = tables.read_csv(spark, f"{out}/comments/raw", schemas.RAW_COMMENTS)
    assert raw.count() == comments.count() == 5
    clean = tables.read_csv(spark, f"{out}/comments/clean", schemas.CLEAN)
    assert {r.cleaned for r in clean.collect()} == {e[2] for e in EXPECTED if e[0] == "comments"}
    for name in ("headlines", "comments"):
        labelled = tables.read_jsonl(spark, f"{out}/{name}/labelled", schemas.LABELLED).collect()
        assert {(r.text, r.sentiment) for r in labelled} == {(e[1], e[5]) for e in EXPECTED if e[0] == name}
        assert tables.read_jsonl(spark, f"{out}/{name}/tagged", schemas.TAGGED).count() == len(labelled)


def test_store_reads_one_partition(spark, landing, tmp_path):
    store = str(tmp_path / "store")
    opinions.run(spark, landing, store, "w1", ANCHOR, lexicons.valence_table(spark))
    plan = tables.read_store(spark, store, "headlines").select("sentiment")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(source" in plan and "ReadSchema: struct<sentiment:string>" in plan


def test_bad_view_count_fails_the_run(spark, landing, tmp_path):
    with open(f"{landing}/details/more.json", "w") as page:
        page.write(json.dumps({"page_no": 9, "items": [detail("v2", views="lots")]}))
    with pytest.raises(Exception, match="not a whole number"):
        opinions.run(spark, landing, str(tmp_path / "store"), "w1", ANCHOR, lexicons.valence_table(spark))


def test_comment_order_and_limits(spark, landing):
    settings = opinions.Settings(n_comments=2)
    search = landed.video_ids(landed.read_pages(spark, f"{landing}/search", schemas.SEARCH_PAGE))
    assert search.count() == 7
    details = landed.video_details(landed.read_pages(spark, f"{landing}/details", schemas.DETAIL_PAGE))
    comments = landed.video_comments(landed.read_pages(spark, f"{landing}/comments", schemas.COMMENT_PAGE))
    raw = opinions.best_comments(search, details, comments, ANCHOR, settings).where("video_id = 'v1'")
    assert sorted(r.comment for r in raw.collect()) == ["The camera is amazing!", "ok"]


def test_store_modes(spark, tmp_path):
    with pytest.raises(ValueError):
        sinks.write_store(spark.createDataFrame([], schemas.STORE).drop("batch"), str(tmp_path / "s"), "b", "upsert")


def test_csv_and_missing_tokens(spark, tmp_path):
    path = str(tmp_path / "csv")
    rows = [("a", "t", 'quote " and, comma'), ("b", "t", "two\nlines"), ("c", "t", "nan"), ("d", "t", "null"), ("e", "t", None)]
    sinks.write_csv(spark.createDataFrame(rows, schemas.RAW_COMMENTS), path)
    read = {r.video_id: r.comment for r in tables.read_csv(spark, path, schemas.RAW_COMMENTS).collect()}
    assert read == {"a": 'quote " and, comma', "b": "two\nlines", "c": None, "d": None, "e": None}
    kept = {r.video_id: r.comment for r in tables.read_csv(spark, path, schemas.RAW_COMMENTS, missing_tokens=False).collect()}
    assert kept["c"] == "nan" and kept["d"] == "null"


def test_jsonl_keeps_arrays_and_nulls(spark, tmp_path):
    rows = [("t", "c", ["m"], [], "Neutral"), ("", "nan", [], ["a", "b"], None)]
    df = spark.createDataFrame(rows, schemas.LABELLED)
    sinks.write_jsonl(df, str(tmp_path / "j"))
    back = tables.read_jsonl(spark, str(tmp_path / "j"), schemas.LABELLED)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_stream_gives_the_batch_result(spark, tmp_path):
    source, store = str(tmp_path / "in"), str(tmp_path / "store")
    texts = spark.createDataFrame([("camera amazing",), ("the",), (None,), ("never good",)], "text string")
    texts.repartition(2).write.parquet(source)
    stream = spark.readStream.schema("text string").option("maxFilesPerTrigger", 1).parquet(source)
    valences = lexicons.valence_table(spark)
    rows = live.label_stream(stream, "text", valences).withColumn("source", F.lit("live"))
    live.into_store(rows, store, str(tmp_path / "check"), "one").awaitTermination()
    batch = opinions.label_texts(texts, "text", valences).select("text", "cleaned", "sentiment").collect()
    assert sorted(tables.read_store(spark, store).select("text", "cleaned", "sentiment").collect()) == sorted(batch)
    live.into_store(rows, store, str(tmp_path / "check2"), "one").awaitTermination()  # the same batches again
    assert tables.read_store(spark, store).count() == len(batch)
    live.into_store(rows, store, str(tmp_path / "check3"), "two").awaitTermination()  # another stream, the same numbers
    assert tables.read_store(spark, store).count() == 2 * len(batch)
    sinks.compact(spark, store, "one-", "all")
    assert {r.batch for r in tables.read_store(spark, store).select("batch").distinct().collect()} > {"all"}
    assert tables.read_store(spark, store).count() == 2 * len(batch)
    assert not tables.read_store(spark, store).where("batch like 'one-%'").count()


def big_lexicon(spark, n=25_000):
    """The starter list and many words that no text has."""
    others = spark.range(n).select(F.concat(F.lit("zz"), F.col("id")).alias("token"), F.lit(1.0).alias("valence"))
    starter = lexicons.valence_table(spark)
    return starter.select("token", F.col("valence").cast("double").alias("valence")).unionByName(others)


def test_a_large_lexicon_needs_nothing_from_the_caller(spark, landing, tmp_path):
    store, valences = str(tmp_path / "store"), big_lexicon(spark)
    opinions.run(spark, landing, store, "w1", ANCHOR, valences)
    assert sorted(tuple(r) for r in stored(spark, store)) == sorted(EXPECTED)
    source = str(tmp_path / "in")
    texts = spark.createDataFrame([("camera amazing", "live"), (None, "live"), ("never good", "live")], "text string, source string")
    texts.write.parquet(source)
    stream = spark.readStream.schema(texts.schema).parquet(source)
    with pytest.raises(ValueError, match="label_into_store"):
        live.label_stream(stream, "text", valences)
    live.label_into_store(stream, "text", valences, store, str(tmp_path / "check"), "live").awaitTermination()
    assert {(r.text, r.sentiment) for r in tables.read_store(spark, store, "live").collect()} == {
        ("camera amazing", "Positive"), ("never good", "Negative"),
    }


@pytest.mark.parametrize("page", ['{"page_no": 3,\n "items": []}', '{"page_no": 3, "items": [', "[1"])
def test_unreadable_pages_fail_the_run(spark, landing, tmp_path, page):
    with open(f"{landing}/search/more.json", "w") as file:
        file.write(page)
    with pytest.raises(Exception, match="(?i)malformed"):
        opinions.run(spark, landing, str(tmp_path / "store"), "w1", ANCHOR, lexicons.valence_table(spark))


def test_whole_files_may_be_laid_out(spark, tmp_path):
    (tmp_path / "page.json").write_text(json.dumps({"page_no": 1, "items": [{"id": {"videoId": "v"}}]}, indent=2))
    pages = landed.read_pages(spark, str(tmp_path), schemas.SEARCH_PAGE, whole_files=True)
    assert [tuple(r) for r in landed.video_ids(pages).collect()] == [("v", 1, 0)]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_likes_and_page_numbers_are_strict(spark, tmp_path, ansi):
    def read(page):
        (tmp_path / "page.json").write_text(json.dumps(page))
        return landed.video_comments(landed.read_pages(spark, str(tmp_path), schemas.COMMENT_PAGE)).collect()

    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        rows = read({"video_id": "v", "page_no": 0, "items": [thread("a", "40"), thread("b", 7), thread("c")]})
        assert [r.likes for r in rows] == [40, 7, 0]
        with pytest.raises(Exception, match="not a whole number"):
            read({"video_id": "v", "page_no": 0, "items": [thread("a", "lots")]})
        with pytest.raises(Exception, match="page_no is missing"):
            read({"video_id": "v", "items": [thread("a", 1)]})
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_replacing_removes_other_sources_of_the_batch(spark, tmp_path):
    store = str(tmp_path / "store")
    rows = spark.createDataFrame([("t", "c", [], [], "Neutral", s) for s in ("a", "b")], StructType([*schemas.LABELLED.fields, StructField("source", StringType())]))
    for batch in ("w 1", "w2"):
        sinks.write_store(rows, store, batch, "replace")
    sinks.write_store(rows.where("source = 'a'"), store, "w 1", "replace")
    assert sorted((r.source, r.batch) for r in tables.read_store(spark, store).collect()) == [("a", "w 1"), ("a", "w2"), ("b", "w2")]


def test_windows_drop_late_rows(spark, tmp_path):
    source = tmp_path / "in"
    days = (["2024-01-01 10:05", "2024-01-01 12:30"], ["2024-01-01 12:40"], ["2024-01-01 10:10", "2024-01-01 18:00"])
    for stamps in days:
        rows = [(datetime.datetime.fromisoformat(s), "a") for s in stamps]
        spark.createDataFrame(rows, "ts timestamp, k string").coalesce(1).write.mode("append").parquet(str(source))
    files = spark.readStream.schema("ts timestamp, k string").option("maxFilesPerTrigger", 1).parquet(str(source))
    counts = live.windowed_counts(files, "ts", ["k"], "1 hour", "30 minutes")
    live.run_available(counts, str(tmp_path / "out"), str(tmp_path / "check"))
    got = sorted((r.window_start.hour, r["count"]) for r in live.latest_counts(spark, str(tmp_path / "out")).collect())
    assert got == [(10, 1), (12, 2), (18, 1)]  # 10:10 came after the watermark had passed


def test_workspace_follows_the_setting(spark, monkeypatch):
    first, second = workspace(spark), workspace(spark)
    assert first != second
    monkeypatch.setattr("vocalis.session._made", [])  # the folders named below are on no file system of this test

    class Cluster:
        class conf:
            settings = {"spark.master": "spark://host:7077"}

            @classmethod
            def get(cls, key, default=None):
                return cls.settings.get(key, default)

    with pytest.raises(ValueError):
        workspace(Cluster)
    Cluster.conf.settings["spark.checkpoint.dir"] = "hdfs:///shared/"
    assert workspace(Cluster).startswith("hdfs:///shared/vocalis-")


def test_only_own_workspaces_are_removed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr("vocalis.session._made", [])
    own, other = workspace(spark), str(tmp_path / "other")
    for path in (own, other):
        spark.range(3).write.parquet(path)
    clear_workspaces(spark)
    assert spark.read.parquet(other).count() == 3
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        spark.read.parquet(own)


def test_null_text_has_no_words(spark):
    df = spark.createDataFrame([(None,)], "t string")
    assert df.select(text.words(F.col("t")).alias("w")).first()["w"] is None
    assert stages.computed_once(df, n=F.lit(1), m=F.lit(2)).count() == 1


def test_compressed_exports_read_the_same(spark, tmp_path):
    headlines = spark.createDataFrame([("The iPhone, battery",), ('a "quoted"\nSamsung',)], "headline string")
    comments = spark.createDataFrame([("1", "t", "camera, good")], schemas.RAW_COMMENTS)
    found = []
    for kind in ("none", "gzip"):
        out = str(tmp_path / kind)
        opinions.export_stages(headlines, comments, lexicons.valence_table(spark), out, compression=kind)
        raw = tables.read_csv(spark, f"{out}/headlines/raw", headlines.schema).collect()
        tagged = [tables.read_jsonl(spark, f"{out}/{n}/tagged", schemas.TAGGED).collect() for n in ("headlines", "comments")]
        found.append(sorted(map(repr, [*raw, *tagged[0], *tagged[1]])))
    assert found[0] == found[1] and len(found[0]) >= 3
    assert list((tmp_path / "gzip/headlines/raw").glob("*.csv.gz"))
