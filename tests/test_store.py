"""Batches of the store become visible whole, at once, or not at all."""

import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vocalis import schemas
from vocalis.sources import commits, sinks, tables


def rows(spark, texts, source="a"):
    shape = T.StructType([*schemas.LABELLED.fields, T.StructField("source", T.StringType())])
    return spark.createDataFrame([(t, t, [], [], "Neutral", source) for t in texts], shape)


def seen(spark, path, **options):
    return sorted((r.text, r.batch) for r in tables.read_store(spark, path, **options).collect())


def failing(df):
    """Fails after some tasks have written their rows."""
    return df.repartition(4, "text").withColumn("text", F.when(F.col("text") == "bad", F.raise_error(F.lit("lost"))).otherwise(F.col("text")))


@pytest.mark.parametrize("mode", ["append", "replace"])
def test_a_failed_writing_leaves_the_store_as_it_was(spark, tmp_path, mode):
    path = str(tmp_path / "s")
    assert seen(spark, path) == []
    sinks.write_store(rows(spark, ["x", "y"]), path, "w1")
    with pytest.raises(Exception, match="lost"):
        sinks.write_store(failing(rows(spark, ["p", "q", "r", "s", "t", "bad"])), path, "w1", mode)
    assert seen(spark, path) == [("x", "w1"), ("y", "w1")]
    sinks.write_store(rows(spark, ["z"]), path, "w1", mode)
    assert seen(spark, path) == ([("x", "w1"), ("y", "w1")] if mode == "append" else []) + [("z", "w1")]


def test_a_commit_that_is_lost_leaves_the_store_as_it_was(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    sinks.write_store(rows(spark, ["x"]), path, "w1")

    def lost(*args):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(commits, "commit", lost)
        for step in (lambda: sinks.write_store(rows(spark, ["y"]), path, "w1", "replace"), lambda: sinks.compact(spark, path, "w", "all")):
            with pytest.raises(RuntimeError, match="lost"):
                step()
    assert seen(spark, path) == [("x", "w1")]
    assert sinks.vacuum(spark, path) == 2 and seen(spark, path) == [("x", "w1")]


def test_readers_see_every_row_once_around_compact(spark, tmp_path):
    path = str(tmp_path / "s")
    for i in range(3):
        sinks.write_store(rows(spark, [f"t{i}"], source="ab"[i % 2]), path, f"live-{i}")
    sinks.write_store(rows(spark, ["other"]), path, "week 1")
    before = tables.read_store(spark, path)
    sinks.compact(spark, path, "live-", "all")
    expected = ["other", "t0", "t1", "t2"]
    assert sorted(r.text for r in before.collect()) == expected  # a reader of the list before
    assert seen(spark, path) == [("other", "week 1"), ("t0", "all"), ("t1", "all"), ("t2", "all")]
    assert [t for t, _ in seen(spark, path, version=3)] == expected
    sinks.vacuum(spark, path)
    assert [t for t, _ in seen(spark, path)] == expected
    sinks.compact(spark, path, "none-", "all")  # nothing to do
    assert len(seen(spark, path)) == 4


def test_compact_does_not_undo_a_replacement(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "s")
    sinks.write_store(rows(spark, ["x"]), path, "live-1")
    write = sinks._write_attempt

    def slow(df, *where):
        attempt = write(df, *where)
        monkeypatch.setattr(sinks, "_write_attempt", write)
        sinks.write_store(rows(spark, ["new"]), path, "live-1", "replace")
        return attempt

    monkeypatch.setattr(sinks, "_write_attempt", slow)
    with pytest.raises(RuntimeError, match="was changed"):
        sinks.compact(spark, path, "live-", "all")
    assert seen(spark, path) == [("new", "live-1")]


def test_writers_at_the_same_time_lose_no_batch(spark, tmp_path):
    path = str(tmp_path / "s")
    threads = [threading.Thread(target=sinks.write_store, args=(rows(spark, [f"t{i}"]), path, f"b{i}")) for i in range(6)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert seen(spark, path) == [(f"t{i}", f"b{i}") for i in range(6)]
    assert commits.versions(spark, path) == list(range(6))


def test_removed_and_empty_batches(spark, tmp_path):
    path = str(tmp_path / "s")
    sinks.write_store(rows(spark, []), path, "empty")
    assert seen(spark, path) == []
    sinks.write_store(rows(spark, ["x"]), path, "a b/c=d")
    sinks.write_store(rows(spark, ["y"]), path, "w2")
    assert seen(spark, path) == [("x", "a b/c=d"), ("y", "w2")]
    sinks.remove_batch(spark, path, "a b/c=d")
    assert seen(spark, path) == [("y", "w2")]


def test_other_attempts_are_not_read(spark, tmp_path):
    path = str(tmp_path / "s")
    for text in ("x", "y"):
        sinks.write_store(rows(spark, [text]), path, "w1", "replace")
    files = tables.read_store(spark, path).select("text").inputFiles()
    assert len(files) >= 1 and all(commits.read(spark, path)[0][1] in f for f in files)


def _files(path):
    import glob

    return glob.glob(f"{path}/attempt=*/source=*/batch=*/*.parquet")


def test_a_batch_is_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    """Each task writes what it has: texts do not travel, and no task gets all of a source."""
    path = str(tmp_path / "store")
    text, none = F.concat(F.lit("t"), "id"), F.array().cast("array<string>")
    rows = spark.range(60).repartition(3).select(
        text.alias("text"), text.alias("cleaned"), none.alias("phone_models"), none.alias("topics"), F.lit("Neutral").alias("sentiment"),
        F.when(F.col("id") % 2 == 0, "a").otherwise("b").alias("source"),
    )
    sinks.write_store(rows, path, "w1")
    assert len(_files(path)) == 6
    monkeypatch.setattr(sinks, "MOST_FILES", 2)
    sinks.write_store(rows.repartition(12), path, "w1", "replace")  # many small files are dealt anew
    assert len(_files(path)) < 6 + 12
    stored = tables.read_store(spark, path)
    assert sorted(r.text for r in stored.collect()) == sorted(f"t{i}" for i in range(60))
    assert stored.where("source = 'a'").count() == 30
