"""Results that streams keep up to date: first rows per group, and counts with late rows, after any split."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from vocalis.operators import ranking
from vocalis.streaming import late, micro, tops


def order():
    return [F.desc("likes"), F.asc("i")]


def listed(df):
    return sorted(map(tuple, df.collect()), key=repr)


def in_parts(spark, df, folder, parts, start):
    for part in parts:
        df.where(F.col("i").isin(part)).write.mode("append").parquet(folder)
        start(spark.readStream.schema(df.schema).parquet(folder)).awaitTermination()


@pytest.mark.parametrize("seed", [1, 2])
def test_tops_after_any_split(spark, tmp_path, seed):
    rng = random.Random(seed)
    path, checkpoint = str(tmp_path / "tops"), str(tmp_path / "checkpoint")
    rows = [(rng.choice(["hot", "hot", "a", "b", None]), rng.choice([None, 0, 1, rng.randrange(50)]), i) for i in range(200)]
    df = spark.createDataFrame(rows, "video string, likes int, i int")
    split = [[] for _ in range(4)]
    for i in range(200):
        split[rng.randrange(4)].append(i)
    assert tops.tops(spark, path, df.schema, ["video"]).count() == 0
    in_parts(spark, df, str(tmp_path / "in"), split[:2], lambda s: tops.into_tops(s, path, checkpoint, ["video"], order(), 7))
    seen = df.where(F.col("i").isin(split[0] + split[1]))
    assert listed(tops.tops(spark, path, df.schema, ["video"])) == listed(ranking.top_per_group(seen, ["video"], order(), 7))
    tops.fold(spark, path, df.schema, ["video"])
    assert len(micro.folders(spark, path)) == 1
    in_parts(spark, df, str(tmp_path / "in"), split[2:], lambda s: tops.into_tops(s, path, checkpoint, ["video"], order(), 7))
    assert listed(tops.tops(spark, path, df.schema, ["video"])) == listed(ranking.top_per_group(df, ["video"], order(), 7))


def test_a_micro_batch_counts_once(spark, tmp_path):
    """Repeated after a failure before or after its commit, also when it was folded; another stream is refused."""
    path = str(tmp_path / "r")
    rows = spark.range(5).toDF("i")
    write = lambda df, number, folder: df.write.parquet(folder)

    def lost(df, number, folder):
        df.write.parquet(folder)
        raise RuntimeError("lost")

    total = lambda: spark.read.parquet(*micro.folders(spark, path)).count()
    assert micro.merge_batch(rows, 0, "s", path, write)
    with pytest.raises(RuntimeError):
        micro.merge_batch(rows, 1, "s", path, lost)
    assert total() == 5
    assert micro.merge_batch(rows, 1, "s", path, write) and not micro.merge_batch(rows, 1, "s", path, write)
    assert total() == 10
    both = spark.read.parquet(*micro.folders(spark, path))
    micro.fold(spark, path, lambda folder: both.write.parquet(folder))
    assert not micro.merge_batch(rows, 0, "s", path, write) and not micro.merge_batch(rows, 1, "s", path, write)
    assert total() == 10 and len(micro.folders(spark, path)) == 1
    with pytest.raises(ValueError, match="another stream"):
        micro.merge_batch(rows, 2, "t", path, write)


@pytest.mark.parametrize("zoned", [True, False])
def test_late_rows_correct_their_window(spark, tmp_path, zoned):
    rng = random.Random(9)
    path, checkpoint = str(tmp_path / "counts"), str(tmp_path / "checkpoint")
    start = datetime.datetime(2024, 3, 30)
    times = [None if i % 40 == 7 else start + datetime.timedelta(minutes=rng.randrange(6000)) for i in range(240)]
    rows = [(i, None if t is None else t.isoformat(" "), rng.choice("xy")) for i, t in enumerate(times)]
    df = spark.createDataFrame(rows, "i int, ts string, k string")
    df = df.withColumn("ts", F.col("ts").cast("timestamp" if zoned else "timestamp_ntz"))
    parts = [[], [], []]
    for i in range(240):
        parts[rng.randrange(3)].append(i)
    into = lambda s: late.into_counts(s, "ts", ["k"], "6 hours", "10 hours", path, checkpoint)
    in_parts(spark, df, str(tmp_path / "in"), parts, into)

    want, behind, greatest = {}, set(), None
    for part in parts:
        limit = None if greatest is None else greatest - datetime.timedelta(hours=10)
        for i in part:
            t = times[i]
            if t is None:
                behind.add(i)
                continue
            window = start + (t - start) // datetime.timedelta(hours=6) * datetime.timedelta(hours=6)
            is_late = limit is not None and window + datetime.timedelta(hours=6) <= limit
            on, off = want.get((window.isoformat(" "), rows[i][2]), (0, 0))
            want[window.isoformat(" "), rows[i][2]] = (on + (not is_late), off + is_late)
            behind |= {i} if is_late else set()
            greatest = t if greatest is None else max(greatest, t)
    found = late.counts(spark, path, ["k"]).withColumn("window_start", F.col("window_start").cast("string"))
    got = {(r.window_start, r.k): (r.on_time, r.late) for r in found.collect()}
    assert got == want and any(off for _, off in want.values())
    aside = late.late_rows(spark, path, df.schema, "ts")
    assert {r.i for r in aside.collect()} == behind
    assert sum(on for on, _ in got.values()) + aside.count() == 240  # kept and late are all that was read
    batch = df.where("ts is not null").groupBy(F.window("ts", "6 hours") if zoned else F.window(F.col("ts").cast("timestamp"), "6 hours"), "k").count()
    assert sorted(r["count"] for r in found.collect()) == sorted(r["count"] for r in batch.collect())
