"""Chains of landed pages, and reject tables."""

import json
import random

import pytest

from vocalis import lexicons, schemas
from vocalis.plans import opinions
from vocalis.sources import chains, landed, rejects, tables

from test_chain import ANCHOR, EXPECTED, landing, stored, thread  # noqa: F401

PAGE = "video_id string, page_no int, nextPageToken string, items array<string>"


def pages(spark, rows):
    return spark.createDataFrame([(v, n, t, [f"{v}{n}"]) for v, n, t in rows], PAGE).repartition(3)


def faults(spark, rows, **how):
    return sorted(((r.video_id, r.page_no, r.fault) for r in chains.faults(pages(spark, rows), ["video_id"], **how).collect()), key=repr)


def test_faults_of_every_kind(spark):
    rows = [("a", 0, "t"), ("a", 1, "t"), ("a", 2, None)]  # whole
    rows += [("b", 0, "t"), ("b", 2, ""), ("c", 0, "t"), ("d", 1, None), ("e", 0, None), ("e", 1, None), ("f", 0, None), ("f", 0, None), (None, 0, "t")]
    assert faults(spark, rows) == sorted([
        ("b", 0, chains.MISSING_NEXT), ("b", 2, chains.MISSING_BEFORE), ("c", 0, chains.MISSING_NEXT), ("d", 1, chains.MISSING_BEFORE),
        ("e", 0, chains.AFTER_END), ("f", 0, chains.REPEATED), (None, 0, chains.MISSING_NEXT),
    ], key=repr)
    assert faults(spark, rows[:3], first=-1) == [("a", 0, chains.MISSING_BEFORE)]
    assert faults(spark, []) == []


def test_faults_equal_a_plain_walk(spark):
    rng, rows, expected = random.Random(3), [], []
    for v in range(60):
        n = rng.randint(1, 6)
        kept = [i for i in range(n) if rng.random() < 0.8]
        rows += [(str(v), i, "t" if i < n - 1 else None) for i in kept for _ in range(1 + (rng.random() < 0.2))]
        here = [r[1] for r in rows if r[0] == str(v)]
        expected += [(str(v), i, chains.MISSING_NEXT) for i in kept if i < n - 1 and i + 1 not in kept]
        expected += [(str(v), i, chains.MISSING_BEFORE) for i in kept if i > 0 and i - 1 not in kept]
        expected += [(str(v), i, chains.REPEATED) for i in kept if here.count(i) > 1]
    assert faults(spark, rows, first=0) == sorted(expected, key=repr)


def test_a_page_that_landed_again_counts_once(spark):
    rows = [("a", 0, "t"), ("a", 0, "t"), ("a", 1, None), (None, 0, None), (None, 0, None)]
    found = chains.once(pages(spark, rows), ["video_id"])
    assert found.columns == ["video_id", "page_no", "nextPageToken", "items"]
    assert sorted(((r.video_id, r.page_no, r["items"]) for r in found.collect()), key=repr) == [("a", 0, ["a0"]), ("a", 1, ["a1"]), (None, 0, ["None0"])]
    longer = spark.createDataFrame([("a", 0, "t", ["x"]), ("a", 0, "t", ["x", "y"]), ("a", 0, "t", None)], PAGE)
    assert [r["items"] for r in chains.once(longer, ["video_id"]).collect()] == [["x", "y"]]


def test_complete_pages_or_an_error(spark):
    good = [("a", 0, "t"), ("a", 1, None), ("a", 1, None)]
    assert chains.complete(pages(spark, good), ["video_id"]).count() == 2
    with pytest.raises(ValueError, match="video_id b, page_no 0, fault next page missing"):
        chains.complete(pages(spark, [*good, ("b", 0, "t")]), ["video_id"])


def land_more(landing, name, *documents):  # noqa: F811
    with open(f"{landing}/{name}/more.json", "w") as file:
        file.write("\n".join(d if isinstance(d, str) else json.dumps(d) for d in documents))


def test_the_chain_counts_pages_once(spark, landing, tmp_path):  # noqa: F811
    land_more(landing, "comments", {"video_id": "v1", "page_no": 0, "items": [thread("The camera is amazing!", 3), thread("ok", "9"), thread("terrible battery 😀")]})
    opinions.run(spark, landing, str(tmp_path / "s"), "w1", ANCHOR, lexicons.valence_table(spark))
    assert sorted(tuple(r) for r in stored(spark, str(tmp_path / "s"))) == sorted(EXPECTED)
    with pytest.raises(ValueError, match="pages after the end"):
        opinions.run(spark, landing, str(tmp_path / "t"), "w1", ANCHOR, lexicons.valence_table(spark), opinions.Settings(pages="complete"))
    with pytest.raises(ValueError, match="unknown pages"):
        opinions.run(spark, landing, str(tmp_path / "t"), "w1", ANCHOR, lexicons.valence_table(spark), opinions.Settings(pages="some"))


def test_without_bad_items_rejects_change_nothing(spark, landing, tmp_path):  # noqa: F811
    counts = opinions.run(spark, landing, str(tmp_path / "s"), "w1", ANCHOR, lexicons.valence_table(spark), reject_folder=str(tmp_path / "r"))
    assert sorted(tuple(r) for r in stored(spark, str(tmp_path / "s"))) == sorted(EXPECTED)
    assert counts["comments"] == {"read": 6, "kept": 6, "rejected": 0} and all(c["rejected"] == 0 for c in counts.values())


def test_bad_items_are_rejected_and_the_rest_goes_on(spark, landing, tmp_path):  # noqa: F811
    land_more(landing, "comments", {"video_id": "v1", "page_no": 2, "items": [thread("camera good", "lots"), thread("price good", "99999999999999999999")]}, "[1", '{"video_id": "v1", "items": [')
    land_more(landing, "search", {"items": [{"id": {"videoId": "v9"}}]}, {"items": []}, "no page")
    bad_detail = {"id": "v8", "snippet": {"title": "t", "publishedAt": "someday"}, "statistics": {"viewCount": "many"}}
    land_more(landing, "details", {"page_no": 9, "items": [bad_detail]})
    land_more(landing, "listings", "{")
    store, folder = str(tmp_path / "s"), str(tmp_path / "r")
    for _ in range(2):  # a run that is repeated replaces its batch and its rejects
        counts = opinions.run(spark, landing, store, "w1", ANCHOR, lexicons.valence_table(spark), mode="replace", reject_folder=folder)
    assert sorted(tuple(r) for r in stored(spark, store)) == sorted(EXPECTED)
    found = spark.read.parquet(folder).collect()
    reasons = sorted((r.folder, *r.reasons) for r in found)
    assert reasons == [
        ("comments", "likes are no whole number"), ("comments", "likes are no whole number"), ("comments", "unreadable page"), ("comments", "unreadable page"),
        ("details", "no time", "views are no whole number"), ("listings", "unreadable page"),
        ("search", "page without a number"), ("search", "page without a number"), ("search", "unreadable page"),
    ]
    assert all(r.batch == "w1" and r.origin.endswith("more.json") for r in found)
    assert {r.raw for r in found} >= {"[1", "no page", "{"} and any('"lots"' in (r.raw or "") for r in found)
    for name, count in counts.items():
        assert count["kept"] + count["rejected"] == count["read"] and count["rejected"] == sum(r.folder == name for r in found)
    with pytest.raises(Exception, match="(?i)malformed"):  # without a folder for rejects the run is strict
        opinions.run(spark, landing, store, "w2", ANCHOR, lexicons.valence_table(spark))
    assert {r.batch for r in tables.read_store(spark, store).collect()} == {"w1"}


def test_kept_items_are_those_of_the_strict_reader(spark, landing):  # noqa: F811
    strict = landed.video_comments(landed.read_pages(spark, f"{landing}/comments", schemas.COMMENT_PAGE))
    assert sorted(rejects.video_comments(spark, f"{landing}/comments").kept.collect()) == sorted(strict.collect())
    strict = landed.video_details(landed.read_pages(spark, f"{landing}/details", schemas.DETAIL_PAGE))
    kept = rejects.video_details(spark, f"{landing}/details").kept
    assert kept.columns == strict.columns and sorted(map(repr, kept.collect())) == sorted(map(repr, strict.collect()))
