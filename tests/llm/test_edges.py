"""Every operator on nulls, empty and very long texts, ties, repeated rows, clashing columns, and on an empty table."""

import public_tokenizers
import pytest
from llm.brute import crc
from llm.conftest import CLASHING, LONG, PLAIN, ROWS, schema

from vocalis.llm import decontaminate, licenses, mixing, near_dups, pii, quality, sharding, token_counts, token_files, toxicity
from vocalis.session import workspace

SP, BPE = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def items(spark):
    rows = [(1, " ".join(PLAIN.split()[:13])), (None, "word"), (3, None), (4, ""), (1, " ".join(PLAIN.split()[:13]))]
    return spark.createDataFrame(rows, "item_id long, text string")


def operators(spark, items):
    network = toxicity.Network()
    return {
        "licenses": lambda d: licenses.summary(licenses.detections(d)),
        "decontamination": lambda d: decontaminate.report(d, items),
        "token counts": lambda d: token_counts.counts(d, SP),
        "near duplicates": near_dups.groups,
        "toxicity": lambda d: toxicity.scores(d, network),
        "personal data": lambda d: pii.summary(pii.detect(d)),
        "quality": quality.verdicts,
        "mix": lambda d: mixing.plan(d).select("row.doc_id", "size", "taken"),
        "shards": lambda d: sharding.shards(d, workspace(spark)).withColumnRenamed("key", "doc_id"),
        "token files": lambda d: token_files.tokens(d, BPE),
    }


NAMES = list(operators(None, None))


@pytest.mark.parametrize("name", NAMES)
def test_one_row_per_row(spark, odd, items, name):
    found = operators(spark, items)[name](odd).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in ROWS)
    by_key = {}
    for r in found:
        by_key.setdefault(r.doc_id, []).append(r.asDict())
    drop = {"slot", "start", "frame", "shard", "file", "taken"}
    one, two = ({k: v for k, v in r.items() if k not in drop} for r in by_key[2])
    assert one == two  # repeated rows are treated alike


@pytest.mark.parametrize("name", NAMES)
def test_empty_table(spark, empty, items, name):
    assert operators(spark, items)[name](empty).collect() == []


def test_defined_results(spark, odd, items):
    run = operators(spark, items)
    rows = lambda name: {r.doc_id: r for r in run[name](odd).collect()}
    found = rows("licenses")
    assert (found[3].n_words, found[3].labels, found[3].score, found[3].first_word) == (0, "", 0.0, None)
    assert found[7].base_labels == "apache,cc-by"
    found = rows("decontamination")
    assert found[1].contaminated and found[1].n_hit == 13 and found[1].n_items == 1
    assert found[8].contaminated and found[8].n_items == 0  # an item without id hits, but is not listed
    assert not found[3].contaminated and found[3].n_words == 0
    found = rows("token counts")
    assert (found[3].n_bytes, found[3].n_tokens) == (0, 0) and found[6].over_limit
    found = rows("near duplicates")
    assert [found[k].component_id for k in (1, 2, 3, 4, 5)] == [1, 1, 3, 4, 5]
    assert found[None].kept
    found = rows("quality")
    assert not found[3].kept and not found[4].kept and found[3].n_words == 0
    found = rows("personal data")
    assert found[3].spans == "" and found[None].n_email in (0, 1)


def test_items_or_labels_may_be_missing(spark, odd, items):
    none = items.where("false")
    assert not any(r.contaminated for r in decontaminate.report(odd, none).collect())
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    assert toxicity.training_rows(odd, labels) == ([], [])
    assert toxicity.scores(odd, toxicity.train([], [])).count() == len(ROWS)


def test_filters_keep_all_columns(odd, items):
    for kept in (quality.keep(odd), near_dups.one_of_each(odd), decontaminate.clean(odd, items), mixing.mix(odd)):
        assert kept.columns == schema(CLASHING).names
        assert all(r["a.b"] == "a.b" for r in kept.collect())


def test_long_runs_without_a_match_stay_linear(spark):
    texts = ["a" * 200_000 + "@", "1" * 200_000, "+1" + "(" * 200_000, "999." * 50_000, "1 2-" * 50_000, LONG * 3]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert all(r.spans == "" for r in pii.summary(pii.detect(docs)).collect())


def test_shards_of_odd_rows(spark, odd):
    rows = sharding.shards(odd, workspace(spark)).collect()
    assert sorted(r.text_crc32 for r in rows) == sorted(crc(r[1]) for r in ROWS)


def test_filters_go_by_row_not_by_key(spark):
    text, other = " ".join(PLAIN.split()[:13]), "quite another text with words of its own that nobody else has at all"
    rows = [(1, text, "a"), (1, text, "b"), (None, text, "c"), (None, text, "d"), (5, text, "e"), (5, other, "f"), (6, None, "g"), (6, "", "h")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = near_dups.one_of_each(docs).collect()
    assert sorted(((r.doc_id, r.text) for r in kept), key=str) == sorted([(1, text), (5, other), (6, None), (6, "")], key=str)
    items = spark.createDataFrame([(1, text)], "item_id long, text string")
    assert sorted(r.source for r in decontaminate.clean(docs, items).collect()) == ["f", "g", "h"]
    nobody = docs.where("doc_id is null")
    assert [r.text for r in near_dups.one_of_each(nobody).collect()] == [text]
    assert near_dups.one_of_each(docs.where("false")).collect() == [] == decontaminate.clean(docs.where("false"), items).collect()


def test_native_digest_is_that_of_the_words(spark):
    shingles = near_dups.Shingles()
    texts = [None, "", " \n", "A b\tC", "\x0bÉ  ß\u00a0x\x0c ", "ÀB c\x1cd", "İ K"]
    df = spark.createDataFrame(list(enumerate(texts)), "i long, t string")
    got = {r.i: r.d for r in df.select("i", near_dups.native_digest(df.t).alias("d")).collect()}
    assert [got[i] and bytes(got[i]) for i in range(len(texts))] == [near_dups.digest(shingles.words((t or "").encode())) for t in texts]
