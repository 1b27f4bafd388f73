"""Near matches of benchmark phrases against a plain search of every window."""

import random
from hashlib import sha256

import pytest
from llm import brute
from llm.conftest import PLAIN, ROWS

from vocalis.llm import catalog, decontaminate


def near_windows(text, items, length, slack, reach):
    """(item, start, length) -> fewest words missing."""
    w, found = brute.words(text), {}
    for item, item_text in items:
        v = brute.words(item_text)
        n = min(length, len(v))
        for k in range(len(v) - n + 1) if n else ():
            phrase, size = set(v[k : k + n]), n + reach
            for start in range(max(len(w) - size, 0) + 1):
                missing = len(phrase - set(w[start : start + size]))
                if missing <= min(slack, len(phrase) - 1):
                    at = (item, start, size)
                    found[at] = min(missing, found.get(at, missing))
    return found


def test_a_near_match_may_lack_the_rarest_word(spark):
    docs = spark.createDataFrame([(1, "red blue green"), (2, "red blue other green"), (3, "blue green red blue")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "red blue rare green"), (2, "red blue nowhere green")], "item_id long, text string")
    docs = docs.unionByName(spark.createDataFrame([(4, "rare")], docs.schema))
    found = decontaminate.near_report(docs, items, slack=1).collect()
    assert {(r.doc_id, r.n_near, r.n_missing) for r in found} == {(1, 2, 1), (2, 2, 1), (3, 2, 1), (4, 0, None)}


@pytest.mark.parametrize("slack, reach", [(0, 0), (0, 3), (1, 0), (1, 3), (2, 1), (3, 2)])
def test_near_matches_equal_a_plain_search(spark, slack, reach):
    rng = random.Random(10 * slack + reach)
    word = lambda: f"w{min(rng.randrange(40), rng.randrange(40))}"
    texts = [[word() for _ in range(rng.choice([0, 3, 8, 30, 60]))] for _ in range(40)]
    items = []
    for i in range(12):
        phrase = [word() for _ in range(rng.choice([1, 2, 4, 6, 9]))]
        host = rng.choice(texts)
        at = rng.randrange(len(host) + 1)
        edited = list(phrase)
        edited[rng.randrange(len(edited))] = rng.choice(["edited", word()])
        host[at:at] = rng.choice([phrase, edited, edited[::-1]])
        items.append((i, " ".join([*phrase, *(["nowhere"] if i % 3 == 0 else [])])))
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)] + [(None, None)]
    docs, table = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id string, text string")
    items = [(str(i), t) for i, t in items]
    led = decontaminate.phrases(docs, decontaminate.windows(table, 6), slack=slack)
    matches = decontaminate.proximity_matches(decontaminate.index(docs, led, reach=reach), led, slack, reach)
    got = sorted((r.key, r.item, r.start, r.length, r.missing) for r in matches.collect())
    expected = {k: near_windows(t, items, 6, slack, reach) for k, t in rows}
    assert got == sorted((k, *at, m) for k, found in expected.items() for at, m in found.items())
    assert got
    for r in decontaminate.near_report(docs, table, 6, slack, reach).collect():
        found = expected[r.doc_id]
        ids = sorted({item for item, _, _ in found})
        assert (r.n_near_windows, r.n_near, r.n_missing) == (len({at[1:] for at in found}), len(ids), min(found.values(), default=None))
        assert r.near_sha256 == sha256(",".join(ids).encode()).hexdigest()


def test_query_gives_near_matches(spark, sf_dir):
    exact = {r.doc_id: r for r in catalog.op2_benchmark_decontamination(spark, sf_dir).collect()}
    near = {r.doc_id: r for r in catalog.QUERIES["op2_benchmark_proximity"](spark, sf_dir).collect()}
    assert near.keys() == exact.keys()
    assert all(getattr(near[k], c) == getattr(r, c) for k, r in exact.items() for c in r.asDict())  # the same columns from the other index
    assert all(near[k].n_near >= r.n_items for k, r in exact.items())  # exact matches are near ones
    assert all(near[k].n_missing == 0 for k, r in exact.items() if r.n_items)


def test_odd_documents(spark, odd, empty):
    items = spark.createDataFrame([(1, PLAIN), (None, "word"), (2, None), (3, "")], "item_id long, text string")
    found = decontaminate.near_report(odd, items).collect()
    assert sorted(str(r.doc_id) for r in found) == sorted(str(r[0]) for r in ROWS)
    for r in found:
        if r.doc_id is not None:
            text = next(x[1] for x in ROWS if x[0] == r.doc_id)
            expected = near_windows(text, [("1", PLAIN), (None, "word")], 13, decontaminate.SLACK, decontaminate.REACH)
            assert (r.n_near_windows, r.n_near) == (len({at[1:] for at in expected}), len({at[0] for at in expected if at[0]}))
            assert (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) == brute.contamination(text, [("1", PLAIN), (None, "word")])
    assert decontaminate.near_report(empty, items).collect() == []
    assert all(r.n_near == 0 for r in decontaminate.near_report(odd, items.where("false")).collect())
