"""The cascade: its order follows the estimates, stops at the first rejection and never changes a verdict."""

import random

from vocalis.llm import quality
from vocalis.llm.quality import RULES, Text, estimates, ordered, rejected_by


def texts(documents):
    odd = ["", " ", "A B C " * 30, "x " * 50, "### " * 40, "line\n" * 60, "ok words here " * 3]
    return [(r.text or "").encode() for r in documents.collect()] + [t.encode() for t in odd]


def test_order_changes_no_verdict(documents):
    rng, sample = random.Random(1), texts(documents)
    verdicts = [rejected_by(Text(t), RULES) is None for t in sample]
    assert True in verdicts and False in verdicts
    for _ in range(5):
        rules = rng.sample(RULES, len(RULES))
        assert [rejected_by(Text(t), rules) is None for t in sample] == verdicts


def test_rules_are_ordered_by_rejections_per_cost():
    rules = [(name, lambda t: False) for name in "abcd"]
    found = {"a": (1.0, 0.1), "b": (0.1, 0.1), "c": (0.1, 0.9), "d": (0.0, 0.0)}
    assert [name for name, _ in ordered(rules, found)] == ["c", "b", "a", "d"]


def test_rules_after_a_rejection_are_not_evaluated():
    seen = []
    rules = [("one", lambda t: seen.append(1) or False), ("two", lambda t: seen.append(2) or True), ("three", lambda t: seen.append(3))]
    assert rejected_by(Text(b"x"), rules) == "two" and seen == [1, 2]


def test_estimates_are_of_each_rule_alone(documents):
    found = estimates(texts(documents))
    assert found.keys() == {name for name, _ in RULES}
    assert all(cost >= 0 and 0 <= rejected <= len(texts(documents)) for cost, rejected in found.values())
    assert quality.cascade(documents) and set(quality.cascade(documents)) == set(found)


def test_the_sample_has_whole_texts_of_all_parts(spark):
    """A rule that only the ends of long texts in the last files break is found selective."""
    rows = [(i, "word " * 6000 + ("end" if i >= 900 else "stop")) for i in range(1000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartitionByRange(5, "doc_id")
    rules = [("never", lambda t: False), ("ends", lambda t: t.data.endswith(b"end"))]
    assert quality.cascade(docs, rules=rules, rows=300) == ["ends", "never"]
    assert quality.cascade(docs.where("false"), rules=rules) == ["never", "ends"]
    assert quality.cascade(docs.selectExpr("doc_id", "cast(null as string) as text").limit(3), rules=rules) == ["never", "ends"]
