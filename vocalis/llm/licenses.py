"""Licence scans with ordered signature rules.

The words of a text, in lower case, are joined by single spaces. A keyword looks whether a block of rules is
worth running; the rules of the block that match give detections, intervals of words with a label
and a priority. A detection inside the interval of one with higher priority, or of a longer one with the
same priority, is suppressed. Fixed base phrases are found beside the rules and always stay.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocalis.llm import common
from vocalis.llm.license_rules import TABLE

#: Phrases and labels of the base scan.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
#: Weight of one place of a base phrase in the score, as a priority.
BASE_PRIORITY = 80
#: Everything that is not a digit, a-z or beyond ASCII becomes a space.
SPACED = bytes(b if b >= 0x80 or chr(b).isdigit() or chr(b).islower() else 0x20 for b in range(256))


class Rule(NamedTuple):
    label: str
    priority: int
    pattern: re.Pattern[bytes]


class Hit(NamedTuple):
    start: int
    end: int
    label: str
    priority: int


def _whole_words(expression: str) -> re.Pattern[bytes]:
    return re.compile(rb"(?<![^ ])(?:" + expression.encode() + rb")(?![^ ])")


@lru_cache(maxsize=8)
def blocks(table: str = TABLE) -> list[tuple[bytes, list[Rule]]]:
    """(keyword, rules) in the order of the table."""
    made: list[tuple[bytes, list[Rule]]] = []
    for line in filter(None, map(str.strip, table.splitlines())):
        if line.startswith("= "):
            made.append((line[2:].encode(), []))
        else:
            label, priority, expression = line.split(" ", 2)
            made[-1][1].append(Rule(label, int(priority), _whole_words(expression)))
    return made


@lru_cache(maxsize=8)
def _base_rules() -> list[tuple[bytes, Rule]]:
    return [(phrase.encode(), Rule(label, BASE_PRIORITY, _whole_words(phrase))) for phrase, label in BASE.items()]


def words_of(data: bytes) -> list[bytes]:
    return data.lower().translate(SPACED).split()


def _places(rule: Rule, joined: bytes) -> Iterator[Hit]:
    at, place = 0, 0  # words are counted on from the last match
    for match in rule.pattern.finditer(joined):
        place += joined.count(b" ", at, match.start())
        at = match.start()
        yield Hit(place, place + match[0].count(b" ") + 1, rule.label, rule.priority)


def base_hits(joined: bytes) -> list[Hit]:
    return [hit for phrase, rule in _base_rules() if phrase in joined for hit in _places(rule, joined)]


def rule_hits(joined: bytes, table: str = TABLE) -> list[Hit]:
    """All matches of the rules whose keyword occurs, before suppression."""
    return [hit for keyword, rules in blocks(table) if keyword in joined for rule in rules for hit in _places(rule, joined)]


def unsuppressed(hits: list[Hit]) -> list[Hit]:
    """The hits that lie in no interval of a stronger one: higher priority, then longer, then earlier in the list.

    A sweep per priority, the highest first: a hit is inside if one that starts no later, of its own priority or
    a higher one, ends no earlier. Time grows with the number of hits, whatever they cover.
    """
    if len(hits) < 2:
        return hits
    start, end, priority = (np.array(column, np.int64) for column in zip(*[(h.start, h.end, h.priority) for h in hits]))
    order = np.lexsort((np.arange(len(hits)), -end, start))
    kept = np.zeros(len(hits), bool)
    starts, furthest = np.empty(0, np.int64), np.array([-1])  # of the stronger ones: furthest[k] for the first k starts
    for level in np.unique(priority)[::-1]:
        own = order[priority[order] == level]
        first, last = start[own], end[own]
        inside = furthest[np.searchsorted(starts, first, "right")] >= last
        inside[1:] |= np.maximum.accumulate(last)[:-1] >= last[1:]
        kept[own] = ~inside
        place = np.searchsorted(starts, first, "right")
        starts = np.insert(starts, place, first)
        furthest = np.concatenate([[-1], np.maximum.accumulate(np.insert(furthest[1:], place, last))])
    return [hits[i] for i in np.flatnonzero(kept)[np.argsort(start[kept], kind="stable")]]


def score(hits: list[Hit]) -> float:
    """0 without a hit; every hit takes its priority's share of what is left to 1, each label once."""
    left = 1.0
    for priority in sorted({h.label: h.priority for h in sorted(hits, key=lambda h: h.priority)}.values()):
        left *= 1 - priority / 100
    return round(1 - left, 6)


def scan_text(data: bytes, table: str = TABLE) -> tuple[int, list[Hit], list[Hit]]:
    """(number of words, base hits, unsuppressed hits of the rules) of one whole text."""
    words = words_of(data)
    joined = b" ".join(words)
    return len(words), base_hits(joined), unsuppressed(rule_hits(joined, table))


def detections(docs: DataFrame, key: str = "doc_id", text: str = "text", table: str = TABLE) -> DataFrame:
    """(key, n_words, base, rules): the intervals found, as arrays of struct<start, end, label, priority>.

    A null or empty text has no words and empty arrays. Repeated rows are scanned each; an empty table
    gives no rows. Other columns are not read.
    """

    def make():
        def scan(texts: list[bytes]) -> dict[str, list]:
            found = [scan_text(t, table) for t in texts]
            as_rows = lambda hits: [h._asdict() for h in hits]
            return {"n_words": [n for n, _, _ in found], "base": [as_rows(b) for _, b, _ in found],
                    "rules": [as_rows(r) for _, _, r in found], "score": [score(b + r) for _, b, r in found]}

        return scan

    hit = "array<struct<start: long, end: long, label: string, priority: int>>"
    return common.per_text(docs, make, f"n_words long, base {hit}, rules {hit}, score double", key, text)


def summary(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_words, n_base, first_word, last_word, base_labels, labels, score) from ``detections``."""
    starts, labels = F.col("base.start"), lambda c: F.array_sort(F.array_distinct(c))
    return found.select(
        key, "n_words", F.size("base").cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        F.array_join(labels(F.col("base.label")), ",").alias("base_labels"),
        F.array_join(labels(F.concat("base.label", "rules.label")), ",").alias("labels"), "score",
    )
