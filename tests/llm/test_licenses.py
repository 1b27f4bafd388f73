"""Suppression of detections against its definition, and its cost on long texts."""

import random
import time

import pytest

from vocalis.llm import licenses
from vocalis.llm.licenses import Hit


def plain(hits):
    """Every hit against every stronger one."""
    rank = sorted(range(len(hits)), key=lambda i: (-hits[i].priority, hits[i].start - hits[i].end, i))
    kept = []
    for at, i in enumerate(rank):
        if not any(hits[j].start <= hits[i].start and hits[j].end >= hits[i].end for j in rank[:at]):
            kept.append(i)
    return [hits[i] for i in sorted(kept, key=lambda i: (hits[i].start, i))]


@pytest.mark.parametrize("places", [3, 12, 60, 400])
def test_suppression_by_definition(places):
    rng = random.Random(places)
    for _ in range(300):
        hits = []
        for _ in range(rng.randrange(40)):
            start = rng.randrange(places)
            hits.append(Hit(start, start + rng.randint(1, 8), rng.choice("abc"), rng.choice([50, 80, 80, 95])))
        assert licenses.unsuppressed(hits) == plain(hits)


def test_a_hundred_thousand_hits():
    rng = random.Random(1)
    hits = [Hit(s, s + rng.randint(1, 9), "x", rng.randint(1, 100)) for s in (rng.randrange(500_000) for _ in range(100_000))]
    began = time.process_time()
    kept = licenses.unsuppressed(hits)
    assert time.process_time() - began < 1
    assert 0 < len(kept) < len(hits)


def test_signs_after_a_version():
    """A plus sign is a space like any other sign, so the rules do without it."""
    labels = lambda t: {h.label for h in licenses.scan_text(t.encode())[2]}
    assert "gpl-3.0" in labels("GPL 3.0+") and "gpl-2.0" in labels("GPL 2.0+") and "openrail" in labels("CreativeML OpenRAIL++ license")
