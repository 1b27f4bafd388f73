"""Conversation repair against a plain search that holds every way with all of its edits."""

import random
import re
import zlib
from collections import defaultdict
from hashlib import md5, sha256

import pytest

from vocalis.llm import conversations

SPACES = " \t\n\x0b\x0c\r"


def plain_faults(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        end = text.rstrip(SPACES)
        faults.append("b" if not end else "d" if (role, text) in seen else "t" if end[-1] not in ".!?" else "")
        seen.add((role, text))
    return faults


def plain_repair(rows):
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of the rows of one conversation, in order."""

    def with_insertions(best):
        for _ in range(2):
            for state, (cost, audit, out) in list(best.items()):
                to = "a" if state == "u" else "u"
                way = (cost + 5, audit + "I", [*out, ({"a": "assistant", "u": "user"}[to], "")])
                if to not in best or way[:2] < best[to][:2]:
                    best[to] = way
        return best

    faults = plain_faults(rows)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    best = with_insertions({"": (0, "", [])})
    for (_, role, text), fault in zip(rows, faults):
        new = {}

        def put(state, way):
            if state not in new or way[:2] < new[state][:2]:
                new[state] = way

        for state, (cost, audit, out) in best.items():
            put(state, (cost + 2, audit + "D", out))
            if fault in ("b", "d"):
                continue
            stay, to = 5 if fault == "t" else 0, "a" if state == "u" else "u"
            put(to, (cost + 1 + stay, audit + "R", [*out, ({"a": "assistant", "u": "user"}[to], text)]))
            if role[:1] == to:
                put(to, (cost + stay, audit + "K", [*out, (role, text)]))
            if role[:1] == "s" and not state:
                put("s", (cost + stay, audit + "K", [*out, (role, text)]))
        best = with_insertions(new)
    cost, audit, out = min((best[s] for s in ("", "a") if s in best), key=lambda way: way[:2])
    text = "\n".join(f"{r}:{t}" for r, t in out)
    return gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit, sha256(text.encode()).hexdigest()


def plain(rows):
    """conversation -> the same, after the damage."""
    space, kept = lambda v: " " if v is None else v, defaultdict(list)
    for conv, turn, role, text in rows:
        damage, role, text = zlib.crc32(f"{space(conv)}:{space(turn)}".encode()) % 20, space(role), space(text)
        text = "" if damage == 1 else re.sub("[.!?]", "", text) if damage == 2 else text
        kept[conv] += [(turn, "user" if damage == 4 else role, text)] * {0: 0, 3: 2}.get(damage, 1)
    digest = lambda r: md5(f"{len(r[1].encode())}:{r[1]}{r[2]}".encode()).hexdigest()
    return {c: plain_repair(sorted(kept[c], key=lambda r: (r[0] is not None, r[0] or 0, digest(r)))) for c in dict.fromkeys(r[0] for r in rows)}


def found(df):
    return {r[0]: tuple(r)[1:] for r in conversations.repair_damaged(df).collect()}


def random_rows(rnd, most):
    roles, texts = ["user", "assistant", "system", "tool", ""], ["ok.", "ok", "", " \t", "{}.", "{}!", "{}"]
    return [(i, rnd.choice(roles), rnd.choice(texts).format(i)) for i in range(rnd.randint(0, most))]


def coded(rows):
    return [(*r, {"": 0, "b": 1, "d": 2, "t": 3}[f]) for r, f in zip(rows, plain_faults(rows))]


def test_random_conversations_whole_and_in_blocks():
    rnd = random.Random(5)
    for _ in range(1500):
        rows = random_rows(rnd, 14)
        expected, given = plain_repair(rows)[5:], coded(rows)
        cost, audit, sha = list(conversations._edited(iter(given), None, None))[-1][1][:3]
        assert (cost, audit, sha) == expected, rows
        cuts = [0, *sorted(rnd.sample(range(len(rows) + 1), min(3, len(rows)))), len(rows)]
        blocks = [given[a:b] for a, b in zip(cuts, cuts[1:]) if a < b]
        if not blocks:
            continue
        ways = conversations.between([conversations.table_of([conversations.kind(r[1][:1], r[3]) for r in b]) for b in blocks])
        ways[-1] = (ways[-1][0], -1)
        parts = [list(conversations._edited(iter(b), *way)) for b, way in zip(blocks, ways)]
        data = b"".join(made for block in parts for what, made in block if what == "turns")
        summaries = [block[-1][1] for block in parts]
        assert (sum(s[0] for s in summaries), "".join(s[1] for s in summaries), sha256(data[1:]).hexdigest()) == expected, (rows, cuts)


def test_survivors_meet_so_little_is_held():
    rnd, search, held, final = random.Random(2), conversations.Survivors(), 0, 0
    for i in range(20_000):
        role = "ua"[i % 2] if rnd.random() < 0.9 else rnd.choice("sua")
        final += len(search.step(conversations.kind(role, 3 if rnd.random() < 0.1 else 0)))
        held = max(held, i + 1 - final)
    assert held < 200  # rows that are not decided, of 20,000


def test_ways_that_stay_tied_are_compared_whole():
    """Roles that say nothing leave every deletion equally cheap; the earliest one comes first in ASCII."""
    rows = [(i, "tool", f"{i}.") for i in range(2001)]
    cost, audit, _ = list(conversations._edited(iter(coded(rows)), None, None))[-1][1][:3]
    assert cost == 2002 and audit == "D" + "R" * 2000


@pytest.mark.parametrize("partitions", [8, 60])
def test_whole_table(spark, sf_dir, partitions):
    """With many partitions many conversations cross blocks."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", str(partitions == 8).lower())
    try:
        rows = spark.read.parquet(f"{sf_dir}/conversations.parquet")
        assert found(rows) == plain([tuple(r) for r in rows.collect()])
        one = rows.selectExpr("0L as conv_id", "conv_id * 100 + turn as turn", "role", "text")
        assert found(one) == plain([tuple(r) for r in one.collect()])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


ODD = [
    (None, None, None, None), (None, 1, "user", "a."), (None, 1, "user", "a."), (1, None, "user", "Hm?"), (1, None, "user", "Hm?"), (1, 4, "assistant", "Yes"),
    (1, 4, None, "no role."), (1, 9, "assistant", None), (2, 0, "", ""), (3, 1, "system", "s."), (4, 7, "user", "long. " * 60_000), (4, 8, "assistant", "é😀!" * 3),
    (5, -3, "user", "x.\n \t"), (5, 12, "assistant", "y."), (6, 0, "user", "a."), (6, 1, "user", "b."), (6, 1, "assistant", "b."), (6, 2, "assistant", "d."),
]


@pytest.mark.parametrize("extra", [(), ("conv", "at", "part", "damage", "fault", "copy", "a.b")])
def test_odd_rows(spark, extra):
    names = "conv_id long, turn long, role string, text string" + "".join(f", `{c}` string" for c in extra)
    df = spark.createDataFrame([(*r, *extra) for r in ODD], names).repartition(3)
    assert found(df) == plain(ODD)


def test_rows_all_dropped_and_empty_table(spark):
    lost = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    df = spark.createDataFrame([(lost, 0, "user", "a.")], "conv_id long, turn long, role string, text string")
    assert found(df) == {lost: (0, 0, 0, 0, 0, 0, "", sha256().hexdigest())}
    assert found(df.where("false")) == {}
