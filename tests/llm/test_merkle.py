"""The Merkle manifest against trees built whole."""

import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import pytest
from llm.conftest import ROWS

from vocalis.llm import merkle


def h(text):
    return sha256(text.encode()).hexdigest()


def plain_leaf(row):
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def plain_tree(leaves):
    """The root, and every leaf's siblings with their sides, lowest first."""
    paths, level, where = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(level) > 1:
        for k, i in enumerate(where):
            beside = i ^ 1
            paths[k].append(("left" if i % 2 else "right", level[beside]) if beside < len(level) else ("none", ""))
            where[k] = i // 2
        level = [h("".join(level[i : i + 2])) for i in range(0, len(level), 2)]
    return level[0], paths


def plain_fold(digest, path):
    for side, other in path:
        digest = h(other + digest if side == "left" else digest + other)
    return digest


def plain(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[2]].append(row)
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, plain_leaf(r)))
        trees[g] = plain_tree([plain_leaf(r) for r in groups[g]])
    root, upper = plain_tree([trees[g][0] for g in names]) if names else (None, [])
    out = []
    for g, above in zip(names, upper):
        for row, path in zip(groups[g], trees[g][1]):
            changed = row[3]
            if changed is not None and row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0:
                changed += 1
            end = plain_fold(plain_leaf((*row[:3], changed, row[4])), path + above)
            out.append((row[0], plain_leaf(row), trees[g][0], root, h("".join(d for _, d in path + above)), end, end == root))
    return sorted(map(repr, out))


def found(df, **how):
    return sorted(map(repr, map(tuple, merkle.audit(df, **how).collect())))


def test_positions_are_the_order_of_completion():
    for n in [*range(1, 70), 127, 128, 129, 1000]:
        nodes = list(merkle.completed(0, ["x"] * n, 0, n, 40))
        placed = [int(merkle.positions(height, np.array([at]), n)[0]) for height, at, _ in nodes]
        assert placed == list(range(len(nodes)))


@pytest.mark.parametrize("tier", [merkle.TIER, 2])
def test_whole_table(spark, documents, tier):
    """Low tiers make blocks and several rounds of a small table; one language holds most of the rows."""
    rows = documents.select(*merkle.COLUMNS)
    got = merkle.audit(documents, tier=tier).collect()
    assert sorted(map(repr, map(tuple, got))) == plain([tuple(r) for r in rows.collect()])
    assert 0 < sum(not r.verified for r in got) < len(got) / 3


def test_odd_rows(spark, odd):
    rows = [(r[0], r[3], r[2], r[4], r[1]) for r in ROWS]
    assert found(odd) == plain(rows) == found(odd, tier=1)


def test_null_is_not_an_empty_text(spark, odd):
    got = {r.doc_id: r for r in merkle.audit(odd).collect()}
    assert got[3].leaf != got[4].leaf and got[3].verified


@pytest.mark.parametrize("n", [1, 2, 3, 9])
def test_sizes_of_one_group_and_one_row_groups(spark, n):
    rows = [(i, "s", "en", i, f"t{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(df, tier=1) == plain(rows)
    rows = [(i, "s", f"l{i}", i, f"t{i}") for i in range(n)]
    df = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert found(df, tier=1) == plain(rows)


def test_empty_table(spark, empty):
    assert merkle.audit(empty).collect() == []


def test_log_holds_every_node_once_at_its_place(spark, documents, tmp_path):
    columns = [documents[c] for c in merkle.COLUMNS]
    made = merkle.manifest(merkle.leaves_of(documents, merkle.row_digest(*columns)), str(tmp_path / "m"), 3)
    by_tree = defaultdict(list)
    for r in made.log.collect():
        by_tree[r.tree].append(r.pos)
    sizes = {r.tree: r.n for r in made.trees.collect()}
    for tree, places in by_tree.items():
        assert sorted(places) == list(range(len(places))) and len(places) >= 2 * sizes[tree] - 1
