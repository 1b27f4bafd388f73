"""A Merkle manifest of a table: one tree of hashes per group, logged in postorder, with proofs read from the log.

Rows are leaves; every two neighbouring nodes make one node of the next height, and a last node without a neighbour
is hashed alone, until one node, the subroot, remains. The subroots, in the order of their groups, are the leaves
of one more such tree, whose root stands for the table.

Trees are built in tiers of ``TIER`` heights. An aligned builder takes up to 2**TIER neighbouring nodes and writes the
nodes above them in the order in which they are complete, each with its place in the postorder of its whole tree.
No builder has to ask another for a place: a node's place follows from the sizes of the subtrees before it
(``positions``), which the number of leaves alone decides. Proofs go from the top tier to the lowest: a segment of
the log is read once, siblings are found by their places, and a node's proof is its siblings in the segment followed by the
proof of the segment's top. So a group of any size is spread over its blocks, and no task holds more than
one block and one proof.

The table of trees is written after the log and names the subroots: without it a log is not complete.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocalis.llm import common
from vocalis.session import workspace

#: Heights that one builder adds; it holds 2**TIER nodes of the height below.
TIER = 11
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
LOG = "tree {tree}, height int, at long, n long, pos long, digest string"


class Manifest(NamedTuple):
    """``log`` and ``trees`` of the groups, and the same of the tree over their subroots."""

    log: DataFrame
    trees: DataFrame  # tree, n, subroot, tree_at, n_trees, root
    top: DataFrame
    tiers: int
    top_tiers: int
    tier: int


def hashed(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def row_digest(*values: Column) -> Column:
    """The hash of a row: each value as its length in bytes, a colon and itself; a null as a dash."""
    parts = [F.coalesce(F.concat(F.octet_length(v.cast("string")).cast("string"), F.lit(":"), v.cast("string")), F.lit("-")) for v in values]
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def positions(height: int, at: np.ndarray, n: int) -> np.ndarray:
    """Places in the postorder of a tree of ``n`` leaves: the nodes complete before the subtree's first leaf
    (2 * leaves - bits set), and the subtree's own size, whose last node this is."""
    start = at << height
    covered = np.minimum(n - start, 1 << height)
    size = sum((covered + (1 << h) - 1) >> h for h in range(height + 1))
    return 2 * start - np.bitwise_count(start).astype(np.int64) + size - 1


def completed(first: int, digests: list[str], base: int, n: int, tier: int) -> Iterator[tuple[int, int, str]]:
    """Nodes above neighbouring ones of height ``base``, up to ``tier`` heights more, in completion order; the
    given ones are among them if they are leaves."""
    left: dict[int, str] = {}
    for at, digest in enumerate(digests, first):
        height, last = base, (n - 1) >> base
        if not base:
            yield height, at, digest
        while last and height < base + tier:
            if at & 1:
                digest = hashed(left.pop(height) + digest)
            elif at == last:
                digest = hashed(digest)
            else:
                left[height] = digest
                break
            height, at, last = height + 1, at >> 1, last >> 1
            yield height, at, digest


def folded(digest: str, at: int, n: int, siblings: Iterator[str]) -> str:
    """The root that a node and its siblings, lowest first, lead to."""
    last = n - 1
    while last:
        if at & 1:
            digest = hashed(next(siblings) + digest)
        else:
            digest = hashed(digest + next(siblings)) if at < last else hashed(digest)
        at, last = at >> 1, last >> 1
    return digest


def _with(function: Callable, *first) -> Callable[[pd.DataFrame], pd.DataFrame]:
    return lambda rows: function(*first, rows)


def _built(base: int, tier: int, rows: pd.DataFrame) -> pd.DataFrame:
    rows = rows.sort_values("at")
    n = int(rows.n.iloc[0])
    nodes = list(completed(int(rows["at"].iloc[0]), rows.digest.tolist(), base, n, tier))
    found = pd.DataFrame(nodes, columns=["height", "at", "digest"])
    found["pos"] = 0
    for height, part in found.groupby("height"):
        found.loc[part.index, "pos"] = positions(int(height), part["at"].to_numpy(np.int64), n)
    found["n"], found["tree"] = n, rows.tree.iloc[0]
    return found[["tree", "height", "at", "n", "pos", "digest"]]


def _block(base: int, tier: int) -> Column:
    """The block of a tier that a node lies in, its top left out."""
    return F.expr(f"shiftright(at, {base + tier} - height)")


def build(leaves: DataFrame, path: str, tier: int = TIER) -> tuple[DataFrame, int]:
    """The log of all trees over ``leaves`` (tree, at, n, digest), written tier by tier, and how many tiers it has."""
    common._find_package(leaves)
    schema = LOG.format(tree=leaves.schema["tree"].dataType.simpleString())
    most = leaves.agg(F.max("n")).first()[0] or 1
    level, base, tiers = leaves, 0, 0
    while not tiers or (most - 1) >> base:
        made = level.groupBy("tree", F.shiftright("at", tier)).applyInPandas(_with(_built, base, tier), schema)
        made.write.parquet(f"{path}/tier={tiers}")
        base, tiers = base + tier, tiers + 1
        level = leaves.sparkSession.read.schema(schema).parquet(f"{path}/tier={tiers - 1}")
        level = level.where((F.col("height") == base) & (F.shiftright(F.col("n") - 1, base) > 0))
    return leaves.sparkSession.read.schema(schema + ", tier int").parquet(path), tiers


def _roots(log: DataFrame) -> DataFrame:
    return log.where("at = 0 and shiftright(n - 1, height) = 0")


def manifest(leaves: DataFrame, path: str | None = None, tier: int = TIER) -> Manifest:
    """The trees over ``leaves`` (tree, at, n, digest), and the tree over their subroots; null comes first."""
    spark = leaves.sparkSession
    path = path or workspace(spark)
    log, tiers = build(leaves, f"{path}/log", tier)
    subroots = common.written(_roots(log).select("tree", "n", F.col("digest").alias("subroot")))
    placed = common.place_in_order(subroots, ["tree"])
    placed = common.written(placed.withColumn("n_trees", F.lit(subroots.count()).cast("long")))
    over = placed.select(F.lit("").alias("tree"), F.col("_place").alias("at"), F.col("n_trees").alias("n"), F.col("subroot").alias("digest"))
    top, top_tiers = build(over, f"{path}/top", tier)
    root = _roots(top).select("digest").first()
    trees = placed.withColumnRenamed("_place", "tree_at").withColumn("root", F.lit(root and root.digest).cast("string"))
    trees.write.parquet(f"{path}/trees")
    return Manifest(log, spark.read.schema(trees.schema).parquet(f"{path}/trees"), top, tiers, top_tiers, tier)


def _siblings(base: int, tier: int, ats: np.ndarray, segment: pd.DataFrame) -> list[str]:
    """The digests of the siblings of nodes of height ``base`` within a segment of the log, lowest first, and
    those of the segment's top."""
    above = segment.height.to_numpy() < 0
    nodes = segment[~above].sort_values("pos")
    pos, digests, n = nodes.pos.to_numpy(np.int64), nodes.digest.to_numpy(object), int(nodes.n.iloc[0])
    columns = []
    for height in range(base, base + tier):
        last = (n - 1) >> height
        if not last:
            break
        beside = (ats >> (height - base)) ^ 1
        there = beside <= last
        found = np.searchsorted(pos, positions(height, np.where(there, beside, 0), n))
        columns.append(np.where(there, digests[np.minimum(found, len(pos) - 1)], ""))
    columns.append(np.repeat(segment.digest.to_numpy(object)[above][:1], len(ats)))
    return ["".join(parts) for parts in zip(*columns)]


def _paths(base: int, tier: int, segment: pd.DataFrame) -> pd.DataFrame:
    nodes = segment[segment.height == base]
    ats = nodes["at"].to_numpy(np.int64)
    return pd.DataFrame({"tree": nodes.tree, "at": ats, "path": _siblings(base, tier, ats, segment)})


def _segments(log: DataFrame, base: int, tier: int, above: DataFrame) -> DataFrame:
    """The log of one tier by blocks; a block's proof (tree, block, path) goes with it at height -1."""
    inside = log.where((F.col("height") >= base) & (F.col("height") < base + tier))
    if base:  # roots that are complete below have no siblings here
        inside = inside.where(F.shiftright(F.col("n") - 1, base) > 0)
    inside = inside.select("tree", _block(base, tier).alias("block"), "height", "at", "n", "pos", "digest")
    tops = above.select("tree", "block", F.lit(-1).alias("height"), "at", "n", F.lit(-1).cast("long").alias("pos"), F.col("path").alias("digest"))
    return inside.unionByName(tops)


def _above_lowest(log: DataFrame, tiers: int, tier: int, trees: DataFrame) -> DataFrame:
    """Proofs of the tops of the lowest blocks, with the tree's place among the trees: (tree, block, path, at, n).

    ``trees`` brings the proof of each tree's root as ``path``, its number of leaves as ``leaves``, and ``at``, ``n``.
    """
    paths = None
    for step in range(tiers - 1, -1, -1):
        base = step * tier
        ends_here = F.shiftright(F.col("leaves") - 1, base + tier) == 0
        if step:
            ends_here &= F.shiftright(F.col("leaves") - 1, base) > 0
        own = trees.where(ends_here).select("tree", F.lit(0).cast("long").alias("block"), "path", "at", "n")
        if paths is not None:
            places = trees.select(F.col("tree").alias("_tree"), F.col("at").alias("_at"), F.col("n").alias("_n"))
            lower = paths.join(places, F.col("tree").eqNullSafe(F.col("_tree")))
            own = own.unionByName(lower.select("tree", F.col("at").alias("block"), "path", F.col("_at").alias("at"), F.col("_n").alias("n")))
        if not step:
            return own
        schema = f"tree {log.schema['tree'].dataType.simpleString()}, at long, path string"
        found = _segments(log, base, tier, own).groupBy("tree", "block").applyInPandas(_with(_paths, base, tier), schema)
        paths = common.written(found)
    raise AssertionError("a log has a tier")


def _proved(tier: int, rows: pd.DataFrame, segment: pd.DataFrame) -> pd.DataFrame:
    if rows.empty or segment.empty:
        return pd.DataFrame({"key": [], "leaf": [], "tree": [], "path": [], "folded_root": []})
    top = segment[segment.height < 0].iloc[0]
    paths = _siblings(0, tier, rows["at"].to_numpy(np.int64), segment)
    ends = []
    for claimed, at, n, path in zip(rows.claimed, rows["at"], rows.n, paths):
        siblings = (path[i : i + 64] for i in range(0, len(path), 64))
        subroot = folded(claimed, int(at), int(n), siblings)
        ends.append(folded(subroot, int(top["at"]), int(top.n), siblings))
    return pd.DataFrame({"key": rows.key, "leaf": rows.digest, "tree": rows.tree, "path": paths, "folded_root": ends})


def _proving(tier: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    return lambda rows, segment: _proved(tier, rows, segment)


def proofs(made: Manifest, leaves: DataFrame) -> DataFrame:
    """One row per leaf: key, tree, leaf, its subroot and root, ``path`` (the digests of its siblings up to the root, lowest
    first, in a row) and ``folded_root``, the root that the row's ``claimed`` digest and the path lead to."""
    over = made.trees.select(F.lit("").alias("tree"), F.lit("").alias("path"), F.lit(0).cast("long").alias("at"), F.lit(1).cast("long").alias("n"), F.col("n_trees").alias("leaves"))
    top = _segments(made.top, 0, made.tier, _above_lowest(made.top, made.top_tiers, made.tier, over.distinct()))
    top = common.written(top.groupBy("tree", "block").applyInPandas(_with(_paths, 0, made.tier), "tree string, at long, path string"))
    trees = made.trees.join(top.select(F.col("at").alias("tree_at"), "path"), "tree_at")
    trees = common.written(trees.select("tree", "path", F.col("tree_at").alias("at"), F.col("n_trees").alias("n"), F.col("n").alias("leaves")))
    segments = _segments(made.log, 0, made.tier, _above_lowest(made.log, made.tiers, made.tier, trees))
    tree, key = leaves.schema["tree"].dataType.simpleString(), leaves.schema["key"].dataType.simpleString()
    grouped = leaves.withColumn("block", F.shiftright("at", made.tier)).groupBy("tree", "block")
    schema = f"key {key}, leaf string, tree {tree}, path string, folded_root string"
    found = grouped.cogroup(segments.groupBy("tree", "block")).applyInPandas(_proving(made.tier), schema)
    roots = made.trees.select(F.col("tree").alias("_tree"), "subroot", "root")
    return found.join(roots, F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree")


def leaves_of(docs: DataFrame, digest: Column, claimed: Column | None = None, key: str = "doc_id", group: str = "lang") -> DataFrame:
    """(key, tree, at, n, digest, claimed): every row as a leaf, its place in its group by key, and the group's size.

    Null keys come first; rows with one key are placed by their digests. A null group is a group.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(group).alias("tree"), digest.alias("digest"), (digest if claimed is None else claimed).alias("claimed"))
    placed = common.place_in_order(rows, ["key", "digest"], "tree").withColumnRenamed("_place", "at")
    sizes = common.written(placed.groupBy(F.col("tree").alias("_tree")).agg(F.count(F.lit(1)).alias("n")))
    return placed.join(sizes, F.col("tree").eqNullSafe(F.col("_tree"))).drop("_tree")


def tampered(key: str = "doc_id") -> Column:
    """Rows that an audit changes: those whose key's checksum 7 divides. A row without a key is left as it is."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 7 == 0, F.lit(False))


def audit(docs: DataFrame, path: str | None = None, tier: int = TIER) -> DataFrame:
    """Every row's proof, checked against a table in which some rows' ``n_chars`` has changed.

    One row per row: doc_id, leaf, subroot, root, proof_sha256 (of the siblings in a row), folded_root, verified.
    Nulls in any column are told from empty texts; a changed null stays null, so its row is verified. Repeated rows are
    leaves each. An empty table gives no rows. Other columns are not read.
    """
    columns = {c: F.col(c) for c in COLUMNS}
    changed = columns | {"n_chars": F.when(tampered(), F.col("n_chars") + 1).otherwise(F.col("n_chars"))}
    leaves = leaves_of(docs, row_digest(*columns.values()), row_digest(*changed.values()))
    rows = proofs(manifest(leaves, path, tier), leaves)
    return rows.select(
        F.col("key").alias("doc_id"), "leaf", "subroot", "root", F.sha2(F.col("path").cast("binary"), 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )
