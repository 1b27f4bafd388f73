"""Near-duplicates by circulant MinHash.

Two permutations give the whole signature: the first scatters the shingles of a text over a circle of
places, the second, shifted by one place for every coordinate, orders them; a coordinate is the smallest
value at its shift. Texts that agree in all coordinates of a band share a bucket and are candidates, and
links are confirmed on full shingle sets.

Copies collapse to one node before anything else. Within a bucket not all pairs are looked at:

1. Every node of a bucket is compared with the bucket's hub, the node with most company over all bands, as
   copies with few edits are nearest to the others. Confirmed links make components.
2. Buckets whose nodes still lie in several components are joined into clusters. In each, the nodes outside
   the largest component are compared with all nodes of other components, in blocks of bounded size that
   hold shingle sets and give one link per node and component. That finds every link that is left.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vocalis.llm import common
from vocalis.llm.components import components

SHINGLE = 5
#: Linked when 100 * intersection >= PERCENT * union.
PERCENT = 85
#: A pair with similarity 0.85 shares none of 32 bands of 6 coordinates with probability 3e-7.
BANDS, ROWS = 32, 6
#: Places of the circle; a power of two.
CIRCLE = 1 << 20
SEED = 20_240_229
#: Shingles of a block's side, beyond the last text; bounds a task's memory.
BLOCK_SHINGLES = 16_384
#: Word hashes remembered per worker.
CACHE = 400_000
MIX = np.uint64(0x9E3779B97F4A7C15)


@lru_cache(maxsize=2)
def _second(coordinates: int = BANDS * ROWS) -> np.ndarray:
    """The second permutation, all its shifts as overlapping rows: row p holds the values at p, p + 1, ..."""
    order = np.random.default_rng(SEED).permutation(CIRCLE).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([order, order[:coordinates]]), coordinates)


def _first(codes: np.ndarray) -> np.ndarray:
    """The first permutation: a place on the circle for every shingle code."""
    mixed = (codes ^ (codes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return (mixed >> np.uint64(64 - CIRCLE.bit_length() + 1)).astype(np.int64)


def signature(codes: np.ndarray, coordinates: int = BANDS * ROWS) -> np.ndarray:
    """Coordinate k is the smallest value of the second permutation, shifted by k, over the set's places."""
    table, lowest = _second(coordinates), np.full(coordinates, CIRCLE, np.uint32)
    places = _first(codes)
    for at in range(0, len(places), 1024):
        np.minimum(lowest, table[places[at : at + 1024]].min(axis=0), out=lowest)
    return lowest


def bands_of(codes: np.ndarray) -> np.ndarray:
    """One 64-bit hash per band, the band's number included; as signed integers."""
    rows = signature(codes).reshape(BANDS, ROWS)
    return np.array([xxhash.xxh64_intdigest(r.tobytes(), seed=b) for b, r in enumerate(rows)], np.uint64).view(np.int64)


class Shingles:
    """Sorted distinct 64-bit codes of a text's shingles."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def words(self, data: bytes) -> list[bytes]:
        return data.lower().split()  # bytes: A-Z and ASCII white space only

    def codes(self, words: list[bytes]) -> np.ndarray:
        if not words:
            return np.empty(0, np.uint64)
        if len(self.known) > CACHE:
            self.known.clear()
        known = self.known
        got = list(map(known.get, words))
        if None in got:
            for w in {w for w, g in zip(words, got) if g is None}:
                known[w] = xxhash.xxh64_intdigest(w)
            got = list(map(known.__getitem__, words))
        hashes = np.array(got, np.uint64)
        width = min(SHINGLE, len(words))
        made = np.full(len(words) - width + 1, width, np.uint64)
        for i in range(width):
            made = (made ^ (made >> np.uint64(29))) * MIX + hashes[i : i + len(made)]
        made ^= made >> np.uint64(32)
        return np.unique(made * MIX)


def digest(words: list[bytes]) -> bytes | None:
    return hashlib.md5(b" ".join(words)).digest() if words else None


def signed(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(key, digest, n_shingles, bands): the digest is of the word sequence, null without words."""

    def make():
        shingles = Shingles()

        def sign(texts: list[bytes]) -> dict[str, list]:
            found = {"digest": [], "n_shingles": [], "bands": []}
            for data in texts:
                words = shingles.words(data)
                codes = shingles.codes(words)
                found["digest"].append(digest(words))
                found["n_shingles"].append(len(codes))
                found["bands"].append(bands_of(codes) if words else None)
            return found

        return sign

    return common.per_text(docs, make, "digest binary, n_shingles long, bands array<long>", key, text)


def sets_of(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """(node, codes) for the wanted (node, digest, lowest): the set of one document of each node, its whole text.

    Where rows repeat a key with other texts, the digest tells which of them is meant.
    """
    name = F.struct("node", "digest").alias("name")
    whole = docs.select(F.col(key).alias("lowest"), F.col(text).alias("text")).join(wanted, "lowest").select(name, "text")

    def make():
        shingles = Shingles()

        def collect(texts: list[bytes]) -> dict[str, list]:
            words = [shingles.words(t) for t in texts]
            return {"digest": list(map(digest, words)), "codes": [shingles.codes(w).view(np.int64) for w in words]}

        return collect

    found = common.per_text(whole, make, "digest binary, codes array<long>", "name", "text")
    return found.where(F.col("name.digest") == F.col("digest")).select("name.node", "codes")


def linked(a: Column, b: Column) -> Column:
    """Whether two sets are similar enough, exactly."""
    shared = F.size(F.array_intersect(a, b))
    return 100 * shared >= PERCENT * (F.size(a) + F.size(b) - shared)


def _buckets(nodes: DataFrame) -> DataFrame:
    """(bucket, node, company) of the buckets with several nodes; ``company`` sums the sizes of a node's buckets."""
    rows = common.written(nodes.select("node", F.explode("bands").alias("bucket")))
    sizes = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    shared = common.written(rows.join(sizes, "bucket"))
    company = shared.groupBy("node").agg(F.sum("n").alias("company"))
    return common.written(shared.drop("n").join(company, "node"))


def _with_hubs(shared: DataFrame) -> DataFrame:
    """(bucket, node, hub): the hub is the node with the most company."""
    hubs = shared.groupBy("bucket").agg(F.max(F.struct("company", "node")).alias("hub"))
    return shared.select("bucket", "node").join(hubs, "bucket").select("bucket", "node", F.col("hub.node").alias("hub"))


def _confirmed(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The (a, b) pairs whose sets are similar enough. A node in many pairs is split by the skew join."""
    left = sets.select(F.col("node").alias("a"), F.col("codes").alias("codes_a"))
    right = sets.select(F.col("node").alias("b"), F.col("codes").alias("codes_b"))
    both = pairs.join(left, "a").join(right, "b")
    return both.where(linked(F.col("codes_a"), F.col("codes_b"))).select("a", "b")


def _rest_links(shared: DataFrame, parts: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between nodes that share a bucket, or a chain of buckets, but not yet a component."""
    rows = shared.select("bucket", "node").join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rows = common.written(rows)
    several = rows.groupBy("bucket").agg(F.min("component").alias("low"), F.max("component").alias("high"))
    several = several.where(F.col("low") != F.col("high")).select("bucket")
    rows = common.written(rows.join(several, "bucket"))
    first = rows.groupBy("bucket").agg(F.min("node").alias("low"))
    chains = rows.join(first, "bucket").select(F.col("node").alias("a"), F.col("low").alias("b")).distinct()
    clusters = components(chains).select("node", F.col("component").alias("cluster"))
    nodes = rows.select("node", "component").distinct().join(clusters, "node").join(
        sets.select("node", F.size("codes").alias("size")), "node"
    )
    nodes = common.written(nodes)
    counts = nodes.groupBy("cluster", "component").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("size"))
    stats = counts.groupBy("cluster").agg(
        F.max(F.struct("n", "component")).alias("largest"), F.sum("size").alias("all_size"),
        F.max(F.struct("n", "component", "size"))["size"].alias("largest_size"),
    )
    chunks = lambda size: F.ceil(size / BLOCK_SHINGLES).cast("int")
    stats = stats.select(
        "cluster", F.col("largest.component").alias("main"),
        F.greatest(chunks(F.col("all_size") - F.col("largest_size")), F.lit(1)).alias("n_left"), chunks(F.col("all_size")).alias("n_all"),
    )
    nodes = nodes.join(stats, "cluster")
    slot = lambda n, salt: F.pmod(F.xxhash64("node", F.lit(salt)), n).cast("int")
    to = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
    left = nodes.where(F.col("component") != F.col("main")).withColumn("i", slot(F.col("n_left"), 1)).withColumn("j", to(F.col("n_all")))
    right = nodes.withColumn("j", slot(F.col("n_all"), 2)).withColumn("i", to(F.col("n_left")))
    sides = left.withColumn("side", F.lit(0)).unionByName(right.withColumn("side", F.lit(1)))
    blocks = sides.select("cluster", "i", "j", "side", "node", "component").join(sets, "node")
    schema = T.StructType.fromDDL("a long, b long")
    common._find_package(blocks)
    return blocks.groupBy("cluster", "i", "j").applyInArrow(_compare_block, schema)


def _compare_block(block: pa.Table) -> pa.Table:
    """One link per node of side 0 and component of side 1 that it reaches, sets compared exactly."""
    side = block.column("side").to_numpy()
    nodes, parts = block.column("node").to_pylist(), block.column("component").to_pylist()
    codes = block.column("codes").combine_chunks()
    ends, flat = codes.offsets.to_numpy(), codes.values.to_numpy()
    sets = [flat[s:e] for s, e in zip(ends, ends[1:])]
    members = np.flatnonzero(side == 1)
    links_a, links_b = [], []
    if len(members):
        vocabulary, numbers = np.unique(np.concatenate([sets[m] for m in members]), return_inverse=True)
        sizes = np.array([len(sets[m]) for m in members])
        starts = np.concatenate([[0], np.cumsum(sizes)[:-1]])
        names = {p: i for i, p in enumerate(dict.fromkeys(parts))}
        numbered = np.array([names[p] for p in parts])
        marked = np.zeros(len(vocabulary), np.int64)
        for a in np.flatnonzero(side == 0):
            at = np.searchsorted(vocabulary, sets[a])
            at = at[(at < len(vocabulary))]
            at = at[np.isin(vocabulary[at], sets[a])]
            marked[at] = 1
            shared = np.add.reduceat(marked[numbers], starts)
            marked[at] = 0
            near = (100 * shared >= PERCENT * (sizes + len(sets[a]) - shared)) & (numbered[members] != numbered[a])
            _, one_each = np.unique(numbered[members[near]], return_index=True)
            for b in members[near][one_each]:
                links_a.append(nodes[a])
                links_b.append(nodes[b])
    return pa.table({"a": pa.array(links_a, pa.int64()), "b": pa.array(links_b, pa.int64())})


def groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_shingles, component_id, kept), one row per row of ``docs``.

    ``component_id`` is the smallest key in the component of links; ``kept`` marks the row that has it. A
    document without words is linked with nothing and kept. A row without a key goes with the copies of its
    text; a text that only such rows have is linked with nothing else, has no component id, and is kept. Rows that repeat a
    key are kept or not together. An empty table gives no rows. Other columns are not read.
    """
    every, place = _classes(docs, key, text)
    lowest = place.groupBy("component").agg(F.min("lowest").alias("component_id"))
    ids = place.select("digest", "component").join(lowest, "component").select(F.col("digest").alias("_digest"), "component_id")
    rows = every.join(ids, every["digest"] == ids["_digest"], "left")
    component = F.when(F.col("digest").isNull(), F.col(key)).otherwise(F.col("component_id"))
    return rows.select(key, "n_shingles", component.alias("component_id"), component.eqNullSafe(F.col(key)).alias("kept"))


def _classes(docs: DataFrame, key: str, text: str) -> tuple[DataFrame, DataFrame]:
    """(key, digest, n_shingles, bands) of every row, and (digest, lowest, component) of every text with words: its lowest
    key and its component."""
    every = common.written(signed(docs, key, text))
    named = every.where(F.col("digest").isNotNull())
    nodes = named.groupBy("digest").agg(F.min(key).alias("lowest"), F.first("bands").alias("bands"))
    nodes = common.written(nodes.withColumn("node", F.monotonically_increasing_id()))
    shared = _buckets(nodes.where(F.col("lowest").isNotNull()))
    wanted = nodes.select("node", "digest", "lowest").join(shared.select("node").distinct(), "node")
    sets = common.written(sets_of(docs, wanted, key, text))
    hubs = _with_hubs(shared)
    pairs = hubs.where(F.col("node") != F.col("hub")).select(F.col("node").alias("a"), F.col("hub").alias("b")).distinct()
    links = common.written(_confirmed(pairs, sets))
    parts = components(links)
    rest = common.written(_rest_links(shared, parts, sets))
    if not rest.isEmpty():
        parts = components(links.unionByName(rest))
    place = nodes.join(parts, "node", "left").withColumn("component", F.coalesce("component", "node"))
    return every, place.select("digest", "lowest", "component")


def native_digest(text: Column) -> Column:
    """``digest`` of a text's words as an expression; null without words."""
    words = F.btrim(F.regexp_replace(common.ascii_lower(text), r"[\x20\x09-\x0D]+", " "))
    return F.when(words != "", F.unhex(F.md5(words.cast("binary"))))


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of every component, with all its columns, and all rows without words, whatever their keys.

    The row with the lowest key stays. A row is told by its key and its text: of rows that share a key
    only those go whose text is another one's copy, and of rows without a key that share a text one stays. Of rows
    equal in key and text one stays, the same in every run.
    """
    every, place = _classes(docs, key, text)
    first = F.struct(F.col("lowest").isNull().alias("null"), "lowest", "digest")
    lead = place.groupBy("component").agg(F.min(first).alias("lead")).select(F.col("lead.digest").alias("_lead"), F.col("lead.lowest").alias("_lowest"))
    rows = every.where(F.col("digest").isNotNull()).groupBy(F.col("digest").alias("_digest"), F.col(key).alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    rows = rows.join(lead, (rows["_digest"] == lead["_lead"]) & rows["_key"].eqNullSafe(lead["_lowest"]), "left")
    stays = F.col("_lead").isNotNull()
    changed = common.written(rows.where(~stays | (F.col("_n") > 1)).select("_digest", "_key", stays.alias("_stays")))
    keys = changed.select(F.col("_key").alias("_changed")).distinct()
    on = F.col(key).eqNullSafe(F.col("_changed"))
    untouched = docs.join(keys, on, "left_anti")  # most rows: their texts need no second look
    touched = common.written(docs.join(keys, on, "left_semi"))
    same = lambda other: (native_digest(F.col(text)) == other["_digest"]) & F.col(key).eqNullSafe(other["_key"])
    alone = touched.join(changed, same(changed), "left_anti")
    again = changed.where("_stays").drop("_stays")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    copies = touched.join(again, same(again), "left_semi")
    one = copies.groupBy(native_digest(F.col(text)).alias("_digest")).agg(F.max_by(whole, F.md5(F.to_json(whole).cast("binary"))).alias("_row"))
    return untouched.unionByName(alone).unionByName(one.select("_row.*"))
