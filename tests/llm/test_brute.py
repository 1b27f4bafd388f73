"""Operators that SQL cannot express, or not with its own means, against plain versions."""

import random
import re
import zlib
from collections import defaultdict
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import zstandard
from llm import brute
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from vocalis.llm import catalog, decontaminate, license_rules, licenses, near_dups, pii, sharding, token_counts, token_files
from vocalis.llm.components import components
from vocalis.session import workspace

SP, BPE = public_tokenizers.path("piece_bpe_32k.model"), public_tokenizers.path("byte_bpe_50k.json")
PIECES = [" ", "  ", "\n", "\t", "a", "B", "'s", "é", "1", "\x1c", "\x85", "　", ".", "😀", "▁", "<|endoftext|>", "​", "\r", "the", " of", "\0"]


@pytest.fixture(scope="module")
def texts(documents):
    return {r.doc_id: r.text for r in documents.collect()}


def odd_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 14))) for _ in range(n)]


def test_license_base(spark, sf_dir, texts):
    found = {r.doc_id: r for r in catalog.op1_license_scans(spark, sf_dir).collect()}
    assert found.keys() == texts.keys()
    for key, text in texts.items():
        r = found[key]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == brute.licenses(text)
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
    assert any(r.n_base for r in found.values())


def test_license_rules():
    assert sum(len(rules) for _, rules in licenses.blocks()) >= 200
    labels = lambda t: [h.label for h in licenses.scan_text(t.encode())[2]]
    assert labels("SPDX-License-Identifier: MIT") == ["mit"]
    assert labels("Licensed under the Apache License, Version 2.0 (the") == ["apache", "apache-2.0"]
    assert labels("https://creativecommons.org/licenses/by-nc-sa/4.0/") == ["cc-by-nc-sa-4.0"]
    assert labels("the mitigation of commits") == []
    for _, rules in licenses.blocks(license_rules.TABLE):
        assert all(1 <= r.priority <= 100 for r in rules)


def test_keywords_never_hide_a_match():
    """No rule matches without its block's keyword: not by its text, and not on pages."""
    for keyword, rules in licenses.blocks():
        for rule in rules:
            needed = re.sub(rb"\(\?:[^()]*\)\?", b"", rule.pattern.pattern)
            assert keyword in needed, (keyword, rule)
    pages = ["SPDX-License-Identifier: GPL-3.0-or-later", "under the GNU Lesser General Public License v2.1", "see www.gnu.org/licenses/gpl-3.0.html",
             "This is free and unencumbered software released into the public domain.", "CC BY-SA 4.0, all rights reserved", "Creative Commons Zero"]
    for page in pages:
        joined = b" ".join(licenses.words_of(page.encode()))
        every = [h for _, rules in licenses.blocks() for r in rules for h in licenses._places(r, joined)]
        hidden = set(every) - set(licenses.rule_hits(joined))
        assert not hidden, (page, hidden)


def test_suppression():
    h = licenses.Hit
    hits = [h(0, 9, "weak", 10), h(2, 4, "in", 5), h(3, 5, "strong", 90), h(3, 5, "same", 90), h(3, 4, "inside", 80), h(8, 12, "over", 10)]
    assert [x.label for x in licenses.unsuppressed(hits)] == ["weak", "strong", "over"]


def test_contamination_of_short_and_repeated_items(spark):
    rng = random.Random(5)
    word = lambda: rng.choice(["a", "b", "c", "É", "é"])
    docs = [(i, " ".join(word() for _ in range(rng.randint(0, 60)))) for i in range(80)]
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 5, 12, 13, 14, 20])))) for i in range(12)] + [(3, "a")]
    got = {r.doc_id: r for r in decontaminate.report(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()}
    for key, text in docs:
        assert tuple(got[key])[1:] == brute.contamination(text, items)


def test_large_word_lists_take_the_other_join(spark, documents, sf_dir, monkeypatch):
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    one = sorted(map(tuple, decontaminate.report(documents, items).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_WORDS", 0)
    assert sorted(map(tuple, decontaminate.report(documents, items).collect())) == one


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "x red blue green y"), (2, "green x red x blue"), (3, "red only")], "doc_id long, text string")
    found = decontaminate.windows(spark.createDataFrame([(1, "red blue green")], "item_id long, text string"))
    led = decontaminate.phrases(docs, found)
    near = decontaminate.index(docs, led, reach=3)
    assert {r.key for r in decontaminate.phrase_matches(near, led).collect()} == {1}
    assert {r.key for r in decontaminate.proximity_matches(near, led, 0).collect()} == {1, 2}
    assert {(r.key, r.missing) for r in decontaminate.proximity_matches(near, led, 2).collect()} >= {(1, 0), (2, 0)}


def test_token_counts(spark, sf_dir, texts):
    model = sentencepiece.SentencePieceProcessor(model_file=SP)
    for r in catalog.op3_token_counts(spark, sf_dir).collect():
        assert r.n_tokens == len(model.encode(texts[r.doc_id])) and r.n_bytes == len(texts[r.doc_id].encode())
        assert r.over_limit == (r.n_tokens > 4096)


def test_token_counts_of_odd_texts():
    counter, odd = token_counts.Counter(SP), odd_texts(3000)
    assert counter.split and len(counter.whole) > 10_000
    assert counter.counts(odd) == list(map(len, counter.model.encode(odd)))
    counter.split = False
    assert counter.counts(odd[:50]) == list(map(len, counter.model.encode(odd[:50])))


def edited(words, edits, rng):
    words = list(words)
    for at in rng.sample(range(len(words)), edits):
        words[at] = f"w{rng.randrange(10**9)}"
    return " ".join(words)


def test_near_duplicates_around_the_threshold(spark):
    """A cloud of copies with edits, a chain, exact copies and short texts; links are all there and no others."""
    rng = random.Random(11)
    base = [f"b{rng.randrange(400)}" for _ in range(150)]
    texts = [edited(base, rng.choice([0, 1, 2, 2, 3]), rng) for _ in range(70)]
    chain = [f"c{i}" for i in range(120)]
    for _ in range(25):
        chain = edited(chain, 1, rng).split()
        texts.append(" ".join(chain))
    texts += ["Same  TEXT here\nnow and then", "same text here now and then"] * 3 + ["short one", "SHORT one", "", " "]
    texts += [" ".join(f"u{rng.randrange(10**6)}" for _ in range(60)) for _ in range(20)]
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dups.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.groups(rows)


def test_blocks_find_what_hubs_miss(spark, monkeypatch):
    """With useless hubs, everything is left to the blocks, cut small: the result is the same."""
    rng = random.Random(2)
    base = [f"b{i}" for i in range(80)]
    rows = [(i, edited(base, rng.choice([0, 1, 1, 2]), rng)) for i in range(40)]
    monkeypatch.setattr(near_dups, "_with_hubs", lambda shared: shared.select("bucket", "node", F.col("node").alias("hub")))
    monkeypatch.setattr(near_dups, "BLOCK_SHINGLES", 300)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_dups.groups(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == brute.groups(rows)


def test_signature_is_circulant_minhash():
    codes = np.arange(50, dtype=np.uint64) * np.uint64(7919)
    order = np.random.default_rng(near_dups.SEED).permutation(near_dups.CIRCLE)
    places = near_dups._first(codes)
    for k in (0, 1, 17, 191):
        assert near_dups.signature(codes)[k] == min(order[(p + k) % near_dups.CIRCLE] for p in places)


def test_components(spark):
    rng = random.Random(4)
    links = [(i, i + 1) for i in range(60)] + [(200 + rng.randrange(40), 200 + rng.randrange(40)) for _ in range(25)] + [(500, i) for i in range(501, 540)]
    label = {n: n for pair in links for n in pair}
    for _ in label:
        for a, b in links:
            label[a] = label[b] = min(label[a], label[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {n: c for n, c in label.items() if n in got} and all(label[n] == n for n in set(label) - set(got))


def test_personal_data(spark, sf_dir, texts):
    extra = {-1: "a@b.c%d@e.f 1.2.3.4.5.6.7.8 999.1.1.1 001.2.3.255 x@y@z.com a@b..c", -2: "4111 1111-1111 1111 +1 (269) 555-5822 +1((( 😀 é me@x.org",
             -3: "pay to IBAN GB82 WEST 1234 5698 7654 32 or GB82 WEST 1234 5698 7654 33, ssn 078-05-1120, code 078-05-1120"}
    docs = spark.createDataFrame([*texts.items(), *extra.items()], "doc_id long, text string")
    for r in pii.summary(pii.detect(docs)).collect():
        expected = brute.personal({**texts, **extra}[r.doc_id])
        listed = ",".join(f"{k}:{s}:{e}" for k, s, e in expected)
        base = [x for x in r.spans.split(",") if x and x.split(":")[0] in ("email", "ip", "card", "phone")]
        assert ",".join(base) == listed and r.base_sha256 == sha256(listed.encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for k, _, _ in expected) for n in ("email", "ip", "card", "phone")]
        if r.doc_id == -3:
            assert [x.split(":")[0] for x in r.spans.split(",")].count("iban") == 1
            assert [x.split(":")[0] for x in r.spans.split(",")].count("ssn") == 2  # both have the word near them


def test_shards_and_their_map(spark, sf_dir, texts):
    rows = catalog.op9_sharding(spark, sf_dir).collect()
    assert {r.doc_id: (r.size, r.text_crc32) for r in rows} == {k: (len(t.encode()) + 1, brute.crc(t)) for k, t in texts.items()}
    places, held = defaultdict(list), defaultdict(int)
    for r in rows:
        places[r.shard].append(r.slot)
        held[r.shard] += r.size
    assert all(sorted(p) == list(range(len(p))) for p in places.values()) and set(places) <= set(range(16))
    biggest = max(r.size for r in rows)
    assert max(held.values()) - min(held.values()) <= biggest
    again = catalog.op9_sharding(spark, sf_dir).collect()
    assert sorted(map(tuple, again)) == sorted(map(tuple, rows)) or {(r.doc_id, r.shard) for r in again} == {(r.doc_id, r.shard) for r in rows}


def test_rebalancing_edits_the_map(spark, documents, tmp_path):
    sizes = sharding.slot_bytes(sharding.sized(documents))
    one = sharding.first_map(sizes, 4)
    two = sharding.edited_map(sizes, one, 5)
    assert {n for o, n in zip(one, two) if o != n} == {4}  # rows move into the new shard only
    path = str(tmp_path / "maps")
    sharding.store_map(spark, one, path, 1)
    sharding.store_map(spark, two, path, 2)
    assert sharding.load_map(spark, path, 1) == one and sharding.load_map(spark, path) == two


def test_token_files(spark, sf_dir, texts):
    tokenizer, start = Tokenizer.from_file(BPE), 0
    found = {r.doc_id: r for r in catalog.op10_token_files(spark, sf_dir).collect()}
    assert found.keys() == texts.keys()
    for key in sorted(texts):
        ids = [*tokenizer.encode(texts[key], add_special_tokens=False).ids, 0]
        assert (found[key].start, found[key].n_tokens) == (start, len(ids))
        assert found[key].ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_encoder_on_odd_texts():
    encoder, odd = token_files.Encoder(BPE), odd_texts(3000)
    for at in range(0, len(odd), 100):
        assert encoder.encode(odd[at : at + 100]) == [encoder._whole(t) for t in odd[at : at + 100]]


def test_file_format(spark, documents, texts):
    folder = workspace(spark)
    manifest = token_files.write(documents, folder, BPE)
    rows = token_files.read_back(manifest, folder).collect()
    wanted = spark.createDataFrame([(r.file, r.frame) for r in rows[:7]], "file string, frame long")
    got = {(r.file, r.frame): r.ids for r in token_files.fetch(manifest, folder, wanted).collect()}
    tokenizer = Tokenizer.from_file(BPE)
    for r in rows[:7]:
        assert got[r.file, r.frame] == [*tokenizer.encode(texts[r.key], add_special_tokens=False).ids, 0]
    store, base = token_files._open(folder)
    name = manifest.head().file
    data = store.open_input_file(f"{base}/{name}").read()
    stream = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    reader = token_files.Reader(store.open_input_file(f"{base}/{name}"))
    assert stream == b"".join(reader.ids(i).tobytes() for i in range(len(reader)))
    broken = bytearray(data)
    broken[int(reader.starts[1]) - 1] ^= 0xFF
    with store.open_output_stream(f"{base}/broken") as out:
        out.write(bytes(broken))
    damaged = token_files.Reader(store.open_input_file(f"{base}/broken"))
    with pytest.raises(Exception):
        damaged.ids(0)
    assert len(damaged.ids(1)) == len(reader.ids(1))  # frames are independent
    # a file that no committed task wrote is not read
    assert token_files.read_back(manifest, folder).count() == len(texts)


def test_encoder_does_not_keep_long_chunks():
    encoder, long = token_files.Encoder(BPE), "語" * 500
    texts = [long, f"a {long} b", f"{long} {long}", "a b"]
    found = encoder.encode(texts)
    plain = token_files.load(BPE)[0]
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert max(map(len, [*encoder.after_space, *encoder.other])) <= token_files.LONG
