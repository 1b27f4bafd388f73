"""The network's gradient, its windows, and held-out accuracy on labelled documents."""

import zlib

import numpy as np
import pytest

from vocalis.llm import toxicity
from vocalis.llm.toxicity import Network, Vocabulary, laid_out, train, windows_of


def test_windows_cover_whole_texts():
    for n in [0, 1, 31, 32, 33, 47, 48, 49, 500, 1001]:
        starts = windows_of(n)
        covered = {i for s in starts for i in range(s, min(n, s + toxicity.WINDOW))}
        assert covered == set(range(n)) and len(starts) >= 1
        assert all(b - a == toxicity.STRIDE for a, b in zip(starts, starts[1:]))


def test_gradient_is_that_of_the_logits():
    rng = np.random.default_rng(0)
    net = Network()
    for name, weights in net.weights().items():
        setattr(net, name, weights.astype(np.float64) if name not in ("words", "chars") else weights)
    x = rng.standard_normal((5, 3, 2 * toxicity.G))
    live = np.array([[1, 1, 1], [1, 1, 1], [1, 1, 0], [1, 0, 0], [1, 0, 0]], np.float32)
    weight = rng.standard_normal(3)
    kept: dict = {}
    net.logits(x, live, kept)
    to_x, grads = net.gradient(weight, kept)
    loss = lambda: float(net.logits(x, live) @ weight)
    for array, grad in [(x, to_x), *((getattr(net, n), grads[n]) for n in ("forward", "backward", "attend", "query", "out", "shift"))]:
        for _ in range(6):
            at = tuple(rng.integers(0, n) for n in array.shape)
            old, step = array[at], 1e-2
            array[at] = old + step
            up = loss()
            array[at] = old - step
            down = loss()
            array[at] = old
            assert (up - down) / (2 * step) == pytest.approx(grad[at], abs=2e-2, rel=5e-2)


def test_windows_do_not_depend_on_neighbours():
    net, words = Network(), [b"a b c", b"", b"one two " * 40, b"x"]
    alone = [toxicity.Scorer(net).scores([w])[0] for w in words]
    assert toxicity.Scorer(net).scores(words) == pytest.approx(alone, abs=1e-6)
    vocabulary = Vocabulary()
    grid, firsts = laid_out([vocabulary.numbered(toxicity.words_of(w)) for w in words])
    assert grid.shape[1] == sum(len(windows_of(len(toxicity.words_of(w)))) for w in words) and len(firsts) == len(words)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    texts, marks = toxicity.training_rows(docs, labels)
    assert len(texts) <= 2 * toxicity.TRAIN_ROWS
    found = toxicity.scores(docs, train(texts, marks)).join(labels, "doc_id").where("held_out").collect()
    assert found and all(zlib.crc32(str(r.doc_id).encode()) % 4 == 2 for r in found)
    right = sum(r.predicted == r.toxic for r in found) / len(found)
    caught = sum(r.predicted for r in found if r.toxic) / sum(r.toxic for r in found)
    assert right >= 0.97 and caught >= 0.9
    assert all(0 <= r.score <= 1 for r in found)


def test_forms_of_a_stem_that_no_training_document_has():
    rng = np.random.default_rng(3)
    ending = lambda: "".join(rng.choice(list("abcdefghijklm"), 5))
    clean = lambda: [ending() for _ in range(20)]
    toxic = lambda: " ".join([*clean(), f"zorqu{ending()}", *clean()]).encode()
    texts = [" ".join(clean() + clean()).encode() for _ in range(120)] + [toxic() for _ in range(40)]
    network = train(texts, [0] * 120 + [1] * 40)
    assert network.stems[b"<zorqu"] == 1 and toxicity.features([b"ordinary"], {}, toxicity.Stems(network.stems))[3].tolist() == [0]
    found = toxicity.Scorer(network).scores([toxic() for _ in range(50)])
    assert np.mean(np.array(found) >= toxicity.THRESHOLD) >= 0.9
    other = toxicity.Scorer(network).scores([" ".join(clean() + clean()).encode() for _ in range(50)])
    assert np.mean(np.array(other) >= toxicity.THRESHOLD) <= 0.1


def test_features_are_those_of_each_word_alone():
    rng = np.random.default_rng(11)
    words = [b"a", b"ab", "naïveté".encode(), b"<>", b"x" * 3000] + [bytes(rng.integers(97, 103, rng.integers(1, 12)).tolist()) for _ in range(500)]
    stems = {s: float(x) for s, x in zip({s for w in words[::3] for s in toxicity.stems_of(w)}, rng.random(5000))}
    rows, runs, ends, leans = toxicity.features(words, {words[7]: 4}, toxicity.Stems(stems))
    begin = 0
    for word, row, end, lean in zip(words, rows, ends, leans):
        marked = b"<" + word + b">"
        assert runs[begin:end].tolist() == [zlib.crc32(marked[i : i + 3]) % toxicity.CHAR_ROWS for i in range(len(word))]
        assert row == (4 if word == words[7] else 0)
        assert lean == np.float32(max((stems.get(s, 0) for s in toxicity.stems_of(word)), default=0))
        begin = end


def test_forgetting_words_changes_no_score():
    rng = np.random.default_rng(4)
    texts = [b" ".join(b"w%d" % i for i in rng.integers(0, 3000, rng.integers(0, 200))) for _ in range(300)]
    net = Network()
    scorer = toxicity.Scorer(net, cache=100)
    assert [x for i in range(0, 300, 10) for x in scorer.scores(texts[i : i + 10])] == pytest.approx(toxicity.Scorer(net).scores(texts), abs=1e-6)
    assert len(scorer.vocabulary.numbers) == len(scorer.vocabulary.names) < 4000


def test_training_rows_are_bounded_by_rows_not_keys(spark):
    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)], "doc_id long, text string")
    texts, marks = toxicity.training_rows(docs, spark.createDataFrame([(1, 1)], "doc_id long, toxic int"), rows=20)
    assert len(texts) == 20 and marks == [1] * 20
