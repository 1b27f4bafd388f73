"""Toxicity by a bidirectional gated recurrent network with attention pooling, in numpy.

A word's input is the sum of two embeddings: of its characters (hashed runs of three, with its ends marked)
and of the word itself, if enough training documents have it. Word embeddings start along one direction, as far
as the word's share of toxic training documents stands out. So that forms of a word that no training document has
are known by what they share, the word's strongest stem, a run of three to six characters that stands out in the same
way, is added along a learned direction. Two gated recurrent units read a window of words in both directions;
attention weighs their states into one vector, from which the window's score is taken. A text is cut into
overlapping windows over its whole length, all are scored, and the text's score is the highest one.

Training is on the driver, from a bounded number of labelled documents: a document's loss is that of its
highest window, with all windows scored anew in each round. Scoring runs on the executors.
"""

from __future__ import annotations

import pickle
import re
import zlib
from hashlib import sha256

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vocalis.llm import common

WINDOW, STRIDE = 32, 16
HIDDEN = 8
CHAR_ROWS = 1 << 13
#: Training documents that must have a word for it to get an embedding.
SEEN = 3
#: The same for stems; there are many more of them than words, and a few documents share many by chance.
STEM_SEEN, STEM_DOUBT, STEM_SURE = 8, 2.5, 5.0
#: Characters of a stem, with the word's ends marked.
STEM_CHARS = range(3, 7)
#: Decimal places of chance at which a word starts to lean, and leans in full.
DOUBT, SURE = 3.5, 7.0
THRESHOLD = 0.3
#: Labelled documents used for training, of either label; the smallest hashes of their keys are taken.
TRAIN_ROWS = 600
#: Updates in training, and documents in each; few documents go round more often.
STEPS, BATCH = 400, 16
SEED = 7
#: Embeddings learn this much slower than the rest, which has few weights and so generalises from few documents.
EMBEDDING_PACE = 0.3
#: Windows scored at once; bounds a worker's memory.
BLOCK_WINDOWS = 1024
CACHE = 100_000
#: What one byte adds to a checksum (zlib.crc32): the outer inversions taken back from the checksums of single bytes.
CRC = np.array([zlib.crc32(bytes([b ^ 0xFF])) ^ 0xFF000000 for b in range(256)], np.uint32)
WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
G = 3 * HIDDEN


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def words_of(data: bytes) -> list[bytes]:
    """Runs of digits, letters and bytes beyond ASCII, A-Z lower-cased."""
    return WORDS.findall(data.lower())


def stems_of(word: bytes) -> list[bytes]:
    """All runs of STEM_CHARS characters, which may cross the marked ends. Characters are bytes of UTF-8."""
    marked = b"<" + word + b">"
    return [marked[i : i + n] for n in STEM_CHARS for i in range(len(marked) - n + 1)]


class Stems:
    """Leans of stems, found for all runs of many words at once: a stem is the number of its bytes, kept in order by length."""

    def __init__(self, leans: dict[bytes, float]):
        self.tables = []
        for n in STEM_CHARS:
            own = sorted((int.from_bytes(s, "big"), x) for s, x in leans.items() if len(s) == n)
            if own:
                self.tables.append((n, np.array([k for k, _ in own], np.uint64), np.array([x for _, x in own], np.float32)))

    def strongest(self, data: np.ndarray, starts: np.ndarray, room: np.ndarray) -> np.ndarray:
        """Per word the highest lean among its stems, 0 without any; ``room`` is how many bytes of the word stand from each byte on."""
        best = np.zeros(len(data), np.float32)
        for n, keys, leans in self.tables:
            ends = max(len(data) - n + 1, 0)
            runs = np.zeros(ends, np.uint64)
            for i in range(n):
                runs = (runs << np.uint64(8)) | data[i : ends + i].astype(np.uint64)
            at = np.minimum(np.searchsorted(keys, runs), len(keys) - 1)
            hit = (keys[at] == runs) & (room[:ends] >= n)
            best[:ends][hit] = np.maximum(best[:ends][hit], leans[at[hit]])
        return np.maximum.reduceat(best, starts)


def features(words: list[bytes], known: dict[bytes, int], stems: Stems) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For a network's ``gate_inputs``: the row of every word, the rows of its runs of three characters (with its ends
    marked), where each word's runs end, and its strongest lean. All words are worked on as one array of bytes."""
    if not words:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.float32)
    data = np.frombuffer(b"<" + b"><".join(words) + b">", np.uint8)
    sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
    ends = np.cumsum(sizes)
    starts = ends - sizes
    room = np.repeat(ends, sizes) - np.arange(len(data))
    sums = np.full(len(data) - 2, 0xFFFFFFFF, np.uint32)
    for i in range(3):
        sums = CRC[(sums ^ data[i : len(data) - 2 + i]) & 0xFF] ^ (sums >> np.uint32(8))
    char_rows = ((sums ^ np.uint32(0xFFFFFFFF)) % np.uint32(CHAR_ROWS)).astype(np.int64)[room[:-2] >= 3]
    word_rows = np.fromiter((known.get(w, 0) for w in words), np.int64, len(words))
    return word_rows, char_rows, np.cumsum(sizes - 2), stems.strongest(data, starts, room)


def windows_of(n_words: int) -> list[int]:
    """Starts of windows that cover all words; neighbours overlap by half. A text without words has one empty window."""
    return list(range(0, max(1, n_words - STRIDE), STRIDE)) if n_words > WINDOW else [0]


class Network:
    """Weights, the forward pass and its gradient. Inputs are gate inputs of both directions per word."""

    NAMES = ("words", "chars", "stem", "bias", "forward", "backward", "attend", "query", "out", "shift")

    def __init__(self, seed: int = SEED):
        rng = np.random.default_rng(seed)
        small = lambda *shape: (rng.standard_normal(shape) * 0.15).astype(np.float32)
        self.known: dict[bytes, int] = {}  # rows of words; row 0 stands for all others
        self.words, self.chars = np.zeros((1, 2 * G), np.float32), small(CHAR_ROWS, 2 * G) * 0.5
        self.toxic_way = small(2 * G) * 18
        self.stems: dict[bytes, float] = {}  # how far stems lean to toxic documents
        self.stem = self.toxic_way.copy()
        self.bias = np.zeros(2 * G, np.float32)
        self.forward, self.backward = small(HIDDEN, G) * 2, small(HIDDEN, G) * 2
        self.attend, self.query = small(2 * HIDDEN, HIDDEN) * 2, small(HIDDEN) * 4
        self.out, self.shift = small(2 * HIDDEN) * 4, np.full(1, -2, np.float32)

    def weights(self) -> dict[str, np.ndarray]:
        return {n: getattr(self, n) for n in self.NAMES}

    def know(self, words: list[bytes], lean: np.ndarray) -> None:
        """Gives words rows, which start along the toxic direction as far as they lean to it."""
        self.known = {w: i + 1 for i, w in enumerate(words)}
        self.words = np.concatenate([np.zeros((1, 2 * G)), lean[:, None] * self.toxic_way]).astype(np.float32)

    def load(self, known: dict[bytes, int], stems: dict[bytes, float], weights: dict[str, np.ndarray]) -> Network:
        self.known, self.stems = known, stems
        for name, value in weights.items():
            setattr(self, name, value)
        return self

    def gate_inputs(self, word_rows: np.ndarray, char_rows: np.ndarray, char_ends: np.ndarray, leans: np.ndarray) -> np.ndarray:
        """One row per word: bias, the word's row, the mean of its characters' rows and the weight of its stem."""
        if not len(word_rows):
            return np.empty((0, 2 * G), np.float32)
        starts = np.concatenate([[0], char_ends[:-1]])
        sums = np.add.reduceat(self.chars[char_rows], starts, axis=0)
        return self.bias + self.words[word_rows] + sums / (char_ends - starts)[:, None].astype(np.float32) + leans[:, None] * self.stem

    @staticmethod
    def _unit(x: np.ndarray, live: np.ndarray, weights: np.ndarray, keep: list | None) -> np.ndarray:
        """States after every step, (steps, windows, hidden); where no word is, the state stays."""
        h = np.zeros((x.shape[1], HIDDEN), np.float32)
        states = np.empty((x.shape[0], x.shape[1], HIDDEN), np.float32)
        to_gates, to_new = np.ascontiguousarray(weights[:, : 2 * HIDDEN]), np.ascontiguousarray(weights[:, 2 * HIDDEN :])
        full = live.all(axis=1)
        for t in range(x.shape[0]):
            gates = h @ to_gates
            gates += x[t, :, : 2 * HIDDEN]
            gates *= 0.5
            np.tanh(gates, out=gates)
            gates += 1
            gates *= 0.5
            reset, update = gates[:, :HIDDEN], gates[:, HIDDEN:]
            new = (reset * h) @ to_new
            new += x[t, :, 2 * HIDDEN :]
            np.tanh(new, out=new)
            mix = update if full[t] else update * live[t][:, None]
            if keep is not None:
                keep.append((h, reset, update, new, mix))
            h = np.add(h, mix * (new - h), out=states[t])
        return states

    def logits(self, x: np.ndarray, live: np.ndarray, keep: dict | None = None) -> np.ndarray:
        """One logit per window from (steps, windows, both gates) and where words are, (steps, windows)."""
        ahead, back = ([], []) if keep is not None else (None, None)
        f = self._unit(x[:, :, :G], live, self.forward, ahead)
        b = self._unit(x[::-1, :, G:], live[::-1], self.backward, back)[::-1]
        both = np.concatenate([f, b], axis=2)
        hidden = np.tanh(both @ self.attend)
        weights = np.where(live > 0, hidden @ self.query, -1e9)
        weights = np.exp(weights - weights.max(axis=0)) * (live > 0)
        weights = weights / np.maximum(weights.sum(axis=0), 1e-9)
        pooled = np.einsum("tb,tbh->bh", weights, both)
        if keep is not None:
            keep.update(ahead=ahead, back=back, both=both, hidden=hidden, weights=weights, pooled=pooled, live=live)
        return pooled @ self.out + self.shift[0]

    @staticmethod
    def _unit_gradient(grads: np.ndarray, kept: list, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Gradients of the gate inputs and of the recurrent weights from those of the states."""
        to_x, to_w = np.zeros((*grads.shape[:2], G), np.float32), np.zeros_like(weights)
        carry = np.zeros(grads.shape[1:], np.float32)
        for t in range(grads.shape[0] - 1, -1, -1):
            h, reset, update, new, mix = kept[t]
            total = grads[t] + carry
            on = mix / np.maximum(update, 1e-9)
            to_new = total * mix * (1 - new**2)
            to_update = total * (new - h) * on * update * (1 - update)
            through = to_new @ weights[:, 2 * HIDDEN :].T
            to_reset = through * h * reset * (1 - reset)
            to_gates = np.concatenate([to_reset, to_update], axis=1)
            to_x[t] = np.concatenate([to_gates, to_new], axis=1)
            to_w[:, : 2 * HIDDEN] += h.T @ to_gates
            to_w[:, 2 * HIDDEN :] += (reset * h).T @ to_new
            carry = total * (1 - mix) + through * reset + to_gates @ weights[:, : 2 * HIDDEN].T
        return to_x, to_w

    def gradient(self, to_logit: np.ndarray, kept: dict) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Gradients of the gate inputs, and of the weights but the embeddings."""
        both, weights, hidden = kept["both"], kept["weights"], kept["hidden"]
        found = {"out": kept["pooled"].T @ to_logit, "shift": np.array([to_logit.sum()], np.float32)}
        to_pooled = to_logit[:, None] * self.out
        to_both = weights[:, :, None] * to_pooled
        to_weights = np.einsum("tbh,bh->tb", both, to_pooled)
        to_scores = weights * (to_weights - (weights * to_weights).sum(axis=0))
        found["query"] = np.einsum("tb,tbh->h", to_scores, hidden)
        to_hidden = to_scores[:, :, None] * self.query * (1 - hidden**2)
        found["attend"] = np.einsum("tbi,tbj->ij", both, to_hidden)
        to_both = to_both + to_hidden @ self.attend.T
        ahead, found["forward"] = self._unit_gradient(to_both[:, :, :HIDDEN], kept["ahead"], self.forward)
        back, found["backward"] = self._unit_gradient(to_both[::-1, :, HIDDEN:], kept["back"], self.backward)
        return np.concatenate([ahead, back[::-1]], axis=2), found


class Vocabulary:
    """Numbers for words."""

    def __init__(self):
        self.numbers: dict[bytes, int] = {}
        self.names: list[bytes] = []

    def numbered(self, words: list[bytes]) -> np.ndarray:
        numbers = self.numbers
        got = list(map(numbers.get, words))
        if None in got:
            for word in dict.fromkeys(w for w, g in zip(words, got) if g is None):
                numbers[word] = len(numbers)
                self.names.append(word)
            got = list(map(numbers.__getitem__, words))
        return np.array(got, np.int64)

    def keep(self, chosen: np.ndarray) -> None:
        """Only these numbers stay, counted anew in their order."""
        self.names = [self.names[i] for i in chosen]
        self.numbers = {name: i for i, name in enumerate(self.names)}


def laid_out(numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(steps, windows) of word numbers, -1 where none is, and the first window of every text."""
    firsts, starts, ends, base, rows = [], [], [], 0, 0
    for text in numbers:
        own = windows_of(len(text))
        firsts.append(rows)
        rows += len(own)
        starts += [base + s for s in own]
        ends += [base + len(text)] * len(own)
        base += len(text)
    flat = np.concatenate([*numbers, np.empty(0, np.int64)])
    at = np.arange(WINDOW)[:, None] + np.array(starts, np.int64)
    inside = at < np.array(ends, np.int64)
    return np.where(inside, flat[np.minimum(at, max(len(flat) - 1, 0))] if len(flat) else -1, -1), np.array(firsts, np.int64)


class Scorer:
    """Scores whole texts with a trained network. The inputs of words are kept; of too many, the more frequent half."""

    def __init__(self, network: Network, cache: int = CACHE):
        self.network, self.stems, self.cache = network, Stems(network.stems), cache
        self.vocabulary, self.worked_out = Vocabulary(), 0
        self.inputs, self.seen = np.empty((1024, 2 * G), np.float32), np.zeros(1024, np.int64)

    def _forget(self) -> None:
        chosen = np.sort(np.argsort(-self.seen[: self.worked_out], kind="stable")[: self.cache // 2])
        self.vocabulary.keep(chosen)
        self.inputs[: len(chosen)], self.seen[: len(chosen)] = self.inputs[chosen], self.seen[chosen] // 2
        self.seen[len(chosen) :] = 0
        self.worked_out = len(chosen)

    def _work_out(self) -> None:
        """The inputs of the words that are new, in a buffer that doubles."""
        fresh = self.vocabulary.names[self.worked_out :]
        if not fresh:
            return
        size = self.worked_out + len(fresh)
        if size > len(self.inputs):
            room = max(size, 2 * len(self.inputs)) - len(self.inputs)
            self.inputs = np.concatenate([self.inputs, np.empty((room, 2 * G), np.float32)])
            self.seen = np.concatenate([self.seen, np.zeros(room, np.int64)])
        self.inputs[self.worked_out : size] = self.network.gate_inputs(*features(fresh, self.network.known, self.stems))
        self.worked_out = size

    def scores(self, texts: list[bytes]) -> list[float]:
        if len(self.vocabulary.numbers) > self.cache:
            self._forget()
        done, out = 0, []
        while done < len(texts):
            part, windows = [], 0
            while done < len(texts) and (not part or windows < BLOCK_WINDOWS):
                part.append(self.vocabulary.numbered(words_of(texts[done])))
                windows += len(windows_of(len(part[-1])))
                done += 1
            out += self._block(part)
        return out

    def _block(self, numbers: list[np.ndarray]) -> list[float]:
        self._work_out()
        for text in numbers:
            self.seen[text] += 1  # texts that hold the word, as far as the block goes
        grid, firsts = laid_out(numbers)
        logits = np.empty(grid.shape[1], np.float32)
        for at in range(0, grid.shape[1], BLOCK_WINDOWS):
            block = grid[:, at : at + BLOCK_WINDOWS]
            x = self.inputs[np.maximum(block, 0)]
            logits[at : at + BLOCK_WINDOWS] = self.network.logits(x, (block >= 0).astype(np.float32))
        return _sigmoid(np.maximum.reduceat(logits, firsts).astype(np.float64)).tolist()


def _summed(rows: np.ndarray, grads: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows that occur, and the sum of the gradients of each."""
    order = np.argsort(rows, kind="stable")
    own, begins = np.unique(rows[order], return_index=True)
    return own, np.add.reduceat(grads[order], begins, axis=0)


def leaning(numbers: list[np.ndarray], marks: np.ndarray, size: int, seen_by: int = SEEN, doubt: float = DOUBT, sure: float = SURE) -> tuple[np.ndarray, np.ndarray]:
    """The words that enough documents have, and how far each leans to toxic ones, from -1 to 1.

    A word leans as far as its share of toxic documents is unlikely by chance, on a scale of decimal places
    (Chernoff's bound) between ``doubt``, which some words reach among thousands, and ``sure``.
    """
    seen = np.zeros((2, size))
    for text, mark in zip(numbers, marks):
        seen[int(mark), np.unique(text)] += 1
    chosen = np.flatnonzero(seen.sum(axis=0) >= seen_by)
    clean, toxic = seen[:, chosen]
    share, usual = toxic / np.maximum(clean + toxic, 1), np.clip(marks.mean() if len(marks) else 0.5, 0.01, 0.99)
    apart = share * np.log(np.maximum(share, 1e-9) / usual) + (1 - share) * np.log(np.maximum(1 - share, 1e-9) / (1 - usual))
    places = (clean + toxic) * apart / np.log(10)
    return chosen, np.sign(share - usual) * np.clip((places - doubt) / (sure - doubt), 0, 1)


def leaning_stems(names: list[bytes], numbers: list[np.ndarray], marks: np.ndarray) -> dict[bytes, float]:
    """The stems that lean to toxic documents, and how far."""
    stems: dict[bytes, int] = {}
    own = [np.array([stems.setdefault(s, len(stems)) for s in stems_of(name)], np.int64) for name in names]
    held = [np.concatenate([np.empty(0, np.int64), *(own[i] for i in np.unique(text))]) for text in numbers]
    chosen, lean = leaning(held, marks, len(stems), STEM_SEEN, STEM_DOUBT, STEM_SURE)
    listed = list(stems)
    return {listed[i]: float(x) for i, x in zip(chosen, lean) if x > 0}


def train(texts: list[bytes], labels: list[int], steps: int = STEPS, seed: int = SEED, batch: int = BATCH, rate: float = 0.02) -> Network:
    """Fits the network by Adam; each document counts through its highest window."""
    network, vocabulary, rng = Network(seed), Vocabulary(), np.random.default_rng(seed)
    numbers = [vocabulary.numbered(words_of(t)) for t in texts]
    names = vocabulary.names
    chosen, lean = leaning(numbers, np.array(labels, np.float64), len(names))
    network.stems = leaning_stems(names, numbers, np.array(labels, np.float64))
    _, char_rows, char_ends, leans = features(names, {}, Stems(network.stems))
    network.know([names[i] for i in chosen], lean)
    word_rows = np.zeros(len(names), np.int64)
    word_rows[chosen] = np.arange(1, len(chosen) + 1)
    begins = np.concatenate([[0], char_ends[:-1]]) if len(char_ends) else np.empty(0, np.int64)
    marks = np.array(labels, np.float32)
    first = {n: np.zeros_like(w) for n, w in network.weights().items()}
    second = {n: np.zeros_like(w) for n, w in network.weights().items()}
    step = 0
    for _ in range(-(-steps * batch // len(texts)) if texts else 0):
        order = rng.permutation(len(texts))
        for at in range(0, len(order), batch):
            chosen = order[at : at + batch]
            grid, firsts = laid_out([numbers[i] for i in chosen])
            used = np.unique(grid[grid >= 0])
            if not len(used):
                continue
            local = np.searchsorted(used, np.maximum(grid, used[0]))
            runs = [char_rows[begins[w] : char_ends[w]] for w in used]
            ends = np.cumsum([len(r) for r in runs])
            flat_runs = np.concatenate(runs)
            inputs = network.gate_inputs(word_rows[used], flat_runs, ends, leans[used])
            live = (grid >= 0).astype(np.float32)
            logits = network.logits(inputs[local], live)
            bounds = [*firsts.tolist(), grid.shape[1]]
            best = np.array([s + int(np.argmax(logits[s:e])) for s, e in zip(bounds, bounds[1:])])
            kept: dict = {}
            top = network.logits(inputs[local[:, best]], live[:, best], kept)
            error = ((_sigmoid(top) - marks[chosen]) / len(chosen)).astype(np.float32)
            to_x, grads = network.gradient(error, kept)
            to_words = np.zeros_like(inputs)
            spots = live[:, best] > 0
            np.add.at(to_words, local[:, best][spots], to_x[spots])
            grads["bias"], grads["stem"] = to_words.sum(axis=0), leans[used] @ to_words
            counts = np.diff(np.concatenate([[0], ends]))
            per_run = np.repeat(to_words / counts[:, None].astype(np.float32), counts, axis=0)
            touched = {"words": _summed(word_rows[used], to_words), "chars": _summed(flat_runs, per_run)}
            touched["words"][1][touched["words"][0] == 0] = 0  # the row of other words stays empty
            touched |= {name: (slice(None), grad) for name, grad in grads.items()}
            step += 1
            slower = max(0.0, 1 - step / (steps + 1))  # to rest at the end
            scale = rate * slower * np.sqrt(1 - 0.99**step) / (1 - 0.9**step)
            for name, weights in network.weights().items():
                rows, grad = touched[name]  # of an embedding, only the rows that occur move
                first[name][rows] += 0.1 * (grad - first[name][rows])
                second[name][rows] += 0.01 * (grad**2 - second[name][rows])
                pace = scale * (EMBEDDING_PACE if name in ("words", "chars") else 1)
                weights[rows] -= (pace * first[name][rows] / (np.sqrt(second[name][rows]) + 1e-7)).astype(np.float32)
    return network


def held_out(key: str = "doc_id"):
    """Rows whose labels are never learned from."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, key: str = "doc_id", text: str = "text") -> tuple[list[bytes], list[int]]:
    """Texts and marks of at most ``rows`` documents of either label, none of them held out.

    The bound is on the fit alone: the smallest hashes of the labelled keys are taken, whatever the size of the table.
    """
    marked = labels.where(~held_out(key) & F.col("toxic").isin(0, 1)).select(F.col(key).alias("_key"), F.col("toxic").cast("int").alias("toxic"))
    chosen = [marked.where(F.col("toxic") == mark).orderBy(F.xxhash64("_key"), "_key").limit(rows) for mark in (0, 1)]
    picked = chosen[0].unionByName(chosen[1])
    texts = docs.select(F.col(key).alias("_key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    found = common.written(texts.join(F.broadcast(picked), "_key").select("_key", "toxic", "text"))
    order = [F.xxhash64("_key"), "_key", F.md5("text")]  # keys may repeat
    found = [r for mark in (0, 1) for r in found.where(F.col("toxic") == mark).orderBy(*order).limit(rows).collect()]
    found = sorted(found, key=lambda r: (r["_key"], r["toxic"], bytes(r["text"])))
    return [bytes(r["text"]) for r in found], [r["toxic"] for r in found]


#: The scorers of this worker by their networks' fingerprints: a task finds the words of the tasks before it worked out.
_scorers: dict[bytes, Scorer] = {}


def scorer_of(fingerprint: bytes, known: dict[bytes, int], stems: dict[bytes, float], weights: dict[str, np.ndarray]) -> Scorer:
    if fingerprint not in _scorers:
        _scorers.clear()  # one network at a time
        _scorers[fingerprint] = Scorer(Network().load(known, stems, weights))
    return _scorers[fingerprint]


def scores(docs: DataFrame, network: Network, threshold: float = THRESHOLD, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted), one row per row of ``docs``; whole texts, all their windows.

    A null or empty text is one empty window and gets the network's score of nothing. Repeated rows get equal
    scores; an empty table gives no rows. A null key is not held out. Other columns are not read.
    """
    known, stems, weights = network.known, network.stems, network.weights()
    fingerprint = sha256(pickle.dumps((known, stems, weights))).digest()

    def make():
        scorer = scorer_of(fingerprint, known, stems, weights)

        def score(texts: list[bytes]) -> dict[str, list]:
            return {"score": scorer.scores(texts)}

        return score

    found = common.per_text(docs, make, "score double", key, text)
    return found.select(key, held_out(key).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
