"""Token counts for a sentencepiece BPE vocabulary, by the whole-token shortcut.

No piece of the vocabulary has a space mark after another character, so no merge crosses the place where
a space follows a non-space: a text falls apart there into pre-tokens that are merged independently.
``whole_tokens`` proves offline, by encoding every vocabulary string alone, which pre-tokens are one token;
these are counted at once. Only the others are merged, by the library, once each while they stay in a
bounded cache.
"""

from __future__ import annotations

from functools import lru_cache
from itertools import islice

import sentencepiece
from pyspark.sql import DataFrame

from vocalis.llm import common

LIMIT = 4096
#: Pre-tokens remembered per worker beside the whole tokens; beyond that half of them are dropped.
CACHE = 400_000
MARK = "▁"


def split_rule_holds(model: sentencepiece.SentencePieceProcessor) -> bool:
    """No piece has a space mark, or a space, after another character; and spaces are neither joined nor dropped."""
    pieces = [model.id_to_piece(i) for i in range(model.get_piece_size()) if not model.is_control(i)]
    apart = not any(MARK in p.lstrip(MARK) or " " in p for p in pieces)
    probe = ["a  b", " a", "a ", "ééﬁ", "a　b"]
    same = all(model.decode(model.encode(t)) == t for t in probe)
    return apart and same and model.encode("  b") != model.encode("b")


@lru_cache(maxsize=4)
def load(path: str) -> tuple[sentencepiece.SentencePieceProcessor, frozenset[str], bool]:
    """The model, its whole tokens, and whether texts may be split at spaces. Computed once per worker."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return model, whole_tokens(model), split_rule_holds(model)


def whole_tokens(model: sentencepiece.SentencePieceProcessor) -> frozenset[str]:
    """Words that encode, each alone, as the one token ``mark + word``: proved by encoding each."""
    words = {p[1:] for p in map(model.id_to_piece, range(model.get_piece_size())) if p[0] == MARK and MARK not in p[1:] and len(p) > 1}
    words = sorted(words)
    return frozenset(w for w, ids in zip(words, model.encode(words, num_threads=1)) if len(ids) == 1)


class Counter:
    """Counts the tokens of whole texts as the library does, with no begin, end or added tokens."""

    def __init__(self, path: str):
        self.model, whole, self.split = load(path)
        self.whole = dict.fromkeys(whole, 1)
        self.known = dict(self.whole)

    def counts(self, texts: list[str]) -> list[int]:
        if not self.split:
            return list(map(len, self.model.encode(texts, num_threads=1)))
        if len(self.known) > CACHE + len(self.whole):  # words met first are the frequent ones
            self.known = dict(islice(self.known.items(), CACHE // 2 + len(self.whole)))
        known, parts = self.known, [self._pre_tokens(t) for t in texts]
        new = list({w for p in parts if p for w in p if w not in known})
        known.update(zip(new, map(len, self.model.encode(new, num_threads=1))))
        odd = {i: len(self.model.encode(texts[i])) for i, p in enumerate(parts) if p is None}
        return [odd[i] if p is None else sum(map(known.__getitem__, p)) for i, p in enumerate(parts)]

    @staticmethod
    def _pre_tokens(text: str) -> list[str] | None:
        """The words between single spaces; None where spaces stand together or at an end, or a mark or NUL occurs.

        The mark before a word is what the model puts before any text, so a word encoded alone is the pre-token.
        """
        parts = text.split(" ")
        return None if "" in parts or MARK in text or "\0" in text else parts


@lru_cache(maxsize=1)
def worker_counter(path: str) -> Counter:
    """The worker's counter, which keeps what it has learned from one task to the next."""
    return Counter(path)


def counts(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text", limit: int = LIMIT) -> DataFrame:
    """(key, n_bytes, n_tokens, over_limit), one row per row of ``docs``.

    ``model`` is the path of the vocabulary file on the workers. A null or empty text has no tokens.
    Repeated rows are counted each; an empty table gives no rows. Other columns are not read.
    """

    def make():
        counter = worker_counter(model)

        def measure(texts: list[bytes]) -> dict[str, list]:
            found = counter.counts([t.decode("utf-8", "replace") for t in texts])
            return {"n_bytes": list(map(len, texts)), "n_tokens": found, "over_limit": [n > limit for n in found]}

        return measure

    return common.per_text(docs, make, "n_bytes long, n_tokens long, over_limit boolean", key, text)
