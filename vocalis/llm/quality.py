"""Quality rules as a short-circuit cascade.

Rules reject a text; a text is kept if no rule rejects it, so their order never changes a verdict, only
the time it takes. On a sample of whole texts every rule's cost and selectivity are measured, and rules run in
the order of rejections per cost: once a rule rejects, the others are not evaluated. The sample orders the
rules; every whole text of the table goes through them.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterable
from functools import cached_property
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from vocalis.llm import common

SYMBOLS = b"#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
#: Rows expected in the sample that orders the rules, from all parts of the table; more give steadier estimates, not other verdicts.
SAMPLE_ROWS, SAMPLE_SEED = 512, 7
ESTIMATES = "rule string, texts long, seconds double, rejected long"
#: Odd multiplier of the window hash.
FACTOR = np.uint64(0x9E3779B97F4A7C15)


class Text:
    """A text's measures, each computed when first asked for. Words are runs of anything but ASCII white space."""

    def __init__(self, data: bytes):
        self.data = data

    @cached_property
    def words(self) -> list[bytes]:
        return self.data.split()

    @cached_property
    def n_words(self) -> int:
        return len(self.words)

    @cached_property
    def word_chars(self) -> int:
        joined = b"".join(self.words)
        return len(joined) if joined.isascii() else len(joined.decode("utf-8", "replace"))

    @cached_property
    def n_symbols(self) -> int:
        return sum(self.data.count(s) for s in SYMBOLS)

    @cached_property
    def lines(self) -> list[bytes]:
        return [line for line in self.data.split(b"\n") if line.strip()]

    @cached_property
    def n_dup_lines(self) -> int:
        return len(self.lines) - len(set(self.lines))

    @cached_property
    def n_repeat_words(self) -> int:
        """Words inside windows that occur twice or more, the first occurrence included."""
        windows = self.n_words - WINDOW + 1
        if windows < 2:
            return 0
        ids = np.fromiter(map(hash, self.words), np.int64, self.n_words).view(np.uint64)
        ids = (ids ^ (ids >> np.uint64(29))) * FACTOR
        codes = ids[:windows].copy()
        for i in range(1, WINDOW):
            codes = (codes ^ (codes >> np.uint64(31))) * FACTOR + ids[i : i + windows]
        order = np.sort(codes)
        twice = order[1:][order[1:] == order[:-1]]
        if not len(twice):
            return 0
        starts = np.flatnonzero(np.isin(codes, twice))
        change = np.zeros(self.n_words + 1, np.int64)
        np.add.at(change, starts, 1)
        np.add.at(change, starts + WINDOW, -1)
        return int(np.count_nonzero(np.cumsum(change[:-1])))

    @cached_property
    def upper_share(self) -> float:
        """Share of capitals among the letters A-Z and a-z."""
        lower = sum(map(self.data.count, b"etaoinshrdlucmfwypvbgkjqxz"))
        upper = sum(map(self.data.count, b"ETAOINSHRDLUCMFWYPVBGKJQXZ"))
        return upper / (lower + upper) if lower + upper else 0.0

    @cached_property
    def stutter_share(self) -> float:
        """Share of words equal to the word before."""
        return sum(a == b for a, b in pairwise(self.words)) / self.n_words if self.n_words else 0.0


Rule = tuple[str, Callable[[Text], bool]]

#: True: the text is rejected. The first two are the base rules.
RULES: list[Rule] = [
    ("too_short", lambda t: t.n_words < MIN_WORDS),
    ("repeated_windows", lambda t: 100 * t.n_repeat_words > 30 * t.n_words),
    ("symbols", lambda t: 10 * t.n_symbols > t.n_words),
    ("capitals", lambda t: t.upper_share > 0.5),
    ("stutter", lambda t: t.stutter_share > 0.2),
    ("word_length", lambda t: not 2 * t.n_words <= t.word_chars <= 12 * t.n_words),
    ("repeated_lines", lambda t: 2 * t.n_dup_lines > len(t.lines)),
]


def base_failed(text: Text) -> bool:
    return text.n_words < MIN_WORDS or 100 * text.n_repeat_words > 30 * text.n_words


def rejected_by(text: Text, rules: Iterable[Rule]) -> str | None:
    """The first rule that rejects; the rules after it are not evaluated."""
    return next((name for name, rejects in rules if rejects(text)), None)


def estimates(sample: list[bytes], rules: list[Rule] = RULES) -> dict[str, tuple[float, int]]:
    """(seconds, texts rejected) of every rule alone on the whole texts of the sample."""
    found = {}
    for name, rejects in rules:
        texts = [Text(t) for t in sample]
        start = time.perf_counter()
        rejected = sum(map(bool, map(rejects, texts)))
        found[name] = (time.perf_counter() - start, rejected)
    return found


def ordered(rules: list[Rule], found: dict[str, tuple[float, float]]) -> list[Rule]:
    """Rules by rejections per cost, the best first; ties keep their order, rules without estimates come last."""
    return sorted(rules, key=lambda rule: -found[rule[0]][1] / max(found[rule[0]][0], 1e-9) if rule[0] in found else 0.0)


def cascade(docs: DataFrame, text: str = "text", rules: list[Rule] = RULES, rows: int = SAMPLE_ROWS) -> list[str]:
    """The names of the rules in the order in which to run them, from a sample of about ``rows`` whole texts.

    Rows of every part of the table are equally likely. They are measured where they are read; only each rule's seconds
    and rejections reach the driver. An empty table leaves the rules in their order.
    """
    sample = docs.select(F.col(text).cast("binary").alias("t")).sample(min(1.0, rows / max(1, docs.count())), SAMPLE_SEED)
    schema = T.StructType.fromDDL(ESTIMATES)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, common.SLICE_ROWS):
                texts = [t or b"" for t in batch.column(0).slice(start, common.SLICE_ROWS).to_pylist()]
                found = [(name, len(texts), *measured) for name, measured in estimates(texts, rules).items()]
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found), arrow)], schema=arrow)

    sums = common.map_arrow(sample, run, schema).groupBy("rule").agg(F.sum("seconds").alias("seconds"), F.sum("rejected").alias("rejected"))
    return [name for name, _ in ordered(rules, {r.rule: (r.seconds, r.rejected) for r in sums.collect()})]


def _in_order(names: list[str]) -> list[Rule]:
    by_name = dict(RULES)
    return [(name, by_name[name]) for name in names]


def verdicts(docs: DataFrame, key: str = "doc_id", text: str = "text", order: list[str] | None = None) -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept), one row per row of ``docs``.

    A null or empty text has no words and is rejected. Repeated rows are judged alike, each for itself;
    an empty table gives no rows. Other columns are not read.
    """
    order = cascade(docs, text) if order is None else order

    def make():
        rules = _in_order(order)

        def measure(texts: list[bytes]) -> dict[str, list]:
            names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
            found = {name: [] for name in (*names, "base_failed", "kept")}
            for data in texts:
                one = Text(data)
                kept = rejected_by(one, rules) is None
                for name in names:
                    found[name].append(getattr(one, name))
                failed = base_failed(one)
                found["base_failed"].append(failed)
                found["kept"].append(kept and not failed)
            return found

        return measure

    columns = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean"
    return common.per_text(docs, make, columns, key, text)


def keep(docs: DataFrame, text: str = "text", order: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` that no rule rejects, with all their columns; rules after a rejection are not evaluated."""
    order = cascade(docs, text) if order is None else order
    at = docs.columns.index(text)

    def run(batches):
        rules = _in_order(order)
        for batch in batches:
            for start in range(0, batch.num_rows, common.SLICE_ROWS):
                part = batch.slice(start, common.SLICE_ROWS)
                texts = part.column(at).cast(pa.binary()).to_pylist()
                yield part.filter(pa.array([rejected_by(Text(t or b""), rules) is None for t in texts], pa.bool_()))

    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])  # names with dots do not reach Python
    return common.map_arrow(plain, run, plain.schema).toDF(*docs.columns)
