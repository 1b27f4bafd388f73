"""Keyword tags of cleaned text, as array columns."""

from __future__ import annotations

import functools
import re
from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from vocalis import lexicons

#: Up to this many keywords each test is its own generated expression; beyond it, one loop over a constant.
EXPRESSION_LIMIT = 400

_CLEANED = re.compile(r"[a-z0-9]+( [a-z0-9]+)*")


def normalize(keyword: str) -> str:
    """A keyword in the form the cleaner gives to text (stop words are kept)."""
    return " ".join(re.findall(r"[A-Za-z0-9]+", keyword)).lower()


def live_keywords(topics: Mapping[str, Sequence[str]], normalize_keywords: bool = False) -> dict[str, list[str]]:
    """The keywords that can decide anything on cleaned text.

    Cleaned text has only lower-case words split by single spaces, so a keyword of another form
    never occurs in it; and a keyword that contains another one of its topic adds nothing.
    """
    kept = {}
    for topic, keywords in topics.items():
        forms = [normalize(k) if normalize_keywords else k for k in keywords]
        possible = list(dict.fromkeys(k for k in forms if _CLEANED.fullmatch(k)))
        kept[topic] = [k for k in possible if not any(o != k and o in k for o in possible)]
    return kept


def tag(
    cleaned: Column,
    topics: Mapping[str, Sequence[str]] = lexicons.TOPICS,
    mode: str = "substring",
    normalize_keywords: bool = False,
) -> Column:
    """Topics with at least one keyword in the cleaned text, each once, in dictionary order; null gives none.

    ``mode='substring'`` finds a keyword anywhere ("lag" in "flag"); ``mode='token'`` only as whole words.
    """
    if mode not in ("substring", "token"):
        raise ValueError(f"unknown mode {mode!r}")
    if mode == "substring":
        text, live = cleaned, live_keywords(topics, normalize_keywords)
    else:
        text = F.concat(F.lit(" "), cleaned, F.lit(" "))
        padded = {t: [f" {normalize(k) if normalize_keywords else k} " for k in ks] for t, ks in topics.items()}
        live = {t: [k for k in ks if _CLEANED.fullmatch(k.strip())] for t, ks in padded.items()}
    live = {t: ks for t, ks in live.items() if ks}
    if not live:
        found = F.array().cast("array<string>")
    elif sum(map(len, live.values())) <= EXPRESSION_LIMIT:
        found = F.array_compact(F.array(*[F.when(_any_of(text, ks), F.lit(t)) for t, ks in live.items()]))
    else:
        pairs = F.array(*[F.struct(F.lit(t).alias("t"), F.lit(k).alias("k")) for t, ks in live.items() for k in ks])
        hits = F.filter(pairs, lambda p: F.contains(text, p["k"]))
        found = F.array_distinct(F.transform(hits, lambda p: p["t"]))
    return F.when(cleaned.isNull(), F.array().cast("array<string>")).otherwise(found)


def tag_models(cleaned: Column, models: Sequence[str] = lexicons.PHONE_MODELS) -> Column:
    """Names found in the cleaned text, each once, in list order; null gives none."""
    return tag(cleaned, {m: [m] for m in models})


def _any_of(text: Column, keywords: Sequence[str]) -> Column:
    return functools.reduce(lambda a, b: a | b, [F.contains(text, F.lit(k)) for k in keywords])
