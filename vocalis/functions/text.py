"""Cleaning free text, as column expressions."""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from vocalis import lexicons

KEYCAP_MARK = "\u20e3"
KEYCAP = "[0-9#*]\\x{FE0F}?\\x{20E3}"
WORD = "[a-z0-9]+"

#: The only characters beyond ASCII that lower-case to something with an ASCII letter in it.
FOLDING = ["\u212a", "\u0130"]


def strip_emoji(text: Column) -> Column:
    """Keycap emoji (a digit plus a combining mark) become a space.

    Every other emoji has no ASCII letter or digit in it, so ``words`` passes over it anyway.
    The plain ``contains`` test spares nearly all rows the regular expression.
    """
    return F.when(F.contains(text, F.lit(KEYCAP_MARK)), F.regexp_replace(text, KEYCAP, " ")).otherwise(text)


def lower_ascii(text: Column) -> Column:
    """The text in lower case, in which no ASCII letter comes from a character that is not one.

    The Kelvin sign would turn into a "k"; it and its like are blanked first, in the few texts that
    have them, so that the text as a whole can be lowered.
    """
    folds = functools.reduce(lambda a, b: a | b, [F.contains(text, F.lit(c)) for c in FOLDING])
    blanked = F.translate(text, "".join(FOLDING), " " * len(FOLDING))
    return F.lower(F.when(folds, blanked).otherwise(text))


def words(text: Column, stopwords: Iterable[str] = lexicons.STOPWORDS) -> Column:
    """The runs of ASCII letters and digits, lower-cased, in order, without stop words.

    Taking the words out is the same as blanking everything else and splitting, but needs one
    pass and no replacement buffer.
    """
    found = F.regexp_extract_all(lower_ascii(strip_emoji(text)), F.lit(WORD), F.lit(0))
    stop = sorted(set(stopwords))
    return F.filter(found, lambda w: ~w.isin(stop)) if stop else found


def clean(text: Column, stopwords: Iterable[str] = lexicons.STOPWORDS) -> Column:
    """Cleaned text: ``words`` joined by single spaces; null stays null."""
    return F.array_join(words(text, stopwords), " ")
