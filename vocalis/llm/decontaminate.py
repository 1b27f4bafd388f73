"""Benchmark decontamination with a positional inverted index, in DataFrame operators only.

The phrases to look for are windows of the benchmark items. One pass over the documents counts in how many
places every benchmark word stands. Each phrase is then led by its rarest word. A second pass stores the
index: the postings (document, place) of the leading words only, each with the few words around it that any
phrase led by that word can reach. A phrase's list of places, shifted by the word's offset in the phrase,
is intersected with the lists of all its other words in the posting itself, as the neighbours are at hand;
so no second list is shuffled. Every row of the index belongs to one place of one document: a frequent word,
line or passage is spread over the tasks that read it, and no list is ever gathered.

The phrases travel to the postings by an ordinary join on the word; they are read from a written table, so
the planner knows their size and broadcasts them only if they are small.

Near matches may lack some words of a phrase, also its rarest. With ``slack`` words that may be missing, each
phrase is led by its slack + 1 rarest words: a place that lacks no more than ``slack`` holds one of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vocalis.llm import common

LENGTH = 13
#: An index row with this word stands for a document itself, its place being the number of words.
DOCUMENT = ""
#: Leading words that are broadcast to the texts: some MB. With more of them, places are shuffled to the words.
BROADCAST_WORDS = 100_000
#: A near match may lack so many of a phrase's different words, and is so many words longer than the phrase.
SLACK, REACH = 2, 3


def windows(items: DataFrame, length: int = LENGTH, key: str = "item_id", text: str = "text") -> DataFrame:
    """(item, words): all windows of ``length`` words; an item of fewer words, but not none, is one window."""
    rows = items.select(F.col(key).cast("string").alias("item"), common.words(F.col(text)).alias("all"))
    rows = rows.where(F.size("all") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("all") - length + 1, F.lit(1)))
    rows = rows.select("item", "all", F.explode(starts).alias("at"))
    return rows.select("item", F.slice("all", F.col("at"), F.lit(length)).alias("words")).distinct()


def _texts(docs: DataFrame, key: str, text: str) -> DataFrame:
    """(row, key, all): the words of every row; ``row`` tells rows apart within one reading."""
    return docs.select(F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"), common.words(F.col(text)).alias("all"))


def _tokens(texts: DataFrame) -> DataFrame:
    """(row, key, all, place, word): every word with its place from 0, and after them the word DOCUMENT."""
    listed = F.concat("all", F.array(F.lit(DOCUMENT)))
    return texts.select("row", "key", "all", F.posexplode(listed).alias("place", "word"))


def phrases(docs: DataFrame, found: DataFrame, key: str = "doc_id", text: str = "text", slack: int = 0) -> DataFrame:
    """(item, words, word, offset, nth) with the phrase's rarest words in the documents, the rarest being number 0; ties take the first place.

    The counts cover all documents. A phrase has one leading word more than may still be missing. Words that no
    document holds are missing everywhere: a phrase with more than ``slack`` of them cannot occur and is left out.
    """
    terms = common.written(found.select(F.explode("words").alias("word")).distinct())
    counts = _tokens(_texts(docs, key, text)).select("word").join(terms, "word", "left_semi").groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    each = found.select("item", "words", F.posexplode("words").alias("offset", "word")).join(counts, "word", "left")
    each = each.where(F.array_position("words", F.col("word")) == F.col("offset") + 1)
    ranked = F.array_sort(F.collect_list(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "word"))).alias("ranked")
    held = F.filter("ranked", lambda x: x["n"] > 0)
    left = F.lit(slack) - F.size("ranked") + F.size(held)
    led = each.groupBy("item", "words").agg(ranked).where(left >= 0)
    led = led.select("item", "words", F.posexplode(F.slice(held, F.lit(1), left + 1)).alias("nth", "lead"))
    return common.written(led.select("item", "words", F.col("lead.word").alias("word"), F.col("lead.offset").alias("offset"), "nth"))


def index(docs: DataFrame, led: DataFrame, key: str = "doc_id", text: str = "text", reach: int | None = None) -> DataFrame:
    """The stored postings: (row, key, word, place, first, around), ``around`` being words[first, first + size).

    With ``reach``, for proximity, the neighbourhood holds every window around the word that is ``reach`` words longer
    than a phrase. The row with the word DOCUMENT is kept for every document, so the index also lists documents
    without any leading word.
    """
    before, after = F.max("offset"), F.max(F.size("words") - F.col("offset"))
    if reach is not None:
        before, after = F.max(F.size("words")) + reach - 1, F.max(F.size("words")) + reach
    terms = led.groupBy("word").agg(before.alias("before"), after.alias("after"))
    own = docs.sparkSession.range(1).select(F.lit(DOCUMENT).alias("word"), F.lit(0).alias("before"), F.lit(0).alias("after"))
    terms = common.written(terms.unionByName(own))
    texts = _texts(docs, key, text)
    if terms.limit(BROADCAST_WORDS + 1).count() <= BROADCAST_WORDS:
        rows = _tokens(texts).join(F.broadcast(terms), "word")
    else:  # places alone are shuffled to the words; the texts are read again from a table that keeps their rows apart
        texts = common.written(texts)
        rows = _tokens(texts).select("row", "place", "word").join(terms, "word").join(texts, "row")
    first = F.greatest(F.col("place") - F.col("before"), F.lit(0))
    around = F.slice("all", F.col("first") + 1, F.col("place") - F.col("first") + F.col("after"))
    return common.written(rows.withColumn("first", first).select("row", "key", "word", "place", "first", around.alias("around")))


def phrase_matches(postings: DataFrame, led: DataFrame) -> DataFrame:
    """(row, key, item, start, length): every exact occurrence of every phrase."""
    pairs = postings.where(F.col("word") != DOCUMENT).join(led, "word")
    start = F.col("place") - F.col("offset")
    same = F.slice("around", F.greatest(start - F.col("first"), F.lit(0)) + 1, F.size("words")) == F.col("words")
    hits = pairs.where((start >= F.col("first")) & same)
    return hits.select("row", "key", "item", start.alias("start"), F.size("words").alias("length"))


def proximity_matches(postings: DataFrame, led: DataFrame, slack: int, reach: int = REACH) -> DataFrame:
    """(row, key, item, start, length, missing): every window in which most of a phrase's words stand, in any order.

    Windows are ``reach`` words longer than the phrase; a document of fewer words is one window. ``missing`` is how
    many different words of the phrase are not in the window: at most ``slack``, and not all; the fewest of the item's
    phrases of that length. Every window is given once, whichever leading words it holds. Complete if the phrases
    were led with this slack and the postings stored with this reach, or with more.
    """
    pairs = postings.where(F.col("word") != DOCUMENT).join(led, "word")
    n, length = F.size(F.array_distinct("words")), F.size("words") + F.lit(reach)
    most = F.least(F.lit(slack), n - 1)
    pairs = pairs.select("row", "key", "item", "words", "place", "first", "around", length.alias("length"), most.alias("most"))
    pairs = pairs.where(F.size(F.array_except("words", "around")) <= F.col("most"))
    last = F.least(F.col("place"), F.greatest(F.col("first") + F.size("around") - F.col("length"), F.lit(0)))
    lowest = F.greatest(F.col("place") - F.col("length") + 1, F.col("first"))
    pairs = pairs.where(lowest <= last).withColumn("start", F.explode(F.sequence(lowest, last)))
    window = F.slice("around", F.col("start") - F.col("first") + 1, F.col("length"))
    pairs = pairs.withColumn("missing", F.size(F.array_except("words", window))).where(F.col("missing") <= F.col("most"))
    return pairs.groupBy("row", "key", "item", "start", "length").agg(F.min("missing").alias("missing"))


def covered(matches: DataFrame) -> DataFrame:
    """(row, n_hit): how many words lie inside any match. Occurrences of a place collapse before the shuffle."""
    longest = matches.groupBy("row", "start").agg(F.max("length").alias("length"))
    ends = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max(F.col("start") + F.col("length")).over(ends), F.lit(0))
    end = F.col("start") + F.col("length")
    gain = F.greatest(end - F.greatest(F.col("start"), F.col("reached")), F.lit(0))
    return longest.withColumn("reached", reached).groupBy("row").agg(F.sum(gain).alias("n_hit"))


def contaminated(n_hit: Column, n_words: Column) -> Column:
    return (n_hit > 0) & (20 * n_hit >= n_words)


def report(
    docs: DataFrame, items: DataFrame, length: int = LENGTH, key: str = "doc_id", text: str = "text",
    item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """(key, n_words, n_hit, n_items, items_sha256, contaminated), one row per row of ``docs``.

    A null or empty text has no words and is clean. A null item id has no place in the list of ids, but its
    windows count as hits. Repeated documents are judged each; repeated items count once. Without items, or
    without documents, nothing is contaminated. Other columns are not read.
    """
    found = common.written(windows(items, length, item_key, item_text))
    led = phrases(docs, found, key, text)
    postings = index(docs, led, key, text)
    matches = phrase_matches(postings, led)
    rows = _exact(postings, matches).withColumnRenamed("key", key)
    return rows.drop("row")


def _exact(postings: DataFrame, matches: DataFrame) -> DataFrame:
    """(row, key, n_words, n_hit, n_items, items_sha256, contaminated) of every document in the index."""
    matches = common.written(matches.select("row", "item", "start", "length").distinct())
    ids = matches.select("row", "item").distinct().groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    every = postings.where(F.col("word") == DOCUMENT).select("row", "key", F.col("place").cast("long").alias("n_words"))
    rows = every.join(covered(matches).join(ids, "row", "left"), "row", "left")
    n_hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        "row", "key", "n_words", n_hit.alias("n_hit"), F.size(items_).cast("long").alias("n_items"),
        F.sha2(F.array_join(items_, ",").cast("binary"), 256).alias("items_sha256"),
        contaminated(n_hit, F.col("n_words")).alias("contaminated"),
    )


def near_report(
    docs: DataFrame, items: DataFrame, length: int = LENGTH, slack: int = SLACK, reach: int = REACH,
    key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """The columns of ``report`` and (n_near_windows, n_near, near_sha256, n_missing), one row per row of ``docs``.

    Windows with a near match, items that have one, the sha256 of their ids as in ``report``, and the fewest words
    missing in any; null without a near match. Exact matches are near matches; both come from one index. Otherwise as ``report``.
    """
    found = common.written(windows(items, length, item_key, item_text))
    led = phrases(docs, found, key, text, slack)
    postings = index(docs, led, key, text, reach)
    matches = common.written(proximity_matches(postings, led, slack, reach).drop("key"))
    spots = matches.groupBy("row", "start", "length").agg(F.min("missing").alias("missing"))
    spots = spots.groupBy("row").agg(F.count(F.lit(1)).alias("n_near_windows"), F.min("missing").cast("long").alias("n_missing"))
    ids = matches.select("row", "item").distinct().groupBy("row").agg(F.array_sort(F.collect_list("item")).alias("items"))
    rarest = common.written(led.where("nth = 0"))  # one leading word is enough for exact matches, and its table is small
    rows = _exact(postings, phrase_matches(postings, rarest)).join(spots.join(ids, "row", "left"), "row", "left")
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        F.col("key").alias(key), "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
        F.coalesce("n_near_windows", F.lit(0)).cast("long").alias("n_near_windows"), F.size(items_).cast("long").alias("n_near"),
        F.sha2(F.array_join(items_, ",").cast("binary"), 256).alias("near_sha256"), "n_missing",
    )


def clean(docs: DataFrame, items: DataFrame, length: int = LENGTH, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns, whatever their keys.

    Contamination is a matter of the text alone, so rows go by a digest of their texts: of rows that share a key
    only contaminated ones go, and a contaminated row without a key goes too.
    """
    digest = F.md5(F.col(text).cast("binary"))
    bad = report(docs.select(digest.alias("_key"), F.col(text).alias("_text")), items, length, "_key", "_text")
    bad = common.written(bad.where("contaminated").select(F.col("_key").alias("_digest")).distinct())
    return docs.join(bad, digest == bad["_digest"], "left_anti")
