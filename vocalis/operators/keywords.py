"""Tags from keyword lists of any size: the list is a table, and is joined instead of being looped over in every row.

A keyword table has the columns ``topic`` and ``keyword``, and ``rank`` if topics have an order of their own. Both
forms give what ``tags.tag`` gives for the same list. No step holds the list in a task or in the plan:

* whole words: a text's runs of words, only of the lengths that the list has, meet the keywords by equality;
* anywhere: a keyword of one word stands inside a word of the text, so the different words of all texts are searched, not the
  texts: every keyword is led by the one of its runs of three bytes that stands in the fewest words, and compared where that
  stands. Cleaned text has at most 37**3 different runs, so the table of leading runs is small whatever the list. The
  words with most texts, and what they hold, meet the texts where these are read; only the other words travel;
* a keyword of several words stands across a space, so it is looked for at the spaces, led by the last letters before its first
  space and the first letters behind it.

Several lists are found in one pass over the texts.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalis.functions import tags
from vocalis.operators import stages
from vocalis.operators.stages import computed_once
from vocalis.session import workspace

#: Bytes of the runs that lead keywords; shorter keywords are met by equality.
GRAM = 3
#: Characters that cleaned text has: so many different runs can lead keywords at most.
MOST_GRAMS = 37**GRAM
#: Letters of a keyword before and behind its first space that lead it; with fewer, more keywords are compared at a space.
BEFORE, BEHIND = 2, 3
#: Leading words, and keywords of several words, that are broadcast at most; beyond, they are joined like any table.
BROADCAST_WORDS = 100_000


def keyword_table(spark: SparkSession, topics: Mapping[str, Sequence[str]], normalize_keywords: bool = False) -> DataFrame:
    """A dictionary of topics as a keyword table, in the dictionary's order."""
    rows = [(n, t, tags.normalize(k) if normalize_keywords else k) for n, (t, ks) in enumerate(topics.items()) for k in ks]
    return spark.createDataFrame(rows, "rank int, topic string, keyword string")


def tag_rows(
    df: DataFrame, topics: Mapping[str, Sequence[str]] | DataFrame, models: Sequence[str] | DataFrame, column: str = "cleaned"
) -> DataFrame:
    """``stages.tag_rows`` with topics as a keyword table, models as a table (model), or both or none of them."""
    names = models.select(F.col("model").alias("topic"), F.col("model").alias("keyword")) if isinstance(models, DataFrame) else None
    if names is not None and "rank" in models.columns:
        names = models.select("rank", F.col("model").alias("topic"), F.col("model").alias("keyword"))
    small_topics, small_models = {} if isinstance(topics, DataFrame) else topics, () if names is not None else models
    rows = stages.tag_rows(df, column, small_topics, small_models)
    lists = {"phone_models": names} if names is not None else {}
    if isinstance(topics, DataFrame):
        lists["topics"] = topics
    if lists:
        rows = tag_lists(rows.drop(*lists), lists, column)
    return rows.select(*df.columns, "phone_models", "topics")


def _written(df: DataFrame) -> DataFrame:
    path = workspace(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _ranked(keywords: DataFrame) -> DataFrame:
    """(tag, keyword): keywords that cleaned text can contain; a tag is its rank and topic."""
    rank = F.col("rank") if "rank" in keywords.columns else F.lit(0)
    rows = keywords.select(F.struct(rank.alias("rank"), "topic").alias("tag"), "keyword")
    return _written(rows.where(F.col("keyword").rlike(r"^[a-z0-9]+( [a-z0-9]+)*\z")).distinct())


def _numbered(df: DataFrame) -> DataFrame:
    return _written(df.withColumn("_row", F.monotonically_increasing_id()))


def _with_topics(rows: DataFrame, hits: DataFrame, column: str) -> DataFrame:
    """``rows`` with the tags of their hits (_row, tag), each once and in order; a row has no more of them than the list has topics."""
    found = hits.groupBy(F.col("_row").alias("_hit")).agg(F.transform(F.sort_array(F.collect_set("tag")), lambda t: t["topic"]).alias(column))
    joined = rows.join(found, rows["_row"] == found["_hit"], "left").drop("_row", "_hit")
    return joined.withColumn(column, F.coalesce(column, F.array().cast("array<string>")))


def tag_words(df: DataFrame, keywords: DataFrame, column: str = "cleaned", into: str = "topics") -> DataFrame:
    """``df`` plus the topics with a keyword among the whole words of ``column``; null gives none.

    The runs of a text are distinct before they travel. A run that many texts hold is split by the skew join.
    """
    table = _ranked(keywords)
    lengths = [r.n for r in table.select(F.size(F.split("keyword", " ")).alias("n")).distinct().collect()]  # lengths, not keywords
    rows = _numbered(df)
    texts = computed_once(rows.select("_row", column).where(F.col(column).isNotNull()), words=F.split(column, " "))

    def runs(n: int) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.greatest(F.size("words") - (n - 1), F.lit(1))), lambda i: i + (n - 1) <= F.size("words"))
        return F.col("words") if n == 1 else F.transform(starts, lambda i: F.array_join(F.slice("words", i, n), " "))

    every = F.array_distinct(F.concat(F.array().cast("array<string>"), *[runs(n) for n in lengths]))
    hits = texts.select("_row", F.explode(every).alias("keyword")).join(table, "keyword")
    return _with_topics(rows, hits.select("_row", "tag"), into)


def _latin(text: Column) -> Column:
    """The bytes of a text, each as one character."""
    return F.decode(F.encode(text, "UTF-8"), "ISO-8859-1")


def _grams(latin: Column, n: int = GRAM) -> Column:
    """All runs of ``n`` characters in order, found in one pass."""
    return F.regexp_extract_all(latin, F.lit(rf"(?s)(?=(.{{{n}}}))."), F.lit(1))


def tag_anywhere(df: DataFrame, keywords: DataFrame, column: str = "cleaned", into: str = "topics") -> DataFrame:
    """``df`` plus the topics with a keyword anywhere in ``column``, also within words; null gives none."""
    return tag_lists(df, {into: keywords}, column)


def tag_lists(df: DataFrame, lists: Mapping[str, DataFrame], column: str = "cleaned", leading: int = BROADCAST_WORDS) -> DataFrame:
    """``df`` plus a column per keyword table, each as ``tag_anywhere`` makes it."""
    tags_, table = _numbered_tags(lists)
    rows = _numbered(df)
    texts = computed_once(rows.select("_row", column).where(F.col(column).isNotNull()), words=F.split(column, " ")).drop(column)
    hits = _within_words(texts, table.where(~F.col("keyword").contains(" ")), leading)
    hits = hits.unionByName(_across_spaces(texts, table.where(F.col("keyword").contains(" ")), leading)).distinct()
    by_list = [F.collect_set(F.when(F.col("list") == into, F.struct("rank", "topic"))).alias(f"_{n}") for n, into in enumerate(lists)]
    found = hits.join(tags_, "tag").groupBy(F.col("_row").alias("_hit")).agg(*by_list)
    joined = rows.join(found, rows["_row"] == found["_hit"], "left")
    for n, into in enumerate(lists):
        topics = F.transform(F.sort_array(f"_{n}"), lambda t: t["topic"])
        joined = joined.withColumn(into, F.coalesce(topics, F.array().cast("array<string>")))
    return joined.drop("_row", "_hit", *[f"_{n}" for n in range(len(lists))])


def _numbered_tags(lists: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(tag, list, rank, topic) of all lists, and (keyword, tags) of the keywords that cleaned text can contain."""
    ranked = [_ranked(keywords).select(F.lit(into).alias("list"), "tag.rank", "tag.topic", "keyword") for into, keywords in lists.items()]
    listed = functools.reduce(DataFrame.unionByName, ranked)
    names = ["list", "rank", "topic"]
    numbers = _written(listed.select(*names).distinct().withColumn("tag", F.monotonically_increasing_id()))
    return numbers, _written(listed.join(numbers, names).groupBy("keyword").agg(F.collect_set("tag").alias("tags")))


def _within_words(texts: DataFrame, table: DataFrame, leading: int) -> DataFrame:
    """(_row, tag) of the keywords of one word.

    A word that many texts hold is among the leading ones, so it does not travel and its texts never meet in one task.
    """
    each = _written(texts.select("_row", F.explode(F.array_distinct("words")).alias("word")))
    counted = _written(each.groupBy("word").agg(F.count(F.lit(1)).alias("n")))
    inside = _written(_inside(counted, table))
    first = counted.orderBy(F.desc("n"), "word").limit(leading).select("word")
    first = F.broadcast(_written(first.join(inside, "word", "left")))
    hits = each.join(first.where("tags is not null"), "word").select("_row", F.explode("tags").alias("tag"))
    if counted.count() <= leading:
        return hits
    others = inside.join(first, "word", "left_anti")
    rare = each.join(first, "word", "left_anti").join(others, "word").select("_row", F.explode("tags").alias("tag"))
    return hits.unionByName(rare)


def _inside(words: DataFrame, table: DataFrame) -> DataFrame:
    """(word, tags): what stands anywhere in each of some different words."""
    words = words.select("word", _latin(F.col("word")).alias("latin"), F.col("word").cast("binary").alias("data"))
    small = F.array_distinct(F.concat(*[_grams(F.col("latin"), n) for n in range(1, GRAM)]))
    short = words.select("word", F.explode(small).alias("keyword")).join(table.where(F.length("keyword") < GRAM), "keyword")

    places = words.select("word", "data", F.posexplode(_grams(F.col("latin"))).alias("place", "gram"))
    counts = places.groupBy("gram").agg(F.count(F.lit(1)).alias("n"))
    long = table.where(F.length("keyword") >= GRAM)
    each = long.select("keyword", "tags", F.posexplode(_grams(F.col("keyword"))).alias("offset", "gram"))
    each = each.join(counts, "gram", "left").groupBy("keyword")
    led = each.agg(F.first("tags").alias("tags"), F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "offset", "gram")).alias("lead"))
    led = _written(led.where("lead.n > 0").select("keyword", "tags", "lead.offset", "lead.gram"))  # else the keyword stands nowhere
    reach = led.groupBy("gram").agg(F.max("offset").alias("before"), F.max(F.length("keyword") - F.col("offset")).alias("after"))
    reach = _written(reach)
    near = F.broadcast(reach) if reach.count() <= MOST_GRAMS else reach
    first = F.greatest(F.col("place") - F.col("before"), F.lit(0))
    around = F.substring("data", first + 1, F.col("place") - first + F.col("after"))
    postings = places.join(near, "gram").select("word", "gram", (F.col("place") - first).alias("ahead"), around.alias("around"))
    met = postings.join(led, "gram").where(F.col("offset") <= F.col("ahead"))
    met = met.where(F.substring("around", F.col("ahead") - F.col("offset") + 1, F.length("keyword")) == F.col("keyword").cast("binary"))
    every = met.select("word", F.explode("tags").alias("tag")).unionByName(short.select("word", F.explode("tags").alias("tag"))).distinct()
    return every.groupBy("word").agg(F.collect_list("tag").alias("tags"))


def _across_spaces(texts: DataFrame, table: DataFrame, leading: int) -> DataFrame:
    """(_row, tag) of the keywords of several words: the first ends a word, those between are the next words, the last starts one."""
    parts = F.split("keyword", " ", 2)
    led = table.select(parts[0].alias("first"), parts[1].alias("rest"), "tags", (F.size(F.split("keyword", " ")) - 1).alias("more"))
    led = _written(led)
    shape = led.agg(F.count(F.lit(1)).alias("n"), F.max("more").alias("more")).first()
    if not shape["n"]:
        return texts.select("_row", F.lit(0).cast("long").alias("tag")).where(F.lit(False))
    spaces = texts.select("_row", "words", F.posexplode("words").alias("place", "x")).withColumn("y", F.get("words", F.col("place") + 1))
    spaces = spaces.where(F.col("y").isNotNull())
    led = led.withColumn("lead", F.concat(F.right("first", F.lit(BEFORE)), F.lit(" "), F.left(F.split("rest", " ")[0], F.lit(BEHIND))))
    cuts = [F.concat(F.right("x", F.lit(i)), F.lit(" "), F.left("y", F.lit(j))) for i in range(1, BEFORE + 1) for j in range(1, BEHIND + 1)]
    if shape["n"] <= leading:
        met = spaces.withColumn("lead", F.explode(F.array(*cuts))).join(F.broadcast(led), "lead")
        behind = F.col("y")
        if shape["more"] > 1:
            several = F.array_join(F.slice("words", F.col("place") + 2, F.col("more")), " ")
            behind = F.when(F.col("more") > 1, several).otherwise(behind)
    else:  # the words after a space travel with it, as many as the list can reach
        behind = F.array_join(F.slice("words", F.col("place") + 2, F.lit(shape["more"])), " ")
        spaces = spaces.select("_row", "x", behind.alias("behind"), F.explode(F.array_distinct(F.array(*cuts))).alias("lead"))
        met, behind = spaces.join(led, "lead"), F.col("behind")
    met = met.where(F.endswith("x", "first") & F.startswith(behind, F.col("rest")))
    return met.select("_row", F.explode("tags").alias("tag"))
