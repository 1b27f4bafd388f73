"""The given tables in the roles the operators expect, and the word lists fitted to their prose."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalis import lexicons
from vocalis.functions import text
from vocalis.lexicons import PolarityRules
from vocalis.operators import stages
from vocalis.plans.opinions import Settings

# The prose of the tables is invented, so the default lists hardly meet it. These do.
STOPWORDS = "the of and to in is it on for as was be are ou or re".split()
TOPICS = {"alpha": ["tion", "ment"], "beta": ["heit", "keit"], "gamma": ["eaux", "elle"], "delta": ["zzzz"]}
TOKEN_TOPICS = {"alpha": ["tion", "orantion"], "beta": ["die", "un ver"], "gamma": ["that this", "la ment"]}
MODELS = ["than", "ville", "schen", "qqqq"]
MENTION = "version"
PART_STOPWORDS = ["cold", "widget", "small"]
VALENCES = {
    "tion": 1.5, "heit": -2.0, "un": 1.0, "der": -0.5, "that": 2.0, "ment": 1.9, "keit": -2.4,
    "elle": 2.2, "ther": -1.3, "thon": -0.9, "ing": 1.2, "eau": 0.7, "thre": -1.8, "thatin": -3.1,
    "ononst": -2.7, "inoran": -1.6, "eren": 0.4,
}
RULES = PolarityRules(
    boosters={"ai": 0.293, "st": 0.293, "la": 0.293, "er": 0.293, "ha": -0.293, "by": -0.293},
    booster_pairs=(),
    negators=("never", "without", "nd", "de", "an"),
    emphatic=(),
    idioms={},
)
PHRASE_RULES = PolarityRules(
    boosters=RULES.boosters,
    booster_pairs=("en la", "with that", "that with"),
    negators=RULES.negators,
    emphatic=("this", "from"),
    idioms={"that this": -1.5, "that by": 1.1, "with this that": 3.0, "un el": -2.0, "die der": 0.6},
)
SETTINGS = Settings(stopwords=STOPWORDS, topics=TOPICS, models=MODELS, rules=RULES, search=None, mention=MENTION)

#: Settings of the whole-chain query, whose videos are conversations.
CHAIN = Settings(
    stopwords=STOPWORDS, topics=TOPICS, models=MODELS, rules=RULES,
    search="talk", mention="tion", days=30, min_seconds=60, n_videos=50, n_comments=5,
)
ANCHOR = datetime.datetime(2024, 2, 10, tzinfo=datetime.timezone.utc)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


#: When the first document comes in the stream of documents: 2024-01-01, UTC.
FIRST_SECOND = 1_704_067_200


#: Rows of a selection that is made without ranking.
MANY = 1000


def own_valences(docs: DataFrame) -> DataFrame:
    """A valence list of all words of the documents themselves, for lists that grow with the data."""
    words = docs.select(F.explode("words").alias("token")).distinct()
    context = [*RULES.boosters, *RULES.negators]
    step = F.pmod(F.length("token") * 7 + F.ascii("token") + F.ascii(F.right("token", F.lit(1))), F.lit(9)) - 4
    return words.where(~F.col("token").isin(*context)).select("token", (step / 2.0).alias("valence")).where("valence <> 0")


def valences(spark: SparkSession) -> DataFrame:
    return lexicons.valence_table(spark, VALENCES)


def land_conversations(spark: SparkSession, sf_dir: str, folder: str, listings: bool = True) -> None:
    """Conversations as videos with comments and, with ``listings``, documents as posts, written as API pages.

    A page holds at most 50 ids or details (ids are counted from 0 without gaps) or 100 comments (a
    conversation has each turn once), so no group that is collected into a page can grow.
    """
    talks = table(spark, sf_dir, "conversations")
    videos = talks.groupBy("conv_id").agg(
        F.sum(F.length("text")).cast("string").alias("views"), F.count(F.lit(1)).alias("turns")
    )
    page = F.expr("cast(conv_id div 50 as int)")
    video_id = F.col("conv_id").cast("string")
    anchor = F.lit(ANCHOR.replace(tzinfo=None).isoformat()).cast("timestamp_ntz")
    published = anchor - F.make_dt_interval((F.col("conv_id") % 40).cast("int"))
    search_item = F.struct(F.struct(video_id.alias("videoId")).alias("id"))
    detail_item = F.struct(
        video_id.alias("id"),
        F.struct(
            F.concat(F.lit("Talk "), video_id).alias("title"),
            F.date_format(published, "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("publishedAt"),
        ).alias("snippet"),
        F.struct(F.col("views").alias("viewCount"), F.col("turns").cast("string").alias("commentCount")).alias(
            "statistics"
        ),
        F.struct(F.format_string("PT%dS", F.col("turns") * 30).alias("duration")).alias("contentDetails"),
    )
    for name, item in (("search", search_item), ("details", detail_item)):
        pages = videos.groupBy(page.alias("page_no")).agg(F.collect_list(item).alias("items"))
        pages.write.json(f"{folder}/{name}")

    comment = F.struct(
        F.col("text").alias("textDisplay"),
        F.length("text").cast("long").alias("likeCount"),
        F.col("role").alias("authorDisplayName"),
    )
    thread = F.struct(F.struct(F.struct(comment.alias("snippet")).alias("topLevelComment")).alias("snippet"))
    ordered = F.sort_array(F.collect_list(F.struct("turn", thread.alias("item"))))
    threads = talks.groupBy(video_id.alias("video_id"), F.expr("cast(turn div 100 as int)").alias("page_no"))
    threads.agg(F.transform(ordered, lambda x: x["item"]).alias("items")).write.json(f"{folder}/comments")
    if listings:
        land_listings(spark, sf_dir, f"{folder}/listings")


#: Turns on a page of talks.
TURNS = 2


def land_talks(spark: SparkSession, sf_dir: str, folder: str, bad_likes: bool = False) -> None:
    """Conversations as comment pages that name the next page, as a landing that went wrong: some pages are lost, some
    have landed twice. With ``bad_likes`` some counts are no numbers."""
    talks = table(spark, sf_dir, "conversations")
    last = talks.groupBy("conv_id").agg(F.expr(f"max(turn) div {TURNS}").alias("last"))
    likes = F.length("text").cast("string")
    likes = F.when((F.col("conv_id") + F.col("turn")) % 13 == 4, "lots").otherwise(likes) if bad_likes else likes
    comment = F.struct(F.col("text").alias("textDisplay"), likes.alias("likeCount"), F.col("role").alias("authorDisplayName"))
    thread = F.struct(F.struct(F.struct(comment.alias("snippet")).alias("topLevelComment")).alias("snippet"))
    paged = talks.withColumn("page_no", F.expr(f"cast(turn div {TURNS} as int)")).groupBy("conv_id", "page_no")
    pages = paged.agg(F.transform(F.sort_array(F.collect_list(F.struct("turn", thread.alias("item")))), lambda x: x["item"]).alias("items"))
    token = F.when(F.col("page_no") < F.col("last"), F.concat(F.lit("p"), F.col("page_no") + 1))
    fate = (F.col("conv_id") * 7 + F.col("page_no") * 3) % 11
    pages = pages.join(last, "conv_id").where(fate != 3).withColumn("copy", F.explode(F.when(fate == 5, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    pages.select(F.col("conv_id").cast("string").alias("video_id"), "page_no", token.alias("nextPageToken"), "items").write.json(folder)


def short_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table of stop words that grows with the benchmark: its words of up to three letters."""
    words = table(spark, sf_dir, "benchmark", "text").select(F.explode(text.words(F.col("text"), ())).alias("word"))
    return words.where(F.length("word") <= 3).distinct()


def word_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A keyword table that grows with the benchmark: its words and pairs of neighbours, by length and first letter."""
    rows = stages.clean_rows(table(spark, sf_dir, "benchmark", "text"), "text", STOPWORDS, keep_words=True).select("words")
    pairs = F.zip_with("words", F.slice("words", 2, 1 << 30), lambda a, b: F.concat_ws(" ", a, b))
    pairs = F.slice(pairs, F.lit(1), F.greatest(F.size("words") - 1, F.lit(0)))
    keywords = rows.select(F.explode(F.concat("words", pairs)).alias("keyword")).distinct()
    return keywords.select(F.concat(F.size(F.split("keyword", " ")), F.left("keyword", F.lit(1))).alias("topic"), "keyword")


def land_listings(spark: SparkSession, sf_dir: str, folder: str) -> None:
    """Documents as posts of four forums, one per language."""
    forum = F.expr("case lang when 'en' then 'apple' when 'de' then 'iphone' when 'fr' then 'technology' else 'pets' end")
    posts = table(spark, sf_dir, "documents").select(forum.alias("subreddit"), F.col("text").alias("title"))
    posts.write.json(folder)
