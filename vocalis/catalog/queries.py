"""One query per operator, bound to the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vocalis import schemas
from vocalis.catalog import binding
from vocalis.catalog.binding import table
from vocalis.functions import polarity, tags, text, values
from vocalis.operators import keywords, ranking, report, scoring, selection, stages
from vocalis.plans import opinions, summaries
from vocalis.session import workspace
from vocalis.sources import chains, landed, rejects, sinks, tables
from vocalis.streaming import late, live, tops


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return docs.select("doc_id", text.clean(F.col("text"), binding.STOPWORDS).alias("cleaned"))


def clean_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stages.clean_table(table(spark, sf_dir, "benchmark"), "text")


def drop_blank(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part", "p_partkey", "p_name")
    return stages.clean_rows(parts, "p_name", binding.PART_STOPWORDS).select("p_partkey", "p_name", "cleaned")


def distinct_headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = ("documents", "benchmark", "conversations")
    return stages.distinct_texts(*[table(spark, sf_dir, t).select(F.col("text").alias("headline")) for t in sources])


def nested_defaults(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "struct<k:string,absent:string>")
    events = table(spark, sf_dir, "events", "event_id", "event_type", "props").withColumn("props", props)
    k = F.col("props.k")
    given = (
        F.when(F.col("event_type") == "error", F.concat(k, F.lit("a")))
        .when(F.col("event_type") == "click", F.concat(F.lit("-"), k))
        .when(F.col("event_type") != "view", k)
    )
    return events.select(
        "event_id",
        values.strict_count(k).alias("views"),
        values.strict_count(F.col("props.absent")).alias("likes"),
        values.digits_or_zero(given).alias("comment_count"),
    )


def iso_duration(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, q = "cast(l_linenumber as string)", "cast(cast(l_quantity as int) as string)"
    written = F.expr(
        f"case l_linenumber % 5 when 0 then 'PT' || {q} || 'M' || {n} || 'S' when 1 then 'P' || {n} || 'DT' || {q} || 'H'"
        f" when 2 then 'P' || {n} || 'W' when 3 then 'PT' || {q} || '.5S' else 'bad' || {q} end"
    )
    lines = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_quantity")
    timed = lines.withColumn("duration", written).withColumn("seconds", values.iso_seconds(F.col("duration")))
    long = F.coalesce(F.col("seconds") > ranking.MIN_SECONDS, F.lit(False))
    return timed.select("l_orderkey", "l_linenumber", "duration", "seconds", long.alias("long_enough"))


def eligible_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem", "l_partkey").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    parts = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_size", "p_retailprice")
    details = parts.join(lines, F.col("p_partkey") == F.col("l_partkey"), "left").select(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        F.when(F.col("p_size") % 7 != 0, F.floor("p_retailprice").cast("string")).alias("views"),
        F.col("n").cast("string").alias("comments"),
        F.format_string("PT%dS", F.col("p_size") * 3).alias("duration"),
    )
    return ranking.eligible_videos(details)


def recent_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events", "event_id", "ts", "event_type")
    newest = events.agg(F.max("ts")).scalar()
    return ranking.recent(events, "ts", newest, days=7)


def matching_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.matching(table(spark, sf_dir, "part", "p_partkey", "p_name"), "p_name", "Widget")


def _orders(spark: SparkSession, sf_dir: str, key: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice")
    return orders.select(
        F.col(key).alias("id"), F.col("o_totalprice").alias("view_count"), F.col("o_orderkey").alias("arrival")
    )


def top_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_videos(_orders(spark, sf_dir, "o_orderkey"), landed=["arrival"])


def top_videos_dedupe_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_videos(_orders(spark, sf_dir, "o_custkey"), dedupe="before", landed=["arrival"])


def top_videos_dedupe_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_videos(_orders(spark, sf_dir, "o_custkey"), dedupe="after", landed=["arrival"])


LINE = ["l_partkey", "l_extendedprice", "l_orderkey", "l_linenumber", "l_quantity"]
LINE_ORDER = [F.desc, F.asc, F.asc, F.asc]


def _line_order():
    return [direction(c) for direction, c in zip(LINE_ORDER, LINE[1:])]


def top_comments_per_video(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.top_per_group(table(spark, sf_dir, "lineitem", *LINE), ["l_partkey"], _line_order(), 5)


def detail_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "lineitem", "l_partkey").select(F.col("l_partkey").alias("p_partkey"))
    return ranking.with_details(ids, table(spark, sf_dir, "part"), "p_partkey")


def top_video_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = table(spark, sf_dir, "part", "p_partkey", "p_name", "p_retailprice")
    videos = parts.select(F.col("p_partkey").alias("id"), F.col("p_name").alias("title"), F.col("p_retailprice").alias("view_count"))
    best = ranking.top_videos(videos)
    lines = table(spark, sf_dir, "lineitem", *LINE).withColumnRenamed("l_partkey", "video_id")
    comments = ranking.comments_of(best, lines)
    top = ranking.top_per_group(comments, ["video_id"], _line_order(), 5)
    return top.select("video_id", "video_title", "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


def _joined(column: str) -> Column:
    return F.array_join(column, "|").alias(column)


def _clean_documents(spark: SparkSession, sf_dir: str, *columns: str, keep_words: bool = False) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", *columns, "text")
    return stages.clean_rows(docs, "text", binding.STOPWORDS, keep_words=keep_words).drop("text")


def tag_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = stages.tag_rows(_clean_documents(spark, sf_dir), "cleaned", binding.TOPICS, binding.MODELS)
    return docs.select("doc_id", _joined("topics"), _joined("phone_models"))


def tag_topics_by_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tags.tag(F.col("cleaned"), binding.TOKEN_TOPICS, mode="token")
    return _clean_documents(spark, sf_dir).withColumn("topics", found).select("doc_id", _joined("topics"))


def tag_topics_many_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keywords.tag_words(_clean_documents(spark, sf_dir), binding.word_keywords(spark, sf_dir))
    return rows.select("doc_id", _joined("topics"))


def tag_topics_many_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = keywords.tag_anywhere(_clean_documents(spark, sf_dir), binding.word_keywords(spark, sf_dir))
    return rows.select("doc_id", _joined("topics"))


def page_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "html")
    rows = stages.tag_rows(stages.clean_rows(pages, "html"))
    return rows.select("page_id", _joined("topics"), _joined("phone_models"))


def page_topics_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "html")
    rows = stages.tag_rows(stages.clean_rows(pages, "html"), normalize_keywords=True)
    return rows.select("page_id", _joined("topics"))


def mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return stages.clean_rows(docs, "text", binding.STOPWORDS, mention=binding.MENTION).select("doc_id", "cleaned")


def _scored(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    docs = _clean_documents(spark, sf_dir, keep_words=True)
    options = {"rules": binding.RULES, **options}
    scored = scoring.score(docs, binding.valences(spark), **options)
    return scored.select("doc_id", "compound", polarity.label(F.col("compound")).alias("sentiment"))


def sentiment_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir)


def sentiment_each_occurrence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, repeats="each")


def sentiment_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, repeats="each", rules=binding.PHRASE_RULES)


def sentiment_by_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _scored(spark, sf_dir, inline_limit=0)


def sentiment_own_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _written(_clean_documents(spark, sf_dir, keep_words=True).drop("cleaned"))
    scored = scoring.score(docs, _written(binding.own_valences(docs)), rules=binding.RULES)
    return scored.select("doc_id", "compound", polarity.label(F.col("compound")).alias("sentiment"))


def labelled_documents(spark: SparkSession, sf_dir: str, tags: bool = True) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "lang", "source", "text")
    return opinions.label_texts(docs, "text", binding.valences(spark), binding.SETTINGS, tags=tags)


def sentiment_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = report.sentiment_distribution(labelled_documents(spark, sf_dir, tags=False), ["source"])
    return shares.withColumn("share", F.round("share", 6))


def sentiment_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = report.sentiment_distribution(labelled_documents(spark, sf_dir, tags=False))
    return shares.select("sentiment", "count", report.percent(F.col("share")).alias("percent"))


def topic_sentiment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.topic_counts(labelled_documents(spark, sf_dir))


def topic_sentiment_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.topic_matrix(labelled_documents(spark, sf_dir))


def topic_sentiment_matrix_by_lang(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.topic_matrix(labelled_documents(spark, sf_dir), ["lang"])


def _store_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = labelled_documents(spark, sf_dir)
    return rows.select("text", "cleaned", "phone_models", "topics", "sentiment", F.col("lang").alias("source"))


def _flat(rows: DataFrame, *columns: str) -> DataFrame:
    return rows.select("text", "cleaned", _joined("phone_models"), _joined("topics"), "sentiment", *columns)


def jsonl_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    sinks.write_jsonl(_store_rows(spark, sf_dir).drop("source"), path)
    return _flat(tables.read_jsonl(spark, path, schemas.LABELLED))


def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    raw = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("string").alias("video_id"), F.col("role").alias("video_title"), F.col("text").alias("comment")
    )
    sinks.write_csv(raw, path)
    return tables.read_csv(spark, path, schemas.RAW_COMMENTS)


def _written(rows: DataFrame) -> DataFrame:
    """``rows`` once written and read back, for queries that use them several times."""
    path = workspace(rows.sparkSession)
    rows.write.option("compression", sinks.COMPRESSION).parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def append_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, rows = workspace(spark), _written(_store_rows(spark, sf_dir))
    for batch in ("w1", "w2", "w2"):
        sinks.write_store(rows, path, batch)
    stored = tables.read_store(spark, path)
    return stored.groupBy("source", "batch", "sentiment").agg(F.count(F.lit(1)).alias("count"))


def replace_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second writing of ``w2`` has no French rows, so none of the first may stay."""
    path, rows = workspace(spark), _written(_store_rows(spark, sf_dir))
    sinks.write_store(rows, path, "w1", "replace")
    sinks.write_store(rows, path, "w2", "replace")
    sinks.write_store(rows.where("source <> 'fr'"), path, "w2", "replace")
    return _flat(tables.read_store(spark, path), "source", "batch")


def landed_headlines(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = workspace(spark)
    binding.land_listings(spark, sf_dir, path)
    return stages.distinct_texts(landed.headlines(landed.read_pages(spark, path, schemas.LISTING)))


def _landed(spark: SparkSession, sf_dir: str, listings: bool = True) -> str:
    path = workspace(spark)
    binding.land_conversations(spark, sf_dir, path, listings)
    return path


def landed_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed(spark, sf_dir, listings=False)
    ids = landed.video_ids(landed.read_pages(spark, f"{path}/search", schemas.SEARCH_PAGE))
    details = landed.video_details(landed.read_pages(spark, f"{path}/details", schemas.DETAIL_PAGE))
    found = ranking.recent(ranking.with_details(ids, details), "published_at", binding.ANCHOR)
    return ranking.eligible_videos(found).select(
        "id", "title", "view_count", "comment_count", "comments_enabled", "duration", "page_no"
    )


def landed_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _landed(spark, sf_dir, listings=False)
    return landed.video_comments(landed.read_pages(spark, f"{path}/comments", schemas.COMMENT_PAGE))


def _talks(spark: SparkSession, sf_dir: str, bad_likes: bool = False) -> str:
    path = workspace(spark)
    binding.land_talks(spark, sf_dir, path, bad_likes)
    return path


def landed_page_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chains.faults(landed.read_pages(spark, _talks(spark, sf_dir), schemas.COMMENT_PAGE), ["video_id"])


def landed_comments_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = landed.read_pages(spark, _talks(spark, sf_dir), schemas.COMMENT_PAGE)
    return landed.video_comments(chains.once(pages, ["video_id"]))


def rejected_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comments that could be read, and those that could not with the reason."""
    read = rejects.video_comments(spark, _talks(spark, sf_dir, bad_likes=True))
    text = F.get_json_object("raw", "$.snippet.topLevelComment.snippet.textDisplay")
    bad = read.rejected.select(text.alias("text"), F.lit(None).cast("long").alias("likes"), F.array_join("reasons", "|").alias("reasons"))
    return read.kept.select("text", "likes", F.lit("").alias("reasons")).unionByName(bad)


def compacted_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of a stream put together, one replaced before, with what was written and not committed cleared away."""
    path, rows = workspace(spark), _written(_store_rows(spark, sf_dir))
    for number, part in enumerate(("en", "de", "fr")):
        sinks.write_store(rows.where(F.col("source") == part), path, f"live-{number}", "replace")
    sinks.write_store(rows.where("source = 'es'"), path, "live-1", "replace")
    sinks.compact(spark, path, "live-", "week")
    sinks.vacuum(spark, path)
    return _flat(tables.read_store(spark, path), "source", "batch")


def labels_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word list as a table: stop words and topics of the benchmark, models, valences."""
    models = spark.createDataFrame([(n, m) for n, m in enumerate(binding.MODELS)], "rank int, model string")
    settings = opinions.Settings(
        stopwords=binding.short_words(spark, sf_dir), topics=binding.word_keywords(spark, sf_dir), models=models, rules=binding.RULES
    )
    rows = opinions.label_texts(table(spark, sf_dir, "documents", "doc_id", "text"), "text", binding.valences(spark), settings)
    return rows.select("doc_id", "cleaned", _joined("topics"), _joined("phone_models"), "sentiment")


def _refreshed(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Reports over a store that grows and changes between two looks at it."""
    path, folder, rows = workspace(spark), workspace(spark), _written(_store_rows(spark, sf_dir))
    sinks.write_store(rows, path, "w1")
    sinks.write_store(rows, path, "w2")
    summaries.refresh(spark, path, folder)
    sinks.write_store(rows.where("source <> 'fr'"), path, "w2", "replace")
    sinks.write_store(rows.where("source = 'en'"), path, "w3")
    return summaries.reports(spark, path, folder)


def refreshed_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir)[0].withColumn("share", F.round("share", 6))


def refreshed_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _refreshed(spark, sf_dir)[1]


def conversation_opinions(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, store = _landed(spark, sf_dir), workspace(spark)
    opinions.run(spark, folder, store, "w1", binding.ANCHOR, binding.valences(spark), binding.CHAIN)
    return _flat(tables.read_store(spark, store), "source", "batch")


def _reported(spark: SparkSession, sf_dir: str) -> str:
    folder, store, out = _landed(spark, sf_dir), workspace(spark), workspace(spark)
    opinions.run(spark, folder, store, "w1", binding.ANCHOR, binding.valences(spark), binding.CHAIN, "replace")
    opinions.write_reports(spark, store, out)
    return out


def conversation_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{_reported(spark, sf_dir)}/matrix/parquet")


def conversation_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "source string, sentiment string, count long, share double, percent string"
    written = spark.read.schema(schema).csv(f"{_reported(spark, sf_dir)}/distribution/csv", header=True)
    return written.select("source", "sentiment", "count", "percent")


def exported_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder, out = _landed(spark, sf_dir), workspace(spark)
    headlines, comments = opinions.read_batch(spark, folder, binding.ANCHOR, binding.CHAIN)
    opinions.export_stages(headlines, comments, binding.valences(spark), out, binding.CHAIN, compression="gzip")
    tagged = [
        tables.read_jsonl(spark, f"{out}/{name}/tagged", schemas.TAGGED).withColumn("source", F.lit(name))
        for name in (opinions.HEADLINES, opinions.COMMENTS)
    ]
    return tagged[0].unionByName(tagged[1]).select("source", "text", "cleaned", _joined("phone_models"), _joined("topics"))


def top_videos_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dearest orders, too many to rank in one task."""
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_totalprice")
    return selection.first_rows(orders, F.floor("o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], binding.MANY)


def top_comments_many(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The largest lines of each state, few states with a large part of all rows each; most quantities are tied."""
    lines = table(spark, sf_dir, "lineitem", "l_returnflag", "l_quantity", "l_orderkey", "l_linenumber")
    order = [F.desc("l_quantity"), F.asc("l_orderkey"), F.asc("l_linenumber")]
    return selection.first_per_group(lines, ["l_returnflag"], F.floor("l_quantity"), order, binding.MANY)


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The files of a table as a stream; as a pattern, for a table may be one file or a folder of files."""
    schema = table(spark, sf_dir, name).schema
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{{{name}}}.parquet")


def stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, checkpoint = workspace(spark), workspace(spark)
    events = _stream(spark, sf_dir, "events")
    live.run_available(live.windowed_counts(events, "ts", ["event_type"], "1 day", "1 hour"), path, checkpoint)
    return live.latest_counts(spark, path)


def _labelled_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return live.label_stream(_stream(spark, sf_dir, "documents"), "text", binding.valences(spark), binding.SETTINGS)


def stream_sentiment_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as if one came every ten minutes, their ids being the order."""
    path, checkpoint = workspace(spark), workspace(spark)
    rows = _labelled_stream(spark, sf_dir).withColumn("ts", F.timestamp_seconds(F.lit(binding.FIRST_SECOND) + F.col("doc_id") * 600))
    live.run_available(live.windowed_counts(rows, "ts", ["source", "sentiment"], "1 day", "1 hour"), path, checkpoint)
    counts = live.latest_counts(spark, path)
    return counts.select(F.unix_timestamp("window_start").alias("window_start"), "source", "sentiment", "count")


def stream_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    store, checkpoint = workspace(spark), workspace(spark)
    rows = _labelled_stream(spark, sf_dir)
    rows = rows.select("text", "cleaned", "phone_models", "topics", "sentiment", F.col("lang").alias("source"))
    live.into_store(rows, store, checkpoint, "documents").awaitTermination()
    return _flat(tables.read_store(spark, store), "source")


def two_streams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams into one store, each with the same micro-batch numbers, labelled in their micro-batches."""
    store = workspace(spark)
    docs = _stream(spark, sf_dir, "documents").withColumn("source", F.col("lang"))
    talks = _stream(spark, sf_dir, "conversations").select("text", F.col("role").alias("source"))
    for rows, name in ((docs, "documents"), (talks, "talks")):
        live.label_into_store(
            rows, "text", binding.valences(spark), store, workspace(spark), name, binding.SETTINGS
        ).awaitTermination()
    return _flat(tables.read_store(spark, store), "source")


def _in_rounds(spark: SparkSession, rows: DataFrame, number: Column, start: Callable) -> None:
    """Rows that land in three rounds, in the order of their number, each read by the same stream before the next lands."""
    folder = workspace(spark)
    for n in range(3):
        rows.where(number == n).write.mode("append").parquet(folder)
        start(spark.readStream.schema(rows.schema).parquet(folder)).awaitTermination()


def stream_top_comments(spark: SparkSession, sf_dir: str) -> DataFrame:
    path, checkpoint = workspace(spark), workspace(spark)
    lines = table(spark, sf_dir, "lineitem", "l_partkey", "l_extendedprice", "l_orderkey", "l_linenumber", "l_quantity")
    order = [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber"), F.asc("l_quantity")]
    start = lambda stream: tops.into_tops(stream, path, checkpoint, ["l_partkey"], order, 5)
    _in_rounds(spark, lines, F.col("l_orderkey") % 3, start)
    tops.fold(spark, path, lines.schema, ["l_partkey"])
    return tops.tops(spark, path, lines.schema, ["l_partkey"])


def stream_late_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of which a third lands after its time, by the day of the month."""
    path, checkpoint = workspace(spark), workspace(spark)
    events = table(spark, sf_dir, "events", "event_id", "ts", "event_type")
    start = lambda stream: late.into_counts(stream, "ts", ["event_type"], "1 day", "36 hours", path, checkpoint)
    _in_rounds(spark, events, F.pmod(F.col("event_id") * 7 + F.dayofmonth("ts"), F.lit(3)), start)
    return late.counts(spark, path, ["event_type"])


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        clean_text, clean_benchmark, drop_blank, distinct_headlines, nested_defaults, iso_duration, eligible_videos,
        recent_items, matching_titles, top_videos, top_videos_dedupe_before, top_videos_dedupe_after,
        top_comments_per_video, detail_lookup, top_video_comments, tag_topics, tag_topics_by_word, page_topics,
        page_topics_normalized, mentions, sentiment_label, sentiment_each_occurrence, sentiment_phrases,
        sentiment_by_join, sentiment_own_words, sentiment_distribution, sentiment_share, topic_sentiment_counts, topic_sentiment_matrix,
        topic_sentiment_matrix_by_lang, jsonl_roundtrip, csv_export, append_batches, replace_batches,
        tag_topics_many_words, tag_topics_many_substrings, compacted_batches, landed_page_faults, landed_comments_once, rejected_comments,
        labels_from_tables, refreshed_shares, refreshed_matrix,
        landed_headlines, landed_videos, landed_comments, conversation_opinions, conversation_report,
        top_videos_many, top_comments_many, stream_top_comments, stream_late_windows,
        conversation_distribution, exported_tags, stream_windows, stream_sentiment_windows, stream_labels, two_streams,
    )
}
