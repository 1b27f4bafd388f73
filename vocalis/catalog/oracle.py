"""The queries once more, as DuckDB SQL over the same tables."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from vocalis import lexicons
from vocalis.catalog import binding
from vocalis.lexicons import PolarityRules


def _q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _list(items: Iterable[str]) -> str:
    return ", ".join(_q(x) for x in items)


def words(text: str, stopwords: Sequence[str]) -> str:
    no_keycap = rf"regexp_replace({text}, '[0-9#*]\x{{FE0F}}?\x{{20E3}}', ' ', 'g')"
    ascii_only = f"lower(regexp_replace({no_keycap}, '[^A-Za-z0-9]+', ' ', 'g'))"
    return f"list_filter(string_split({ascii_only}, ' '), lambda w: w <> '' and w not in ({_list(stopwords)}))"


def cleaned(source: str, text: str, stopwords: Sequence[str], name: str = "c") -> str:
    """CTEs giving ``name``: the rows of ``source`` with ``words`` and ``cleaned``, blanks dropped."""
    return (
        f"{name}_all as (select *, {words(text, stopwords)} as words from {source} where {text} is not null), "
        f"{name} as (select *, array_to_string(words, ' ') as cleaned from {name}_all where len(words) > 0)"
    )


def tag_list(text: str, topics: Mapping[str, Sequence[str]]) -> str:
    cases = [
        f"case when {' or '.join(f'contains({text}, {_q(k)})' for k in keywords)} then {_q(topic)} end"
        for topic, keywords in topics.items()
    ]
    return f"list_filter([{', '.join(cases)}], lambda x: x is not null)"


def tag_string(text: str, topics: Mapping[str, Sequence[str]]) -> str:
    return f"array_to_string({tag_list(text, topics)}, '|')"


MODEL_TOPICS = {m: [m] for m in binding.MODELS}
DEFAULT_MODEL_TOPICS = {m: [m] for m in lexicons.PHONE_MODELS}


def scored(source: str, key: str, rules: PolarityRules, repeats: str, lexicon: str | None = None) -> str:
    """CTEs that end in ``s``: the rows of ``source`` (which has ``words``) with ``compound`` and ``sentiment``.

    ``lexicon`` selects (token, valence) rows that take the place of the short list.
    """

    def number(value: float) -> str:
        return f"{value}::double"

    listed = {} if lexicon else binding.VALENCES
    tokens = sorted({*listed, *rules.boosters, *rules.negators})
    roles = ", ".join(
        "({}, {}, {}, {})".format(
            _q(t),
            number(listed[t]) if t in listed else "null::double",
            number(rules.boosters[t]) if t in rules.boosters else "null::double",
            number(lexicons.NEGATION_WEIGHT) if t in rules.negators else "null::double",
        )
        for t in tokens
    )
    sql = [
        f"role(token, valence, boost, factor) as (select * from (values {roles})"
        + (f" union all select token, valence, null::double, null::double from ({lexicon}))" if lexicon else ")"),
        f"t0 as (select {key}, list_filter(words, lambda w: length(w) > 1) as l from {source})",
        f"t1 as (select {key}, unnest(l) as token, unnest(range(len(l))) as pos from t0)",
        f"t2 as (select t1.*, valence, boost, factor from t1 left join role using (token))",
        "t3 as (select *, "
        + ", ".join(
            f"lag({c}, {n}) over w as {c}{n}" for n in (1, 2, 3) for c in ("token", "valence", "boost", "factor")
        )
        + f", lead(token, 1) over w as next1, lead(token, 2) over w as next2 from t2 window w as (partition by {key} order by pos))",
    ]
    emphatic = _list(rules.emphatic)
    emphasis = {1: "false", 2: "false", 3: "false"}
    if rules.emphatic:
        emphasis[2] = f"coalesce(token2 = 'never' and token1 in ({emphatic}), false)"
        emphasis[3] = (
            f"(coalesce(token3 = 'never' and token2 in ({emphatic}), false) or coalesce(token1 in ({emphatic}), false))"
        )
    value, step = "valence", 3
    for n, weight, strong in zip((1, 2, 3), lexicons.DISTANCE_WEIGHTS, lexicons.EMPHASIS_WEIGHTS):
        boost = f"coalesce(boost{n}, 0.0::double) * {number(weight)}"
        sql.append(
            f"t{step + 1} as (select *, case when token{n} is not null and valence{n} is null then "
            f"({value} + case when {value} < 0 then -({boost}) else {boost} end) * "
            f"case when {emphasis[n]} then {number(strong)} else coalesce(factor{n}, 1.0::double) end "
            f"else {value} end as v{n} from t{step} {'where valence is not null' if n == 1 else ''})"
        )
        value, step = f"v{n}", step + 1
    spans = [
        "token || ' ' || next1 || ' ' || next2", "token || ' ' || next1", "token1 || ' ' || token",
        "token2 || ' ' || token1 || ' ' || token", "token2 || ' ' || token1",
        "token3 || ' ' || token2 || ' ' || token1", "token3 || ' ' || token2",
    ]
    late = value
    if rules.idioms:
        whens = " ".join(f"when {_q(p)} then {number(v)}" for p, v in rules.idioms.items())
        late = f"coalesce({', '.join(f'case {s} {whens} end' for s in spans)}, {late})"
    if rules.booster_pairs:
        pairs = _list(rules.booster_pairs)
        hit = f"coalesce(({spans[-1]}) in ({pairs}), false) or coalesce(({spans[4]}) in ({pairs}), false)"
        late = f"{late} - case when {hit} then {number(lexicons.INTENSIFY)} else 0.0::double end"
    least = (
        "coalesce(token1 = 'least' and valence1 is null and coalesce(token2 not in ('at', 'very'), true), false)"
    )
    sql.append(
        f"u as (select {key}, token, pos, cast(round_even(case when boost is not null then 0.0::double else "
        f"(case when token3 is not null and valence3 is null then {late} else {value} end) * "
        f"case when {least} then {number(lexicons.NEGATION_WEIGHT)} else 1.0::double end end * 1e9, 0) as bigint) as units "
        f"from t{step})"
    )
    if repeats == "first":
        sql.append(f"u1 as (select {key}, token, count(*) * arg_min(units, pos) as units from u group by {key}, token)")
    else:
        sql.append("u1 as (select * from u)")
    sql.append(f"u2 as (select {key}, cast(sum(units) as double) / 1e9 as total from u1 group by {key})")
    sql.append(
        f"s0 as (select x.*, coalesce(total, 0.0::double) as total from {source} x left join u2 using ({key})), "
        "s1 as (select *, round(total / sqrt(total * total + 15.0::double), 4) as compound from s0), "
        "s as (select *, case when compound > 0.2::double then 'Positive' when compound < -0.2::double then 'Negative' "
        "else 'Neutral' end as sentiment from s1)"
    )
    return ", ".join(sql)


DOCS = cleaned("documents", "text", binding.STOPWORDS)
LABELLED = (
    f"with {DOCS}, {scored('c', 'doc_id', binding.RULES, 'first')}, "
    f"labelled as (select *, {tag_list('cleaned', binding.TOPICS)} as topics, "
    f"{tag_list('cleaned', MODEL_TOPICS)} as phone_models from s) "
)
FLAT = "text, cleaned, array_to_string(phone_models, '|') as phone_models, array_to_string(topics, '|') as topics, sentiment"
MATRIX = ", ".join(f"count(*) filter (sentiment = '{x}') as {_x}" for x, _x in
                   (("Negative", '"Negative"'), ("Neutral", '"Neutral"'), ("Positive", '"Positive"')))
UNNESTED = "(select *, unnest(topics) as topic from {source})"


def _sentiment(rules: PolarityRules, repeats: str) -> str:
    return f"with {DOCS}, {scored('c', 'doc_id', rules, repeats)} select doc_id, compound, sentiment from s"


_OWN = (
    "select token, ((length(token) * 7 + ascii(token) + ascii(right(token, 1))) % 9 - 4) / 2.0::double as valence from "
    f"(select distinct unnest(words) as token from c) where token not in ({_list([*binding.RULES.boosters, *binding.RULES.negators])}) "
    "and (length(token) * 7 + ascii(token) + ascii(right(token, 1))) % 9 <> 4"
)
_LISTED = "(lang in ('en', 'de', 'fr'))"
_TALKS = (
    "talks as (select conv_id, sum(length(text)) as view_count, count(*) as n from conversations group by conv_id), "
    "fit as (select * from talks where conv_id % 40 <= 30 and n * 30 > 60 and n > 0)"
)
_CHAIN = (
    f"with {_TALKS}, best as (select * from fit order by view_count desc, cast(conv_id as varchar) limit 50), "
    "ranked as (select v.text, row_number() over (partition by conv_id order by length(v.text) desc, turn // 100, turn % 100) "
    "as rn from conversations v join best using (conv_id)), "
    "heads as (select distinct text from documents where " + _LISTED + "), "
    "raw as (select row_number() over () as id, * from ("
    "select text, 'comments' as source from ranked where rn <= 5 union all select text, 'headlines' as source from heads)), "
    + cleaned("raw", "text", binding.STOPWORDS)
    + ", d as (select * from c where source = 'comments' or contains(cleaned, 'tion')), "
    + scored("d", "id", binding.RULES, "first")
    + f", labelled as (select *, {tag_list('cleaned', binding.TOPICS)} as topics, "
    f"{tag_list('cleaned', MODEL_TOPICS)} as phone_models from s) "
)

_DURATION = (
    "case l_linenumber % 5 when 0 then 'PT' || q || 'M' || n || 'S' when 1 then 'P' || n || 'DT' || q || 'H' "
    "when 2 then 'P' || n || 'W' when 3 then 'PT' || q || '.5S' else 'bad' || q end"
)
_SECONDS = (
    "case l_linenumber % 5 when 0 then qi * 60.0 + l_linenumber when 1 then l_linenumber * 86400.0 + qi * 3600 "
    "when 2 then l_linenumber * 604800.0 when 3 then qi + 0.5 end"
)
_ORDERS_LATEST = (
    "select id, view_count, arrival from (select o_custkey as id, o_totalprice as view_count, o_orderkey as arrival, "
    "row_number() over (partition by o_custkey order by o_orderkey desc, o_totalprice desc) as rn from orders) where rn = 1"
)
_LINE_RANK = (
    "row_number() over (partition by l_partkey order by l_extendedprice desc, l_orderkey, l_linenumber, l_quantity) as rn"
)

_KEYWORDS = (
    "k as (select distinct keyword, (1 + length(keyword) - length(replace(keyword, ' ', ''))) || keyword[1] as topic from "
    "(select unnest(words) as keyword from b union all select words[i] || ' ' || words[i + 1] from (select words, unnest(range(1, len(words))) as i from b)))"
)
#: The keyword list of the benchmark, and the documents' tags where ``found`` says whether a keyword is in one.
_MANY = (
    f"with {DOCS}, {cleaned('benchmark', 'text', binding.STOPWORDS, 'b')}, "
    f"{_KEYWORDS}, "
    "hit as (select distinct doc_id, topic from c join k on {found}) "
    "select doc_id, coalesce((select string_agg(topic, '|' order by topic) from hit where hit.doc_id = c.doc_id), '') as topics from c"
)
_THREE = "store as (select * exclude (source), lang as source from labelled, (values ('w1'), ('w2'), ('w3')) b(batch) where batch = 'w1' or (batch = 'w2' and lang <> 'fr') or (batch = 'w3' and lang = 'en'))"
#: Word lists as tables: stop words of the benchmark, and its keywords as above.
_TABLES = (
    f"with stop as (select distinct w from (select unnest({words('text', [''])}) as w from benchmark) where length(w) <= 3), "
    f"e as (select doc_id, unnest(w) as w, unnest(range(len(w))) as pos from (select doc_id, {words('text', [''])} as w from documents where text is not null)), "
    "c as (select doc_id, list(w order by pos) as words, string_agg(w, ' ' order by pos) as cleaned from e where w not in (select w from stop) group by doc_id), "
    f"{cleaned('benchmark', 'text', binding.STOPWORDS, 'b')}, {_KEYWORDS}, hit as (select distinct doc_id, topic from c join k on contains(cleaned, keyword)), "
    f"{scored('c', 'doc_id', binding.RULES, 'first')} "
    "select doc_id, cleaned, coalesce((select string_agg(topic, '|' order by topic) from hit where hit.doc_id = s.doc_id), '') as topics, "
    f"{tag_string('cleaned', MODEL_TOPICS)} as phone_models, sentiment from s"
)
#: Pages of talks that landed: number, last number of the chain, and the turns on them.
_TALK_PAGES = (
    f"t as (select *, cast(turn // {binding.TURNS} as int) as page_no, max(turn) over (partition by conv_id) // {binding.TURNS} as last, "
    f"row_number() over (partition by conv_id, turn // {binding.TURNS} order by turn) - 1 as pos from conversations), "
    "landed as (select *, (conv_id * 7 + page_no * 3) % 11 as fate from t where (conv_id * 7 + page_no * 3) % 11 <> 3), "
    "p as (select distinct conv_id, page_no, last, fate from landed)"
)

ORACLE: dict[str, str] = {
    "clean_text": f"select doc_id, array_to_string({words('text', binding.STOPWORDS)}, ' ') as cleaned from documents",
    "clean_benchmark": f"with {cleaned('benchmark', 'text', lexicons.STOPWORDS)} select text, cleaned as cleaned_text from c",
    "drop_blank": f"with {cleaned('part', 'p_name', binding.PART_STOPWORDS)} select p_partkey, p_name, cleaned from c",
    "distinct_headlines": "select text as headline from documents union select text from benchmark "
    "union select text from conversations",
    "nested_defaults": "with e as (select event_id, event_type, json_extract_string(props, '$.k') as k, "
    "json_extract_string(props, '$.absent') as a from events), g as (select *, case event_type when 'error' then k || 'a' "
    "when 'click' then '-' || k when 'view' then null else k end as given from e) "
    "select event_id, coalesce(try_cast(k as bigint), 0) as views, coalesce(try_cast(a as bigint), 0) as likes, "
    "case when regexp_full_match(given, '[0-9]+') then cast(given as bigint) else 0 end as comment_count from g",
    "iso_duration": "with l as (select *, cast(l_linenumber as varchar) as n, cast(cast(l_quantity as int) as varchar) as q, "
    f"cast(l_quantity as int) as qi from lineitem), d as (select l_orderkey, l_linenumber, {_DURATION} as duration, "
    f"cast({_SECONDS} as double) as seconds from l) select *, coalesce(seconds > 60, false) as long_enough from d",
    "eligible_videos": "with n as (select l_partkey, count(*) as n from lineitem group by l_partkey) "
    "select p_partkey as id, p_name as title, case when p_size % 7 <> 0 then cast(floor(p_retailprice) as bigint) else 0 end "
    "as view_count, n as comment_count, true as comments_enabled, cast(p_size * 3 as double) as duration "
    "from part join n on l_partkey = p_partkey where p_size * 3 > 60",
    "recent_items": "select event_id, ts, event_type from events where ts >= (select max(ts) from events) - interval 7 day",
    "matching_titles": "select p_partkey, p_name from part where contains(lower(p_name), 'widget')",
    "top_videos": "select o_orderkey as id, o_totalprice as view_count, o_orderkey as arrival from orders "
    "order by o_totalprice desc, o_orderkey limit 50",
    "top_videos_dedupe_before": f"{_ORDERS_LATEST} order by view_count desc, id limit 50",
    "top_videos_dedupe_after": "with best as (select *, row_number() over (order by o_totalprice desc, o_custkey, o_orderkey) "
    "as place from orders qualify place <= 50) select o_custkey as id, arg_max(o_totalprice, place) as view_count, "
    "arg_max(o_orderkey, place) as arrival from best group by o_custkey",
    "top_comments_per_video": "select l_partkey, l_extendedprice, l_orderkey, l_linenumber, l_quantity from "
    f"(select *, {_LINE_RANK} from lineitem) where rn <= 5",
    "stream_top_comments": "select l_partkey, l_extendedprice, l_orderkey, l_linenumber, l_quantity from "
    f"(select *, {_LINE_RANK} from lineitem) where rn <= 5",
    "top_videos_many": f"select o_orderkey, o_totalprice from orders order by o_totalprice desc, o_orderkey limit {binding.MANY}",
    "top_comments_many": "select l_returnflag, l_quantity, l_orderkey, l_linenumber from lineitem qualify row_number() over "
    f"(partition by l_returnflag order by l_quantity desc, l_orderkey, l_linenumber) <= {binding.MANY}",
    "stream_late_windows": "with e as (select ts, event_type, date_trunc('day', ts)::timestamp as window_start, "
    "(date_trunc('day', ts) + interval 1 day)::timestamp as window_end, (event_id * 7 + day(ts)) % 3 as r from events), "
    "m as (select r, max(ts) as greatest from e group by r), "
    "l as (select e.*, coalesce(window_end <= (select max(greatest) from m where m.r < e.r) - interval 36 hours, false) as late from e) "
    "select window_start, window_end, event_type, count(*) filter (not late) as on_time, count(*) filter (late) as late, "
    "count(*) as count from l group by all",
    "detail_lookup": "select * from part where p_partkey in (select l_partkey from lineitem)",
    "top_video_comments": "with v as (select p_partkey, p_name from part order by p_retailprice desc, p_partkey limit 50) "
    "select l_partkey as video_id, p_name as video_title, l_orderkey, l_linenumber, l_quantity, l_extendedprice from "
    f"(select *, {_LINE_RANK} from lineitem join v on l_partkey = p_partkey) where rn <= 5",
    "tag_topics": f"with {DOCS} select doc_id, {tag_string('cleaned', binding.TOPICS)} as topics, "
    f"{tag_string('cleaned', MODEL_TOPICS)} as phone_models from c",
    "tag_topics_by_word": f"with {DOCS} select doc_id, array_to_string(list_filter(["
    + ", ".join(
        "case when "
        + " or ".join(rf"regexp_matches(cleaned, '\b{k}\b')" for k in ks)
        + f" then '{t}' end"
        for t, ks in binding.TOKEN_TOPICS.items()
    )
    + "], lambda x: x is not null), '|') as topics from c",
    "page_topics": f"with {cleaned('pages', 'html', lexicons.STOPWORDS)} "
    f"select page_id, {tag_string('cleaned', lexicons.TOPICS)} as topics, "
    f"{tag_string('cleaned', DEFAULT_MODEL_TOPICS)} as phone_models from c",
    "page_topics_normalized": f"with {cleaned('pages', 'html', lexicons.STOPWORDS)} select page_id, "
    + tag_string("cleaned", {t: [k.lower().replace("-", " ") for k in ks] for t, ks in lexicons.TOPICS.items()})
    + " as topics from c",
    "mentions": f"with {DOCS} select doc_id, cleaned from c where contains(cleaned, '{binding.MENTION}')",
    "sentiment_label": _sentiment(binding.RULES, "first"),
    "sentiment_each_occurrence": _sentiment(binding.RULES, "each"),
    "sentiment_phrases": _sentiment(binding.PHRASE_RULES, "each"),
    "sentiment_by_join": _sentiment(binding.RULES, "first"),
    "sentiment_own_words": f"with {DOCS}, {scored('c', 'doc_id', binding.RULES, 'first', _OWN)} "
    "select doc_id, compound, sentiment from s",
    "sentiment_distribution": LABELLED + "select source, sentiment, count(*) as count, "
    "round(count(*)::double / sum(count(*)) over (partition by source)::double, 6) as share from labelled group by source, sentiment",
    "sentiment_share": LABELLED + "select sentiment, count(*) as count, "
    "printf('%.1f%%', count(*)::double / sum(count(*)) over ()::double * 100) as percent from labelled group by sentiment",
    "topic_sentiment_counts": LABELLED + "select topic, sentiment, count(*) as count from "
    + UNNESTED.format(source="labelled") + " group by topic, sentiment",
    "topic_sentiment_matrix": LABELLED + f"select topic, {MATRIX} from " + UNNESTED.format(source="labelled")
    + " group by topic",
    "topic_sentiment_matrix_by_lang": LABELLED + f"select lang, topic, {MATRIX} from "
    + UNNESTED.format(source="labelled") + " group by lang, topic",
    "jsonl_roundtrip": LABELLED + f"select {FLAT} from labelled",
    "csv_export": "select cast(conv_id as varchar) as video_id, role as video_title, text as comment from conversations",
    "append_batches": LABELLED + "select lang as source, batch, sentiment, count(*) as count "
    "from labelled, (values ('w1'), ('w2'), ('w2')) b(batch) group by lang, batch, sentiment",
    "replace_batches": LABELLED + f"select {FLAT}, lang as source, batch from labelled, (values ('w1'), ('w2')) b(batch) "
    "where batch = 'w1' or lang <> 'fr'",
    "landed_headlines": f"select distinct text as headline from documents where {_LISTED}",
    "landed_videos": f"with {_TALKS} select cast(conv_id as varchar) as id, 'Talk ' || conv_id as title, "
    "cast(view_count as bigint) as view_count, n as comment_count, true as comments_enabled, "
    "cast(n * 30 as double) as duration, cast(conv_id // 50 as int) as page_no from fit",
    "landed_comments": "select cast(conv_id as varchar) as video_id, text, length(text) as likes, role as author, "
    "cast(turn // 100 as int) as page_no, cast(turn % 100 as int) as pos from conversations",
    "conversation_opinions": _CHAIN + f"select {FLAT}, source, 'w1' as batch from labelled",
    "conversation_report": _CHAIN + f"select source, topic, {MATRIX} from " + UNNESTED.format(source="labelled")
    + " group by source, topic",
    "conversation_distribution": _CHAIN + "select source, sentiment, count(*) as count, "
    "printf('%.1f%%', count(*)::double / sum(count(*)) over (partition by source)::double * 100) as percent "
    "from labelled group by source, sentiment",
    "exported_tags": _CHAIN + "select source, text, cleaned, array_to_string(phone_models, '|') as phone_models, "
    "array_to_string(topics, '|') as topics from labelled",
    "stream_sentiment_windows": LABELLED + f"select cast({binding.FIRST_SECOND} + doc_id * 600 // 86400 * 86400 as bigint) "
    "as window_start, source, sentiment, count(*) as count from labelled group by all",
    "two_streams": "with texts as (select row_number() over () as id, * from (select text, lang as source from documents "
    "union all select text, role as source from conversations)), "
    + cleaned("texts", "text", binding.STOPWORDS) + ", " + scored("c", "id", binding.RULES, "first")
    + f", labelled as (select *, {tag_list('cleaned', binding.TOPICS)} as topics, "
    f"{tag_list('cleaned', MODEL_TOPICS)} as phone_models from s) select {FLAT}, source from labelled",
    "stream_windows": "select date_trunc('day', ts)::timestamp as window_start, "
    "(date_trunc('day', ts) + interval 1 day)::timestamp as window_end, event_type, count(*) as count from events "
    "group by all",
    "tag_topics_many_words": _MANY.replace("{found}", "contains(' ' || cleaned || ' ', ' ' || keyword || ' ')"),
    "tag_topics_many_substrings": _MANY.replace("{found}", "contains(cleaned, keyword)"),
    "compacted_batches": LABELLED + f"select {FLAT}, lang as source, 'week' as batch from labelled where lang in ('en', 'es', 'fr')",
    "landed_page_faults": f"with {_TALK_PAGES}, f as (select p.*, exists (select 1 from p q where q.conv_id = p.conv_id and q.page_no = p.page_no + 1) as followed, "
    "exists (select 1 from p q where q.conv_id = p.conv_id and q.page_no = p.page_no - 1) as preceded from p) "
    "select cast(conv_id as varchar) as video_id, page_no, fault from (select *, 'next page missing' as fault from f where page_no < last and not followed "
    "union all select *, 'page before missing' from f where page_no > (select min(page_no) from p) and not preceded "
    "union all select *, 'landed again' from f where fate = 5)",
    "landed_comments_once": f"with {_TALK_PAGES} select cast(conv_id as varchar) as video_id, text, length(text) as likes, role as author, page_no, "
    "cast(pos as int) as pos from landed",
    "rejected_comments": f"with {_TALK_PAGES} select text, case when bad then null else length(text) end as likes, "
    "case when bad then 'likes are no whole number' else '' end as reasons from (select *, (conv_id + turn) % 13 = 4 as bad from landed)",
    "labels_from_tables": _TABLES,
    "refreshed_shares": LABELLED[:-1] + ", " + _THREE + " select source, sentiment, count(*) as count, "
    "round(count(*)::double / sum(count(*)) over (partition by source)::double, 6) as share from store group by source, sentiment",
    "refreshed_matrix": LABELLED[:-1] + ", " + _THREE + f" select source, topic, {MATRIX} from " + UNNESTED.format(source="store") + " group by source, topic",
    "stream_labels": LABELLED + f"select {FLAT}, lang as source from labelled",
}
