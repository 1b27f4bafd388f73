"""The queries that DuckDB SQL can express, on the same tables. The others are held against brute force in the tests."""

from vocalis.llm import common, decontaminate, mixing, near_dups, quality, urls

_LOWER = f"translate(coalesce(text, ''), '{common.UPPER}', '{common.LOWER}')"
_TOKEN = common.TOKEN
_WORD = common.WORD

_DECONTAMINATION = f"""
with doc as (select row_number() over () as r, doc_id, regexp_extract_all({_LOWER}, '{_WORD}') as w from documents),
item as (select item_id::varchar as item, regexp_extract_all({_LOWER}, '{_WORD}') as w from benchmark),
sized as (select item, w, least(len(w), {decontaminate.LENGTH}) as l from item where len(w) > 0),
win as (select distinct item, l, array_to_string(w[i:i + l - 1], ' ') as s
        from (select item, w, l, unnest(range(1, len(w) - l + 2)) as i from sized)),
grams as (select r, l, i, array_to_string(w[i:i + l - 1], ' ') as s
       from (select r, w, l, unnest(range(1, len(w) - l + 2)) as i from doc, (select distinct l from win) where len(w) >= l)),
hit as (select distinct r, i, grams.l, item from grams join win on grams.l = win.l and grams.s = win.s),
covered as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + l)) as p from hit) group by r),
items as (select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as ids from hit group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
       sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from doc left join covered using (r) left join items using (r)
"""

_NEAR_DEDUP = f"""
with recursive doc as (select doc_id, regexp_extract_all({_LOWER}, '{_TOKEN}') as w from documents),
shingles as (select distinct doc_id, array_to_string(w[i:i + least(len(w), {near_dups.SHINGLE}) - 1], ' ') as s
    from (select doc_id, w, unnest(range(1, greatest(len(w) - {near_dups.SHINGLE - 1}, 1) + 1)) as i from doc where len(w) > 0)),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (select a.doc_id as a, b.doc_id as b, count(*) as x from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all),
links as (select a, b from shared join sizes p on p.doc_id = a join sizes q on q.doc_id = b
          where 100 * x >= {near_dups.PERCENT} * (p.n + q.n - x)),
reach as (select doc_id as a, doc_id as b from doc union select reach.a, links.b from reach join links on reach.b = links.a),
lowest as (select a as doc_id, min(b) as component_id from reach group by a)
select doc_id, coalesce(n, 0)::bigint as n_shingles, component_id, doc_id = component_id as kept
from lowest left join sizes using (doc_id)
"""

_QUALITY = f"""
with doc as (select row_number() over () as r, doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '{_TOKEN}') as w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{_TOKEN}')) as lines from documents),
win as (select r, i, array_to_string(w[i:i + {quality.WINDOW - 1}], ' ') as s
        from (select r, w, unnest(range(1, len(w) - {quality.WINDOW - 2})) as i from doc where len(w) >= {quality.WINDOW})),
twice as (select r, i from win qualify count(*) over (partition by r, s) > 1),
repeats as (select r, count(distinct p) as n from (select r, unnest(range(i, i + {quality.WINDOW})) as p from twice) group by r),
measured as (select doc_id, len(w)::bigint as n_words, length(array_to_string(w, ''))::bigint as word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::bigint as n_symbols, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines,
    coalesce(n, 0)::bigint as n_repeat_words, len(lines) as n_lines,
    len(regexp_extract_all(t, '[A-Z]')) as upper, len(regexp_extract_all(t, '[a-z]')) as lower,
    len(list_filter(range(1, len(w)), lambda i: w[i] = w[i + 1])) as stutter
    from doc left join repeats using (r)),
judged as (select *, n_words < {quality.MIN_WORDS} or 100 * n_repeat_words > 30 * n_words as base_failed from measured)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    not (base_failed or 10 * n_symbols > n_words or 2 * upper > upper + lower or 5 * stutter > n_words
         or word_chars < 2 * n_words or word_chars > 12 * n_words or 2 * n_dup_lines > n_lines) as kept
from judged
"""

_MIX = f"""
with doc as (select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_TOKEN}'))::bigint as size from documents),
named as (select source, sum(size)::bigint as source_size, row_number() over (order by source nulls last) as n from doc group by source),
weighted as (select source, source_size, {list(mixing.WEIGHTS)}[((n - 1) % {len(mixing.WEIGHTS)} + 1)::int] as weight,
    {mixing.MOST} * source_size as lim from named),
levels as (select *, lim / weight as ratio,
    ({mixing.SHARE}::double * (select sum(source_size) from named)
     - coalesce(sum(lim) over (order by lim / weight, source nulls last rows between unbounded preceding and 1 preceding), 0)::double)
    / sum(weight) over (order by lim / weight, source nulls last rows between current row and unbounded following)::double as level
    from weighted),
chosen as (select level from levels where level * weight < lim order by ratio, source nulls last limit 1),
aims as (select source, source_size, coalesce(least(lim::double, weight * (select level from chosen)), lim::double) as target,
    ('0x' || substr(md5('{mixing.SEED}' || coalesce('=' || source, '')), 1, 8))::bigint / 4294967296::double as u from levels),
placed as (select doc_id, size, source_size, target, u, case when source_size > 0 then target / source_size else 0::double end as rate,
    row_number() over (partition by doc.source order by size, doc_id nulls first) - 1 as place
    from doc join aims on doc.source is not distinct from aims.source)
select doc_id, size, source_size, target, ((floor(rate * (place + 1) + u) - floor(rate * place + u)) * size)::bigint as taken from placed
"""


def _url_levels() -> str:
    """Counts of ever shorter runs, then their probabilities from the shortest to the longest; a character is two hex digits."""
    counts = [f"c{urls.ORDER} as (select g, count(*) filter (m = 'allow') as a, count(*) filter (m = 'block') as b from grams group by g)"]
    counts += [f"c{k} as (select substr(g, 3) as g, sum(a) as a, sum(b) as b from c{k + 1} group by all)" for k in range(urls.ORDER - 1, -1, -1)]
    context = "(partition by substr(c.g, 1, length(c.g) - 2))"
    sums = ", ".join(f"sum({x}) over {context}::double as {x}_n, count(*) filter ({x} > 0) over {context}::double as {x}_t" for x in "ab")
    rate = ", ".join(f"case when {x}_n > 0 then ({x} + {x}_t * p{x}) / ({x}_n + {x}_t) else p{x} end as p{x}" for x in "ab")
    rates = []
    for k in range(urls.ORDER + 1):
        shorter = f"p{k - 1} s on substr(c.g, 3) = s.g" if k else "(select 1::double / greatest(count(*), 1) as pa, 1::double / greatest(count(*), 1) as pb from c0) s on true"
        rates.append(f"p{k} as (select g, {rate} from (select c.g, a::double as a, b::double as b, pa, pb, {sums} from c{k} c join {shorter}))")
    return ",\n".join(counts + rates)


def _url_rules(what: str) -> str:
    ruled = sorted(urls.RULES, key=lambda r: -len(r[1] + r[2]))
    fits = "when (host = '{1}' or ends_with(host, '.{1}')) and starts_with(path, '{2}') then '{3}'"
    return "case " + " ".join(fits.format(*r, r[0] if what == "verdict" else r[1] + r[2]) for r in ruled) + " end"


_URLS = f"""
with split as (select page_id, case when contains(url, '://') then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
cut as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{common.UPPER}', '{common.LOWER}') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from split),
rows as (select row_number() over () as r, page_id, host, path, {_url_rules("rule")} as rule, {_url_rules("verdict")} as says,
    repeat('02', {urls.ORDER}) || hex(host || path) || '03' as x, ('0x' || substr(md5(host || path), 1, 8))::bigint % {urls.FOLDS} as fold from cut),
grams as (select r, case when fold > 0 then says end as m, substr(x, 2 * i + 1, {2 * urls.ORDER + 2}) as g
          from (select *, unnest(range(0, length(x) // 2 - {urls.ORDER})) as i from rows)),
{_url_levels()},
scored as (select r, greatest(-{urls.LIMIT}, least({urls.LIMIT}, floor(sum(floor((ln(pa) - ln(pb)) * {urls.UNIT} + 0.5)) / (count(*) * {urls.STEP})))) as bin
           from grams join p{urls.ORDER} using (g) group by r),
known as (select says, bin from rows join scored using (r) where fold = 0 and says is not null),
chosen as (select t from (select unnest(range(-{urls.LIMIT}, {urls.LIMIT + 2})) as t), known group by t
    order by count(*) filter (says = 'allow' and bin < t) * (select count(*) from known where says = 'block')
           + count(*) filter (says = 'block' and bin >= t) * (select count(*) from known where says = 'allow'), abs(t), t limit 1)
select page_id, host, path, rule, coalesce(says, case when bin >= coalesce((select t from chosen), 0) then 'allow' else 'block' end) as verdict
from rows join scored using (r)
"""

#: A checksum bit by bit, as the dialect has none.
_CRC = """xor(list_reduce(list_concat([4294967295], list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


def _row_hash(n_chars: str) -> str:
    values = ["doc_id", "source", "lang", n_chars, "text"]
    return "sha256(" + " || ".join(f"coalesce(strlen(({v})::varchar)::varchar || ':' || ({v})::varchar, '-')" for v in values) + ")"


_MERKLE = f"""
with recursive hashed as (select row_number() over () as r, doc_id, lang as tree, {_row_hash("n_chars")} as leaf,
    {_row_hash(f"case when {_CRC} % 7 = 0 then n_chars + 1 else n_chars end")} as claimed from documents),
leaves as (select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as place, count(*) over (partition by tree) as n from hashed),
node as (select tree, 0 as h, place, n, leaf as d from leaves union all
    select tree, h + 1, place // 2, n, sha256(string_agg(d, '' order by place)) from node where (n - 1) >> h > 0 group by tree, h, n, place // 2),
sub as (select tree, d as subroot, row_number() over (order by tree nulls first) - 1 as place, count(*) over () as n from node where place = 0 and (n - 1) >> h = 0),
top as (select 0 as h, place, n, subroot as d from sub union all
    select h + 1, place // 2, n, sha256(string_agg(d, '' order by place)) from top where (n - 1) >> h > 0 group by h, n, place // 2),
low as (select r, string_agg(d, '' order by h) as path from (select r, tree, n, unnest(range(32)) as h, place from leaves) l
    join node s using (tree, h) where s.place = xor(l.place >> h, 1) and (l.n - 1) >> h > 0 group by r),
up as (select tree, string_agg(d, '' order by h) as path from (select tree, n, unnest(range(32)) as h, place from sub) l
    join top s using (h) where s.place = xor(l.place >> h, 1) and (l.n - 1) >> h > 0 group by tree),
fold as (select r, tree, 0 as h, place, n, claimed as d from leaves union all
    select r, f.tree, f.h + 1, f.place, f.n, sha256(case when (f.place >> f.h) & 1 = 1 then s.d || f.d else f.d || coalesce(s.d, '') end)
    from fold f left join node s on s.tree is not distinct from f.tree and s.h = f.h and s.place = xor(f.place >> f.h, 1) where (f.n - 1) >> f.h > 0),
rise as (select r, 0 as h, sub.place, sub.n, d from fold join sub on sub.tree is not distinct from fold.tree where (fold.n - 1) >> h = 0 union all
    select r, f.h + 1, f.place, f.n, sha256(case when (f.place >> f.h) & 1 = 1 then s.d || f.d else f.d || coalesce(s.d, '') end)
    from rise f left join top s on s.h = f.h and s.place = xor(f.place >> f.h, 1) where (f.n - 1) >> f.h > 0),
root as (select d as root from top where place = 0 and (n - 1) >> h = 0)
select doc_id, leaf, subroot, root, sha256(coalesce(low.path, '') || coalesce(up.path, '')) as proof_sha256, rise.d as folded_root, rise.d = root as verified
from leaves join sub on sub.tree is not distinct from leaves.tree join rise on rise.r = leaves.r and (rise.n - 1) >> rise.h = 0, root
left join low on low.r = leaves.r left join up on up.tree is not distinct from leaves.tree
"""

ORACLE: dict[str, str] = {
    "op2_benchmark_decontamination": _DECONTAMINATION,
    "op4_minhash_near_dedup": _NEAR_DEDUP,
    "op7_quality_rules": _QUALITY,
    "op8_source_mix": _MIX,
    "op11_url_filter": _URLS,
    "op13_merkle_manifest": _MERKLE,
}
