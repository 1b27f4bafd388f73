"""URL filters against a plain version of rules, models and threshold."""

import math
import re
from collections import defaultdict
from hashlib import md5

import pytest

from vocalis.llm import urls


def plain_split(url):
    if not url or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host) :])[0]


def plain_rule(host, path):
    fits = [(len(h + p), h + p, says) for says, h, p in urls.RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def plain(rows):
    """[(key, host, path, rule, verdict, score)], every probability worked out from its definition."""
    order = urls.ORDER
    rows = [(k, *plain_split(u)) for k, u in rows]
    rows = [(k, h, p, *plain_rule(h, p)) for k, h, p in rows]
    runs = lambda t: [(b"\2" * order + t.encode() + b"\3")[i : i + order + 1] for i in range(len(t.encode()) + 1)]
    fold = lambda t: int(md5(t.encode()).hexdigest()[:8], 16) % urls.FOLDS
    followers = {v: defaultdict(lambda: defaultdict(int)) for v in ("allow", "block")}
    symbols = set()
    for _, h, p, _, says in rows:
        for gram in runs(h + p):
            symbols.add(gram[-1])
            for length in range(order + 1) if says and fold(h + p) else ():
                followers[says][gram[order - length : order]][gram[-1]] += 1

    def chance(mark, context, c):
        p = 1 / len(symbols)
        for length in range(order + 1):
            seen = followers[mark].get(context[order - length :])
            if seen:
                n, t = sum(seen.values()), len(seen)
                p = (seen.get(c, 0) + t * p) / (n + t)
        return p

    def ratio(gram):
        both = [math.log(chance(v, gram[:-1], gram[-1])) for v in ("allow", "block")]
        return math.floor((both[0] - both[1]) * 1e6 + 0.5)

    sums = [(sum(map(ratio, runs(h + p))), len(runs(h + p))) for _, h, p, _, _ in rows]
    bins = [max(-1000, min(1000, math.floor(s / (n * 10_000)))) for s, n in sums]
    known = [(b, r[4]) for b, r in zip(bins, rows) if r[4] and fold(r[1] + r[2]) == 0]
    of = {v: sum(m == v for _, m in known) for v in ("allow", "block")}
    lost = lambda t: sum(m == "allow" and b < t for b, m in known) * of["block"] + sum(m == "block" and b >= t for b, m in known) * of["allow"]
    least = min((lost(t), abs(t), t) for t in range(-1000, 1002))[2]
    return [(*r[:4], r[4] or ("allow" if b >= least else "block"), s / (n * 1e6)) for r, b, (s, n) in zip(rows, bins, sums)]


def same(df, rows):
    return sorted(map(repr, map(tuple, urls.judged(df).collect()))) == sorted(map(repr, plain(rows)))


def test_whole_table(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    assert same(pages, [tuple(r) for r in pages.collect()])


ODD = [
    (1, None), (2, ""), (2, "no scheme"), (3, "http://É.org/naïve/😀?q#f"), (3, "http://É.org/naïve/😀?q#f"), (None, "HTTP://A.Com/de/"),
    (5, "://org/"), (6, "a://com/" + "é1" * 20_000), (7, "x://example.org/es/../"), (8, "x://sub.EXAMPLE.org/en/12#/es/"), (9, "x://example.org?/es/"),
    (10, "x://notexample.org/es/"), (11, "x://com/fr"), (12, "x://y://org/"), (None, None), (13, "x://a.net/\u0002\u0003\n"),
]


@pytest.mark.parametrize("extra", [(), ("row", "gram", "_url", "key", "host", "text", "a.b")])
def test_odd_rows(spark, extra):
    df = spark.createDataFrame([(*r, *extra) for r in ODD], "page_id long, url string" + "".join(f", `{c}` string" for c in extra)).repartition(3)
    assert same(df, ODD)
    found = {r.page_id: r for r in urls.judged(df).collect()}
    assert (found[1].host, found[1].path, found[1].rule) == ("", "", None) and found[1].verdict == found[2].verdict
    assert (found[7].rule, found[8].rule, found[9].rule, found[10].rule) == ("example.org/es/", "example.org/en/1", None, "org/")
    assert (found[11].rule, found[12].host) == (None, "y:")


def test_empty_table(spark):
    assert urls.judged(spark.createDataFrame([], "page_id long, url string")).collect() == []


def test_models_tell_the_classes_apart(spark):
    """Without a rule, hosts are judged by what the URLs of either class look like."""
    rows = [(i, f"http://h{i}.org/quiet/river/{i}") for i in range(200)] + [(i, f"http://h{i}.com/de/casino-bonus/{i}") for i in range(200, 400)]
    rows += [(i, f"http://n{i}.net/quiet/river/{i}") for i in range(400, 420)] + [(i, f"http://n{i}.net/casino-bonus/{i}") for i in range(420, 440)]
    found = {r.page_id: r.verdict for r in urls.judged(spark.createDataFrame(rows, "page_id long, url string")).collect()}
    assert all(found[i] == "allow" for i in range(400, 420)) and all(found[i] == "block" for i in range(420, 440))


def test_longest_rule_and_first_of_equals(spark):
    df = spark.createDataFrame([(1, "x://a.b/c/d")], "page_id long, url string")
    one = lambda rules: urls.judged(df, rules).first()
    assert one([("allow", "b", "/"), ("block", "b", "/c/")]).verdict == "block"
    assert one([("allow", "a.b", "/"), ("block", "b", "/c/")]).rule == "a.b/"
    assert one([]).rule is None


def test_a_shared_host_is_no_hot_key(spark):
    """Runs beyond the bound are joined where they are; the shuffled ones each make up less than one place in HOT."""
    rows = [(i, f"http://one.example.net/en/{i * 7919 % 100_003}") for i in range(3000)]
    df = spark.createDataFrame(rows, "page_id long, url string").repartition(4)
    counted = urls.counts(df.selectExpr("substr(url, 8) as text", "'allow' as trains")).collect()
    places = sum(r.n for r in counted)
    assert 0 < sum(r.n * urls.HOT > places for r in counted) < urls.HOT
    assert same(df, rows)
