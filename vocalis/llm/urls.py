"""URL filters: ordered rules, and for all other URLs the ratio of two character language models.

The models are variable-order Markov models of the URLs that rules allow and of those that rules block. One pass cuts
every URL (host and path, between marks) into overlapping runs of ``ORDER`` + 1 characters and counts them by class; the
counts of shorter runs are sums of these, as every run but its first character is a run of the next shorter length.
Probabilities are smoothed from the shortest context to the longest (Witten and Bell): a context that was seen N
times with T different followers gives its followers' counts the weight N and the next shorter context the weight T, and one
never seen passes on what the shorter context says. Characters are bytes of UTF-8.

The score of a URL is the mean over its characters of the difference of both logarithms. One URL in ``FOLDS`` that a
rule judges is kept out of the counts; on these the threshold with the fewest errors, weighed alike for both classes, is chosen.

Counts stay distributed tables that grow with the URLs. The runs that stand in many URLs (at most ``HOT`` of them, as each
makes up more than one in ``HOT`` of all places) are joined where the places are; all others are shuffled by run, so a host
that a third of all URLs share is spread like any other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vocalis.llm import common

#: (verdict, host, path): fits the host and all its subdomains, if the URL's path starts with ``path``. The longest wins.
RULES = [("allow", "org", "/"), ("block", "example.org", "/es/"), ("block", "example.org", "/en/1"), ("allow", "com", "/fr/"), ("block", "com", "/de/")]
#: Characters of context.
ORDER = 5
FOLDS = 5
START, END = "\u0002", "\u0003"
HOT = 2000
#: Logarithms are summed as whole millionths, so sums do not depend on order; thresholds are hundredths from -LIMIT to LIMIT.
UNIT, STEP, LIMIT = 1_000_000, 10_000, 1000


def parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path; both empty without ``://`` or for a null."""
    rest = F.when(F.contains(url, F.lit("://")), F.expr("substr(_url, instr(_url, '://') + 3)")).otherwise("")
    return common.ascii_lower(F.regexp_extract(rest, r"^[^/?#]*", 0)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path in a row, and its verdict; null where none fits. Of equally long ones the first."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for says, own_host, own_path in sorted(rules[::-1], key=lambda r: len(r[1] + r[2])):
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith(own_path)
        rule, verdict = F.when(fits, own_host + own_path).otherwise(rule), F.when(fits, says).otherwise(verdict)
    return rule, verdict


def _runs(text: Column) -> Column:
    """All runs of ORDER + 1 characters of a marked text, each byte of which is one character."""
    marked = F.concat(F.lit(START * ORDER), F.decode(F.encode(text, "UTF-8"), "ISO-8859-1"), F.lit(END))
    return F.regexp_extract_all(marked, F.lit(rf"(?s)(?=(.{{{ORDER + 1}}}))."), F.lit(1))


def counts(rows: DataFrame) -> DataFrame:
    """(gram, allow, block, n) of ``rows`` (text, trains): how often each run stands in URLs to learn from, and in all."""
    grams = rows.select("trains", F.explode(_runs(F.col("text"))).alias("gram"))
    times = lambda mark: F.sum((F.col("trains") == mark).cast("long"))
    return grams.groupBy("gram").agg(F.coalesce(times("allow"), F.lit(0)).alias("allow"), F.coalesce(times("block"), F.lit(0)).alias("block"), F.count(F.lit(1)).alias("n"))


def _smoothed(level: DataFrame, shorter: DataFrame | None, symbols: int) -> DataFrame:
    """``level`` (gram, allow, block) with the probability of each gram's last character after the others, by class.

    A context has one row per character at most, so its window is small.
    """
    length = F.length("gram")
    within = Window.partitionBy(F.expr("substr(gram, 1, length(gram) - 1)"))
    for mark in ("allow", "block"):
        level = level.withColumn(f"{mark}_n", F.sum(mark).over(within)).withColumn(f"{mark}_t", F.sum((F.col(mark) > 0).cast("long")).over(within))
    if shorter is None:
        level = level.withColumn("allow_less", F.lit(1.0) / F.lit(symbols)).withColumn("block_less", F.lit(1.0) / F.lit(symbols))
    else:
        shorter = shorter.select(F.col("gram").alias("suffix"), F.col("allow_p").alias("allow_less"), F.col("block_p").alias("block_less"))
        level = level.join(shorter, F.substring("gram", 2, 1 << 30) == F.col("suffix"))
    for mark in ("allow", "block"):
        n, t, less = F.col(f"{mark}_n"), F.col(f"{mark}_t"), F.col(f"{mark}_less")
        level = level.withColumn(f"{mark}_p", F.when(n > 0, (F.col(mark) + t * less) / (n + t)).otherwise(less))
    return level.select("gram", "allow", "block", "allow_p", "block_p")


def models(counted: DataFrame) -> DataFrame:
    """(gram, ratio, n): for every run the logarithm of the allowed model's probability over the blocked one's, in millionths."""
    levels = [counted.select("gram", "allow", "block")]
    for _ in range(ORDER):
        levels.append(common.written(levels[-1].groupBy(F.substring("gram", 2, 1 << 30).alias("gram")).agg(F.sum("allow").alias("allow"), F.sum("block").alias("block"))))
    symbols, found = max(levels[-1].count(), 1), None
    for level in reversed(levels):
        found = common.written(_smoothed(level, found, symbols))
    ratio = F.floor((F.log("allow_p") - F.log("block_p")) * UNIT + 0.5).cast("long")
    return found.select("gram", ratio.alias("ratio")).join(counted.select("gram", "n"), "gram")


def scored(rows: DataFrame, model: DataFrame) -> DataFrame:
    """(row, score, length): the sum of the ratios of a row's runs, in millionths, and their number, from (row, text)."""
    places = model.agg(F.sum("n")).first()[0] or 0
    hot = model.where(F.col("n") * HOT > places).select("gram", "ratio")  # fewer than HOT rows
    cold = model.where(F.col("n") * HOT <= places).select("gram", "ratio")
    grams = rows.select("row", F.explode(_runs(F.col("text"))).alias("gram"))
    near = grams.join(F.broadcast(hot), "gram").groupBy("row").agg(F.sum("ratio").alias("ratio"), F.count(F.lit(1)).alias("n"))
    far = grams.join(F.broadcast(hot), "gram", "left_anti").join(cold, "gram").select("row", "ratio", F.lit(1).cast("long").alias("n"))
    return near.unionByName(far).groupBy("row").agg(F.sum("ratio").alias("score"), F.sum("n").alias("length"))


def threshold(bins: DataFrame) -> int:
    """The hundredth from which URLs are allowed, from (bin, allow, block) counts: the fewest errors, weighed alike for both classes; of equal ones the nearest to 0."""
    found = {r.bin: (r.allow, r.block) for r in bins.collect()}  # 2 * LIMIT + 1 rows at most
    good, bad = (sum(v[i] for v in found.values()) for i in (0, 1))
    below, left, best = 0, bad, []
    for at in range(-LIMIT, LIMIT + 2):
        best.append((below * bad + left * good, abs(at), at))
        allow, block = found.get(at, (0, 0))
        below, left = below + allow, left - block
    return min(best)[2]


def judged(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, key: str = "page_id", url: str = "url") -> DataFrame:
    """(key, host, path, rule, verdict, score), one row per row: the rule's verdict, or else the models'.

    A null URL or one without ``://`` has an empty host and path, fits no rule and is judged by the models as an empty text.
    Without URLs of a class to learn from its model is uniform; without any that a rule judges the score is 0 and the verdict
    is allow. Repeated rows count as often as they occur and get equal verdicts. An empty table gives no rows; other
    columns are not read.
    """
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("_url"))
    host, path = parts(F.col("_url"))
    rows = rows.select("key", host.alias("host"), path.alias("path"))
    rule, says = ruled(F.col("host"), F.col("path"), rules)
    text = F.concat("host", "path")
    fold = F.conv(F.substring(F.md5(text.cast("binary")), 1, 8), 16, 10).cast("long") % FOLDS
    rows = rows.select("key", "host", "path", rule.alias("rule"), says.alias("says"), text.alias("text"), fold.alias("fold"), F.monotonically_increasing_id().alias("row"))
    rows = common.written(rows)
    counted = common.written(counts(rows.select("text", F.when(F.col("fold") > 0, F.col("says")).alias("trains"))))
    found = common.written(scored(rows.select("row", "text"), common.written(models(counted))))
    bin = F.greatest(F.lit(-LIMIT), F.least(F.lit(LIMIT), F.floor(F.col("score") / (F.col("length") * STEP)))).cast("int")
    rows = rows.drop("text").join(found, "row").withColumn("bin", bin)
    kept_out = rows.where("fold = 0 and says is not null").groupBy("bin")
    of = lambda mark: F.sum((F.col("says") == mark).cast("long")).alias(mark)
    least = threshold(kept_out.agg(of("allow"), of("block")))
    verdict = F.coalesce("says", F.when(F.col("bin") >= least, "allow").otherwise("block"))
    return rows.select(F.col("key").alias(key), "host", "path", "rule", verdict.alias("verdict"), (F.col("score") / (F.col("length") * UNIT)).alias("score"))
