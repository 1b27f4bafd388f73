"""Whether the landed pages of a search or a video are all there.

Pages of one chain are numbered, and each but the last names the next one by a token. A page that is missing, or an end that
another page follows, shows by looking at the pages one number before and one after, which is a join on chain and
number: pages are met one by one, so a chain with a third of all pages is not gathered. Only numbers and tokens
travel; items do not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocalis.functions import values

#: What can be wrong: the page after this one, or before it, has not landed; pages go on after the last one; landed again.
MISSING_NEXT, MISSING_BEFORE, AFTER_END, REPEATED = "next page missing", "page before missing", "pages after the end", "landed again"


def _same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def _numbers(pages: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, page_no, copies, goes_on, ends): every page once; copies that disagree about the end are both."""
    token = F.col("nextPageToken").isNotNull() & (F.col("nextPageToken") != "")
    number = values.required(F.col("page_no"), "page_no").alias("page_no")
    marked = pages.select(*keys, number, token.alias("token"))
    each = marked.groupBy(*keys, "page_no")
    return each.agg(F.count(F.lit(1)).alias("copies"), F.max("token").alias("goes_on"), F.max(~F.col("token")).alias("ends"))


def faults(pages: DataFrame, keys: list[str], first: int | None = None) -> DataFrame:
    """(keys, page_no, fault): every fault of every chain of ``pages``, in no order; none if all pages are there once.

    ``first`` is the number that chains start with; without it the lowest number of any page. A page may have several
    faults. Chains of which no page has landed cannot be seen. A null key is a chain of its own.
    """
    numbers = _numbers(pages, keys)
    if first is None:
        first = pages.agg(F.min("page_no")).first()[0]
    other = numbers.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("page_no").alias("_no"))

    def beside(step: int, name: str) -> DataFrame:
        on = F.col("page_no") + step == F.col("_no")
        for k in keys:
            on &= _same(F.col(k), F.col(f"_{k}"))
        found = numbers.select(*keys, "page_no", "copies", "goes_on", "ends").join(other, on, "left")
        return found.select(*keys, "page_no", "copies", "goes_on", "ends", F.col("_no").isNotNull().alias(name))

    after, before = beside(1, "followed"), beside(-1, "preceded")
    when = lambda condition, fault: F.when(condition, F.lit(fault))
    ahead = F.array_compact(F.array(
        when(F.col("goes_on") & ~F.col("followed"), MISSING_NEXT), when(F.col("ends") & F.col("followed"), AFTER_END), when(F.col("copies") > 1, REPEATED),
    ))
    behind = before.where(~F.col("preceded") & (F.col("page_no") > F.lit(first))).select(*keys, "page_no", F.lit(MISSING_BEFORE).alias("fault"))
    return after.select(*keys, "page_no", F.explode(ahead).alias("fault")).unionByName(behind)


def once(pages: DataFrame, keys: list[str]) -> DataFrame:
    """``pages`` with every page once. Of copies that differ, the one with the most items, then the highest digest, stays.

    Only pages that landed again are shuffled, and the numbers of all.
    """
    again = _numbers(pages, keys).where("copies > 1").select(*[F.col(k).alias(f"_{k}") for k in keys], F.col("page_no").alias("_no"))
    on = F.col("page_no") == F.col("_no")
    for k in keys:
        on &= _same(F.col(k), F.col(f"_{k}"))
    single = pages.join(again, on, "left_anti")
    whole = F.struct(*pages.columns)
    best = F.struct(F.coalesce(F.size("items"), F.lit(-1)).alias("n"), F.md5(F.to_json(whole).cast("binary")).alias("digest"))
    twice = pages.join(again, on, "left_semi").groupBy(*keys, "page_no").agg(F.max_by(whole, best).alias("page"))
    return single.unionByName(twice.select("page.*"))


def complete(pages: DataFrame, keys: list[str], first: int | None = None) -> DataFrame:
    """``pages`` with every page once; raises if a chain lacks a page or goes on after its end."""
    wrong = faults(pages, keys, first).where(F.col("fault") != REPEATED).head(5)
    if wrong:
        named = "; ".join(", ".join(f"{k} {v}" for k, v in row.asDict().items()) for row in wrong)
        raise ValueError(f"pages are not complete: {named}")
    return once(pages, keys)
