"""Selection by counted ranges against ranking."""

import random

import pytest
from pyspark.sql import functions as F

from vocalis.operators import ranking, selection


def order():
    return [F.desc("v"), F.asc("i")]


def same(a, b):
    return sorted(map(tuple, a.collect()), key=repr) == sorted(map(tuple, b.collect()), key=repr)


@pytest.fixture(scope="module")
def rows(spark):
    """A hot group, a null group, most values tied, values at both ends of whole numbers, nulls."""
    rng = random.Random(4)
    values = lambda: rng.choice([None, 0, 0, 0, 5, 2**63 - 1, -(2**63), -7, rng.randint(-(10**12), 10**12)])
    made = [(rng.choice(["hot", "hot", "a", "b", None]), values(), i) for i in range(3000)]
    return spark.createDataFrame([*made, ("one", 1, -1), ("none", None, -2)], "g string, v long, i long").repartition(7)


@pytest.mark.parametrize("n", [1, 60, 500, 900, 5000])
def test_equal_to_ranking(rows, n):
    assert same(selection.first_per_group(rows, ["g"], F.col("v"), order(), n), ranking.top_per_group(rows, ["g"], order(), n))
    assert same(selection.first_rows(rows, F.col("v"), order(), n), rows.orderBy(*order()).limit(n))


def test_coarser_level(spark):
    rng = random.Random(5)
    df = spark.createDataFrame([(i % 3, i % 2, rng.random() * 40, i) for i in range(2000)], "g int, h int, x double, i long")
    by_x = [F.desc("x"), F.asc("i")]
    got = selection.first_per_group(df, ["g", "h"], F.floor("x"), by_x, 70)
    assert same(got, ranking.top_per_group(df, ["g", "h"], by_x, 70))


def test_all_tied_and_repeated_rows(spark):
    tied = spark.createDataFrame([(1, 7, i) for i in range(900)], "g int, v long, i long").repartition(9)
    got = selection.first_per_group(tied, ["g"], F.col("v"), order(), 333)
    assert sorted(r.i for r in got.collect()) == list(range(333))
    repeated = spark.createDataFrame([("x", 1, 1)] * 50, "g string, v long, i long")
    assert selection.first_rows(repeated, F.col("v"), order(), 20).count() == 20


def test_empty_table(spark):
    none = spark.createDataFrame([], "g string, v long, i long")
    assert selection.first_rows(none, F.col("v"), order(), 3).count() == 0
    assert selection.first_per_group(none, ["g"], F.col("v"), order(), 3).columns == ["g", "v", "i"]


def test_no_task_ranks_or_merges_the_answer(spark):
    df = spark.range(20_000).select((F.col("id") % 5000).alias("v"), F.col("id").alias("i"))
    plan = selection.first_rows(df, F.col("v"), order(), 9_998)._jdf.queryExecution().executedPlan().toString()
    for node in ("Window", "TakeOrdered", "GlobalLimit", "SinglePartition", "NestedLoop", "Cartesian"):
        assert node not in plan
    assert selection.first_rows(df, F.col("v"), order(), 9_998).count() == 9_998
