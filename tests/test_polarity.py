import random

import model
import pytest
from pyspark.sql import functions as F

from vocalis import lexicons
from vocalis.catalog import binding
from vocalis.functions import polarity
from vocalis.lexicons import PolarityRules
from vocalis.operators import scoring, stages

VALENCES = {"good": 1.9, "bad": -2.5, "ass": -2.5, "kind": 2.4, "pretty": 2.2, "happy": 2.7, "shit": -2.6, "bomb": -2.2, "no": -1.2}
WORDS = (
    "good bad ass kind of pretty happy the shit bomb no never so this least at very not cannot without sort "
    "just enough really extremely slightly barely yeah right hand to mouth x filler words here"
).split()


def texts(n=1500):
    rng = random.Random(3)
    return [rng.choices(WORDS, k=rng.randint(0, 14)) for _ in range(n)] + [None]


def scores(spark, rows, rules, repeats, **options):
    df = spark.createDataFrame(list(enumerate(rows)), "i int, words array<string>")
    valences = lexicons.valence_table(spark, VALENCES)
    out = scoring.score(df, valences, rules=rules, repeats=repeats, **options)
    return [r["compound"] for r in out.orderBy("i").collect()]


@pytest.mark.parametrize("repeats", ["first", "each"])
@pytest.mark.parametrize("options", [{}, {"inline_limit": 3}], ids=["inline", "join"])
def test_all_rules_agree_with_the_model(spark, repeats, options):
    rows, rules = texts(), PolarityRules()
    want = [None if r is None else model.compound(r, VALENCES, rules, repeats) for r in rows]
    got = scores(spark, rows, rules, repeats, **options)
    assert got == pytest.approx(want, abs=1e-9)
    assert len(set(got)) > 200


def test_single_rules(spark):
    names = [
        "good", "really good", "really filler good", "really filler words good", "barely good", "never good",
        "never so good", "at least good", "least good", "xx yy bad ass", "good good", "good really good", "x y z",
    ]
    of = dict(zip(names, scores(spark, [n.split() for n in names], PolarityRules(), "each")))
    good = of["good"]
    assert good == pytest.approx(1.9 / (1.9**2 + 15) ** 0.5, abs=1e-4)
    assert of["really good"] > of["really filler good"] > of["really filler words good"] > good > of["barely good"]
    assert of["never good"] < 0 < of["never so good"]
    assert of["at least good"] > 0 > of["least good"]
    assert of["xx yy bad ass"] == pytest.approx((1.5 - 2.5) / (1.0 + 15) ** 0.5, abs=1e-4)
    assert of["x y z"] == 0.0 and of["good good"] < of["good really good"]
    first = scores(spark, [["good", "really", "good"]], PolarityRules(), "first")
    assert first == [of["good good"]]


def test_reachable_rules_change_nothing_on_cleaned_text(spark):
    stop = lexicons.STOPWORDS
    rows = [None if r is None else [w for w in r if w not in stop] for r in texts()]
    reachable = PolarityRules().reachable(stop)
    assert list(reachable.idioms) == ["bad ass"] and not reachable.emphatic and not reachable.booster_pairs
    assert {"never", "without", "cannot"} <= set(reachable.negators) and "not" not in reachable.negators
    assert scores(spark, rows, reachable, "first") == scores(spark, rows, PolarityRules(), "first")


def test_label_bounds(spark):
    df = spark.createDataFrame([(0.2,), (0.2001,), (-0.2,), (-0.2001,), (0.0,), (None,)], "c double")
    labels = [r[0] for r in df.select(polarity.label(F.col("c"))).collect()]
    assert labels == ["Neutral", "Positive", "Neutral", "Negative", "Neutral", None]


def test_repeated_texts_are_scored_each(spark):
    rows = [["good"], ["bad"], ["good"], ["good"], None, []]
    both = [scores(spark, rows, PolarityRules(), "first", **o) for o in ({}, {"inline_limit": 3})]
    assert both[0] == both[1] and both[0][0] == both[0][2] == both[0][3] > 0 > both[0][1]
    with pytest.raises(ValueError):
        scores(spark, rows, PolarityRules(), "last")


def test_empty_table_and_empty_rules(spark):
    df = spark.createDataFrame([(["good"],)], "words array<string>")
    bare = PolarityRules(boosters={}, booster_pairs=(), negators=(), emphatic=(), idioms={})
    assert scoring.score(df, lexicons.valence_table(spark, {}), rules=bare).first()["compound"] == 0.0


def test_valences_from_a_file(spark, tmp_path):
    path = tmp_path / "valences.txt"
    path.write_text("good\t1.9\t0.9\t[2, 1]\n:)\t2.0\t1.1\t[2]\nbroken line\n$:\t-1.5\t0.8\t[-1]\n")
    rows = {r["token"]: r["valence"] for r in lexicons.read_valences(spark, str(path)).collect()}
    assert rows == {"good": 1.9, ":)": 2.0, "$:": -1.5}


def test_in_row_plan_has_no_shuffle_and_no_python(spark, sf_dir):
    docs = stages.clean_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"), "text", keep_words=True)
    plan = scoring.label_rows(docs, binding.valences(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Join" not in plan


def test_joined_plan_reads_the_rows_once(spark, sf_dir):
    docs = stages.clean_rows(spark.read.parquet(f"{sf_dir}/documents.parquet"), "text", keep_words=True)
    df = scoring.score(docs, binding.valences(spark), inline_limit=0).select("doc_id", "compound")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Cartesian" not in plan and sf_dir not in plan  # the rows come from the shared folder


def test_a_distribution_looks_for_no_topics(spark, sf_dir):
    from vocalis.catalog.queries import QUERIES

    plan = QUERIES["sentiment_distribution"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert "topics" not in plan and "tion" in plan


def test_only_rare_words_travel(spark):
    """Whatever the number of words looked up in the row, each place gets its word's role."""
    words = ["good bad so so very good", "so very", "", "x", "good", "rare so odd good rare"]
    df = spark.createDataFrame([(i, w.split()) for i, w in enumerate(words)] + [(9, None)], "i long, words array<string>")
    rules = PolarityRules(boosters={"very": 0.3}, negators=("odd",))
    listed = spark.createDataFrame([("good", 1.5), ("bad", -2.0), ("rare", 0.7)], "token string, valence double")
    roles = polarity.one_role(polarity.roles(listed, rules))
    known = {r.token: (r.valence, r.boost, r.factor) for r in roles.collect()}
    for leading in (0, 1, 3, 100):
        for r in scoring._with_joined_roles(df, "words", roles, leading).collect():
            tokens = None if r.words is None else [w for w in r.words if len(w) > 1]
            assert r._tokens == tokens
            found = None if r._roles is None else [(x and (x.valence, x.boost, x.factor)) or (None,) * 3 for x in r._roles]
            assert found == (None if tokens is None else [known.get(t, (None,) * 3) for t in tokens]), (leading, r)
