from vocalis.operators import report

ROWS = [
    ("s1", ["camera"], "Positive"), ("s1", ["camera", "price"], "Negative"), ("s1", [], "Neutral"),
    ("s1", None, "Neutral"), ("s2", ["price"], None), ("s2", ["price"], "Neutral"),
]
SCHEMA = "source string, topics array<string>, sentiment string"


def test_distribution(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    rows = {r.sentiment: (r["count"], r.share) for r in report.sentiment_distribution(df).collect()}
    assert rows == {"Positive": (1, 1 / 6), "Negative": (1, 1 / 6), "Neutral": (3, 0.5), None: (1, 1 / 6)}
    by_source = report.sentiment_distribution(df, ["source"])
    assert abs(sum(r.share for r in by_source.collect()) - 2) < 1e-12
    assert sum(r["count"] for r in by_source.collect()) == len(ROWS)
    shown = by_source.where("source = 's2' and sentiment = 'Neutral'").select(report.percent(by_source["share"]))
    assert shown.first()[0] == "50.0%"


def test_counts_and_matrix(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    counts = {(r.topic, r.sentiment): r["count"] for r in report.topic_counts(df).collect()}
    assert counts == {("camera", "Positive"): 1, ("camera", "Negative"): 1, ("price", "Negative"): 1, ("price", None): 1, ("price", "Neutral"): 1}
    matrix = [tuple(r) for r in report.topic_matrix(df).collect()]
    assert matrix == [("camera", 1, 0, 1), ("price", 1, 1, 0)]
    assert report.topic_matrix(df, ["source"]).columns == ["source", "topic", "Negative", "Neutral", "Positive"]


def test_empty_input(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert report.sentiment_distribution(df).collect() == [] and report.topic_matrix(df).collect() == []


def test_matrix_is_one_aggregation(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    plan = report.topic_matrix(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_count" in plan
