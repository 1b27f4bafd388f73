import pytest
from pyspark.sql import functions as F

from vocalis.functions import values


def one(spark, texts, function):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["v"] for r in df.select("i", function(F.col("t")).alias("v")).orderBy("i").collect()]


def test_iso_seconds(spark):
    cases = {
        "PT1H2M3S": 3723.0, "P1DT1S": 86401.0, "P0D": 0.0, "PT1.5S": 1.5, "PT1,5S": 1.5, "P2W": 1209600.0, "PT60S": 60.0,
        "PT61S": 61.0, "bad": None, "": None, None: None, "P": None, "PT1H extra": None, "P1DT": 86400.0,
    }
    assert one(spark, list(cases), values.iso_seconds) == list(cases.values())


def test_digits_or_zero(spark):
    assert one(spark, ["12", "12a", "-3", "0", "", None, "99999999999999999999"], values.digits_or_zero) == [12, 0, 0, 0, 0, 0, 0]


def test_strict_count(spark):
    assert one(spark, ["12", None], values.strict_count) == [12, 0]
    with pytest.raises(Exception, match="not a whole number"):
        one(spark, ["12a"], values.strict_count)
