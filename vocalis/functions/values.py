"""Guards and conversions for values that arrive as text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_AMOUNT = r"\d+(?:[.,]\d+)?"
ISO_DURATION = (
    rf"^P(?=\d|T\d)(?:{_AMOUNT}W)?(?:{_AMOUNT}D)?(?:T(?:{_AMOUNT}H)?(?:{_AMOUNT}M)?(?:{_AMOUNT}S)?)?$"
)
UNIT_SECONDS = {"W": 604800, "D": 86400, "H": 3600, "M": 60, "S": 1}


def or_zero(value: Column) -> Column:
    """A missing number counts as 0."""
    return F.coalesce(value, F.lit(0).cast("long"))


def digits_or_zero(text: Column) -> Column:
    """Text of digits only as a number; anything else, and a missing value, as 0."""
    return F.when(text.rlike("^[0-9]+$"), or_zero(text.try_cast("long"))).otherwise(F.lit(0).cast("long"))


def strict_count(text: Column) -> Column:
    """Text as a whole number, missing as 0; text that is no number fails the query, whatever the session's settings."""
    number = F.trim(text).try_cast("long")
    wrong = F.raise_error(F.concat(F.lit("not a whole number: "), text)).cast("long")
    return F.when(text.isNull(), F.lit(0).cast("long")).when(text.rlike(r"^\s*[+-]?[0-9]+\s*$"), F.coalesce(number, wrong)).otherwise(wrong)


def strict_time(text: Column) -> Column:
    """Text as a timestamp, missing as null; text that is no time fails the query."""
    wrong = F.when(text.isNotNull(), F.raise_error(F.concat(F.lit("not a time: "), text)).cast("timestamp"))
    return F.coalesce(text.try_cast("timestamp"), wrong)


def required(value: Column, name: str) -> Column:
    """The value; a missing one fails the query."""
    return F.coalesce(value, F.raise_error(F.lit(f"{name} is missing")).cast("int"))


def iso_seconds(duration: Column) -> Column:
    """Seconds of an ISO-8601 duration made of weeks, days, hours, minutes, seconds; else null.

    One expression checks the form, one takes the amounts out.
    """
    amounts = F.regexp_extract_all(duration, F.lit(rf"{_AMOUNT}[WDHMS]"), F.lit(0))

    def seconds(amount: Column) -> Column:
        number = F.translate(F.rtrim(amount, F.lit("WDHMS")), ",", ".").try_cast("double")
        unit = F.right(amount, F.lit(1))
        factor = F.lit(float(UNIT_SECONDS["W"]))
        for name in "DHMS":
            factor = F.when(unit == name, F.lit(float(UNIT_SECONDS[name]))).otherwise(factor)
        return number * factor

    total = F.aggregate(amounts, F.lit(0.0), lambda sum, amount: sum + seconds(amount))
    return F.when(duration.rlike(ISO_DURATION), total)
