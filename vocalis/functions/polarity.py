"""Rule-based polarity of a text's words, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vocalis import lexicons
from vocalis.lexicons import PolarityRules

#: Adjusted valences are summed as whole billionths, so the sum does not depend on the order of addition.
UNIT = 1_000_000_000

#: How far around a word its valence may depend on other words.
BEHIND, AHEAD = 3, 2

#: Word groups around place 0 that may be an idiom, the one that decides first (first place, length).
IDIOM_SPANS = [(0, 3), (0, 2), (-1, 2), (-2, 3), (-2, 2), (-3, 3), (-3, 2)]


def scored_words(words: Column) -> Column:
    """The scorer passes over words of one character."""
    return F.filter(words, lambda w: F.length(w) > 1)


def roles(valences: DataFrame, rules: PolarityRules) -> DataFrame:
    """The tokens that matter: their ``valence``, their ``boost`` on and their ``factor`` for later words.

    A token may have a row for its valence and another for what it does to later words; see ``one_role``.
    """
    known = valences.where("token is not null and valence is not null")
    known = known.select("token", F.col("valence").cast("double"), F.lit(None).cast("double").alias("boost"))
    known = known.withColumn("factor", F.lit(None).cast("double"))
    context = sorted({*rules.boosters, *rules.negators})
    boosts = [rules.boosters.get(t) for t in context]
    factors = [lexicons.NEGATION_WEIGHT if t in rules.negators else None for t in context]
    schema = "token string, valence double, boost double, factor double"
    others = lexicons.small_table(valences.sparkSession, schema, context, [None] * len(context), boosts, factors)
    return known.unionByName(others)


def one_role(roles: DataFrame) -> DataFrame:
    """One row per token; a token listed with two valences takes the higher one."""
    return roles.groupBy("token").agg(*[F.max(c).alias(c) for c in ("valence", "boost", "factor")])


def adjusted_valence(i: Column, words: Column, role: Column, rules: PolarityRules) -> Column:
    """The valence of word ``i`` in the light of its neighbours.

    Up to three words before it count, each only when it has no valence of its own: an intensifier
    moves the valence away from zero (a dampener towards it), less so at distance two and three; a
    negator turns it around and weakens it. Then idioms, two-word dampeners and "least" are looked
    at. ``words`` and ``role`` are arrays of equal length, ``role`` null for a token without one.
    Boosters have no valence, and neither has "kind" in "kind of".
    """

    def word(n: int) -> Column:
        return F.get(words, i + n)

    def is_word(n: int, *choices: str) -> Column:
        return F.coalesce(word(n).isin(*choices), F.lit(False))

    def plain(n: int | Column) -> Column:
        return F.get(words, i + n).isNotNull() & F.get(role, i + n)["valence"].isNull()

    def look_back(value: Column, place: Column) -> Column:
        other = F.get(role, i + place["n"])
        boost = F.coalesce(other["boost"], F.lit(0.0)) * place["weight"]
        moved = value + F.when(value < 0, -boost).otherwise(boost)
        factor = F.coalesce(other["factor"], F.lit(1.0))
        if rules.emphatic:
            near = is_word(-1, *rules.emphatic)
            second = (place["n"] == -2) & is_word(-2, "never") & near
            third = (place["n"] == -3) & ((is_word(-3, "never") & is_word(-2, *rules.emphatic)) | near)
            factor = F.when(second | third, place["emphasis"]).otherwise(factor)
        return F.when(plain(place["n"]), moved * factor).otherwise(value)

    places = F.array(
        *[
            F.struct(F.lit(-n).alias("n"), F.lit(weight).alias("weight"), F.lit(emphasis).alias("emphasis"))
            for n, weight, emphasis in zip((1, 2, 3), lexicons.DISTANCE_WEIGHTS, lexicons.EMPHASIS_WEIGHTS)
        ]
    )
    value = F.aggregate(places, F.get(role, i)["valence"], look_back)

    if rules.idioms or rules.booster_pairs:

        def phrase(start: int, length: int) -> Column:
            return F.array_join(F.array(*[word(start + k) for k in range(length)]), " ", "\n")

        idiom = F.lit(None).cast("double")
        if rules.idioms:
            names = F.create_map(*[F.lit(x) for item in rules.idioms.items() for x in item])
            around = F.array(*[phrase(*span) for span in IDIOM_SPANS])
            idiom = F.get(F.filter(F.transform(around, lambda p: names[p]), lambda v: v.isNotNull()), F.lit(0))
        pair = F.lit(0.0)
        if rules.booster_pairs:
            near = phrase(-3, 2).isin(*rules.booster_pairs) | phrase(-2, 2).isin(*rules.booster_pairs)
            pair = F.when(near, F.lit(lexicons.INTENSIFY)).otherwise(pair)
        late = F.transform(F.array(value), lambda v: F.when(plain(-3), F.coalesce(idiom, v) - pair).otherwise(v))
        value = F.get(late, F.lit(0))

    least = is_word(-1, "least") & plain(-1) & ~is_word(-2, "at", "very")
    value = value * F.when(least, F.lit(lexicons.NEGATION_WEIGHT)).otherwise(F.lit(1.0))
    silent = F.get(role, i)["boost"].isNotNull()
    if "kind of" in rules.booster_pairs:
        silent = silent | (is_word(0, "kind") & is_word(1, "of"))
    return F.when(silent, F.lit(0.0)).otherwise(value)


def as_units(valence: Column) -> Column:
    return F.rint(valence * F.lit(float(UNIT))).cast("long")


def text_units(words: Column, role: Column, rules: PolarityRules, repeats: str = "first") -> Column:
    """Sum of the adjusted valences of one text, in billionths.

    ``words`` and ``role`` should be plain columns, for they are read many times. ``repeats='first'``
    gives every occurrence of a word the valence its first occurrence has, as the scorer in common
    use does; ``repeats='each'`` looks at each occurrence in its own place.
    """
    zero = F.lit(0).cast("long")

    def units(i: Column) -> Column:
        return as_units(adjusted_valence(i, words, role, rules))

    if repeats == "each":
        places = F.filter(F.transform(role, lambda r, i: F.when(r["valence"].isNotNull(), i)), lambda i: i.isNotNull())
        return F.aggregate(places, zero, lambda total, i: total + units(i))

    def hit(r: Column, i: Column) -> Column:
        return F.when(r["valence"].isNotNull(), F.struct(F.get(words, i).alias("word"), i.alias("i")))

    def add(done: Column, hit: Column) -> Column:
        value = F.when(done["word"] == hit["word"], done["units"]).otherwise(units(hit["i"]))
        state = F.transform(
            F.array(value),
            lambda u: F.struct(hit["word"].alias("word"), u.alias("units"), (done["total"] + u).alias("total")),
        )
        return F.get(state, F.lit(0))

    # Sorted by word and place, the occurrences of a word are neighbours and its first one leads.
    hits = F.sort_array(F.filter(F.transform(role, hit), lambda h: h.isNotNull()))
    start = F.struct(F.lit("").alias("word"), zero.alias("units"), zero.alias("total"))
    return F.aggregate(hits, start, add, lambda done: done["total"])


def compound(units: Column) -> Column:
    """The normalised score in [-1, 1], to four places."""
    s = units.cast("double") / F.lit(float(UNIT))
    return F.round(s / F.sqrt(s * s + F.lit(lexicons.NORMALIZER)), 4)


def label(score: Column, positive: float = lexicons.POSITIVE_ABOVE, negative: float = lexicons.NEGATIVE_BELOW) -> Column:
    """Positive strictly above, Negative strictly below, else Neutral; a null score stays null."""
    return (
        F.when(score.isNull(), F.lit(None).cast("string"))
        .when(score > positive, "Positive")
        .when(score < negative, "Negative")
        .otherwise("Neutral")
    )
