"""Personal data: regular expressions propose spans, validators confirm them, context words adjust the score.

Only built-in functions, one pass, no shuffle. Where a pattern matches, the text splits into the pieces
between the matches; the lengths of pieces and matches, added up, are the places. The pieces and matches
around a match give its context.

The expressions have possessive repeats and start only where a run starts (or where the last match ended):
that changes no match, but long runs without a match stay linear and need no deep stack.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Characters before a span, and after it, in which context words count.
CONTEXT_CHARS = 48
#: Matches that reach so far: none has fewer than two characters.
CONTEXT_MATCHES = CONTEXT_CHARS // 2


class Kind(NamedTuple):
    name: str
    pattern: str
    needs: str  # a text without a match of this has no span of the kind
    score: float
    context: str  # words around the span that raise the score
    raised: float
    least: float  # spans below are dropped


_IP_PART = "0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"

#: How many characters the account numbers of countries have.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI NL", 19: "MK SI", 20: "AT BA EE KZ LT LU", 21: "CH HR LI LV", 22: "BG DE GB GE IE ME RS",
    23: "AE GI IL", 24: "AD CZ ES MD PK RO SA SE SK TN", 25: "PT", 26: "IS TR", 27: "FR GR IT MC SM", 28: "AL AZ CY DO HU LB PL", 29: "BR QA UA",
    30: "JO KW MU", 31: "MT",
}
#: As a country fixes the length, a number ends where it must, whatever word follows. Groups of four may be parted by spaces.
_IBAN = "|".join(
    rf"(?:{names.replace(' ', '|')})[0-9]{{2}}(?:\x20?[A-Z0-9]{{4}}){{{(n - 4) // 4}}}" + (rf"\x20?[A-Z0-9]{{{(n - 4) % 4}}}" if (n - 4) % 4 else "")
    for n, names in IBAN_LENGTHS.items()
)
#: Keys of services that say by their first characters and their length what they are.
_KEYS = "|".join([
    "(?:AKIA|ASIA)[A-Z0-9]{16}", "gh[opsur]_[A-Za-z0-9]{36}", "github_pat_[A-Za-z0-9_]{82}", "glpat-[A-Za-z0-9_-]{20}", "xox[abprs]-[A-Za-z0-9-]{10,72}",
    "AIza[A-Za-z0-9_-]{35}", "[rs]k_live_[A-Za-z0-9]{24,99}", "npm_[A-Za-z0-9]{36}",
])

#: The base kinds, whose matches only their validators drop, in the order in which kinds are listed.
BASE_KINDS = [
    Kind("email", r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++", "@", 0.9, "mail|contact|write|address", 1.0, 0),
    Kind("ip", r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", "[0-9]", 0.6, "ip|host|server|address|login", 0.9, 0),
    Kind("card", r"[0-9](?:[\x20-]?[0-9])++", "[0-9]", 0.7, "card|visa|master|credit|debit|pay", 0.95, 0),
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", r"\+[0-9]", 0.7, "phone|call|tel|mobile|fax|cell", 0.95, 0),
]
#: Kinds that the method adds.
MORE_KINDS = [
    Kind("iban", rf"(?<![A-Za-z0-9])(?:{_IBAN})(?![A-Za-z0-9])", "[A-Z]{2}[0-9]{2}", 0.9, "iban|account|bank|transfer", 1.0, 0),
    Kind("secret", rf"(?<![A-Za-z0-9_])(?:{_KEYS})(?![A-Za-z0-9_])", "[A-Za-z0-9_]{8}", 0.9, "key|token|secret|password|credential", 1.0, 0),
    Kind("pem", r"-----BEGIN (?:[A-Z]+ ){0,3}PRIVATE KEY-----[A-Za-z0-9+/=\s]++-----END (?:[A-Z]+ ){0,3}PRIVATE KEY-----", "PRIVATE KEY", 1.0, "key", 1.0, 0),
    Kind("jwt", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}+\.[A-Za-z0-9_-]{16,}+", "eyJ", 0.95, "token|bearer|auth|session", 1.0, 0),
    Kind("ssn", r"(?<![0-9-])(?!000|666|9[0-9]{2})[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])", "[0-9]-[0-9]", 0.4, "ssn|social|security|taxpayer", 0.9, 0.5),
]
KINDS = [*BASE_KINDS, *MORE_KINDS]


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(number: Column) -> Column:
    """Whether a string of digits passes: every second digit from the right counts double, 9 less beyond 9."""
    backward = F.reverse(number)

    def value(i: Column) -> Column:
        d = F.substring(backward, i, F.lit(1)).cast("int")
        return F.when(i % 2 == 1, d).otherwise(d * 2 - F.when(d > 4, 9).otherwise(0))

    total = F.aggregate(F.sequence(F.lit(1), F.length(number)), F.lit(0), lambda sum_, i: sum_ + value(i))
    return (F.length(number) > 0) & (total % 10 == 0)


def mod97(account: Column) -> Column:
    """Whether an account number without spaces passes: the first four characters last, A is 10, remainder 1."""
    turned = F.concat(F.substring(account, 5, 64), F.substring(account, 1, 4))

    def step(rest: Column, i: Column) -> Column:
        code = F.ascii(F.substring(turned, i, F.lit(1)))
        return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(turned)), F.lit(0), step) == 1


def confirmed(kind: str, match: Column) -> Column:
    """The validator of a kind."""
    if kind == "ip":
        return F.regexp_like(match, F.lit(rf"^{_IP_PART}(?:\.{_IP_PART}){{3}}$"))
    if kind == "card":
        return F.length(digits(match)).between(12, 19) & luhn(digits(match))
    if kind == "phone":
        return F.length(digits(match)).between(9, 15)
    if kind == "iban":
        plain = F.replace(match, F.lit(" "), F.lit(""))
        return F.length(plain).between(15, 34) & mod97(plain)
    return F.lit(True)


SPAN = "array<struct<start:int,order:int,end:int,kind:string,score:double>>"


FOUND = "array<struct<start:int,end:int,nth:int>>"
#: Matches whose places are added up in one list.
BLOCK = 256


def pairs_of(text: Column, kind: Kind) -> Column:
    """The matches of a kind in order, each with the piece of text before it; last, the piece after all of them, without a match."""
    pieces, matches = F.split(text, kind.pattern, -1), F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    pairs = F.zip_with(pieces, matches, lambda p, m: F.struct(p.alias("piece"), m.alias("match")))
    return F.when(F.regexp_like(text, F.lit(kind.needs)), pairs).otherwise(F.array().cast("array<struct<piece:string,match:string>>"))


def context_of(pairs: Column, nth: Column) -> Column:
    """The text before and after the match with number ``nth`` from 1; not the match itself.

    As only the nearest pieces and matches are joined, the work does not grow with the place in the text.
    """
    piece = F.get(pairs, nth - 1)["piece"]
    first = F.greatest(nth - CONTEXT_MATCHES, F.lit(1))
    earlier = F.transform(F.slice(pairs, first, nth - first), lambda p: F.right(F.concat(p["piece"], p["match"]), F.lit(CONTEXT_CHARS)))
    later = F.transform(
        F.slice(pairs, nth + 1, F.lit(CONTEXT_MATCHES + 1)),
        lambda p: F.left(F.concat(p["piece"], F.coalesce(p["match"], F.lit(""))), F.lit(CONTEXT_CHARS)),
    )
    before = F.right(F.concat(F.array_join(earlier, ""), F.right(piece, F.lit(CONTEXT_CHARS))), F.lit(CONTEXT_CHARS))
    # the words before and after are apart: the match stands between them
    return F.concat(before, F.lit("\n"), F.left(F.array_join(later, ""), F.lit(CONTEXT_CHARS)))


def spans_of(pairs: Column, kind: Kind) -> Column:
    """The confirmed spans of a kind, in code points, end exclusive. ``pairs`` should be a plain column, as it is read often."""
    n = F.size(pairs) - 1

    def start(before: Column) -> Column:
        return F.struct(F.lit(0).alias("at"), before.alias("nth"), F.expr(f"cast(array() as {FOUND})").alias("found"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.char_length(pair["piece"])
        end = begin + F.char_length(pair["match"])
        nth = state["nth"] + 1
        one = F.struct(begin.alias("start"), end.alias("end"), nth.alias("nth"))
        found = F.when(confirmed(kind.name, pair["match"]), F.concat(state["found"], F.array(one))).otherwise(state["found"])
        return F.struct(end.alias("at"), nth.alias("nth"), found.alias("found"))

    def join(state: Column, block: Column) -> Column:
        moved = F.transform(
            block["found"],
            lambda x: F.struct((x["start"] + state["at"]).alias("start"), (x["end"] + state["at"]).alias("end"), x["nth"].alias("nth")),
        )
        return F.struct((state["at"] + block["at"]).alias("at"), F.concat(state["found"], F.array(moved)).alias("found"))

    # Lists grow by copies, so places are added up in blocks, and the blocks are put one behind the other.
    starts = F.filter(F.sequence(F.lit(1), F.greatest(n, F.lit(1)), F.lit(BLOCK)), lambda i: i <= n)
    blocks = F.transform(starts, lambda i: F.aggregate(F.slice(pairs, i, F.least(F.lit(BLOCK), n - i + 1)), start(i - 1), step))
    whole = F.struct(F.lit(0).alias("at"), F.expr(f"cast(array() as array<{FOUND}>)").alias("found"))
    placed = F.flatten(F.aggregate(blocks, whole, join)["found"])
    order = next(i for i, k in enumerate(KINDS) if k.name == kind.name)

    def span(x: Column) -> Column:
        near = F.regexp_like(context_of(pairs, x["nth"]), F.lit(rf"(?i)(?<![a-z])(?:{kind.context})"))
        points = F.when(near, kind.raised).otherwise(kind.score)
        return F.struct(x["start"].alias("start"), F.lit(order).alias("order"), x["end"].alias("end"), F.lit(kind.name).alias("kind"), points.alias("score"))

    kept = F.transform(placed, span)
    kept = F.filter(kept, lambda x: x["score"] >= kind.least) if kind.least else kept
    return kept.cast(SPAN)


def detect(docs: DataFrame, key: str = "doc_id", text: str = "text", kinds: list[Kind] = KINDS) -> DataFrame:
    """(key, spans): every span with start, end, kind and score, by start, then kind as listed.

    A null or empty text has none. Spans of different kinds may overlap. Repeated rows are searched
    each; an empty table gives no rows. Other columns are not read. Context words count in all of the CONTEXT_CHARS
    characters before and after a span.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    rows = docs.select(F.col(key).alias("key"), *[pairs_of(whole, k).alias(k.name) for k in kinds])
    rows = rows.select("key", *[spans_of(F.col(k.name), k).alias(k.name) for k in kinds])
    return rows.select(F.col("key").alias(key), F.array_sort(F.concat(*[F.col(k.name) for k in kinds])).alias("spans"))


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def summary(found: DataFrame, key: str = "doc_id") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone, base_sha256, spans, scores) from ``detect``."""
    base = F.filter("spans", lambda s: s["order"] < len(BASE_KINDS))
    count = lambda name: F.size(F.filter("spans", lambda s: s["kind"] == name)).cast("long")
    return found.select(
        key, *[count(k.name).alias(f"n_{k.name}") for k in BASE_KINDS],
        F.sha2(_listed(base).cast("binary"), 256).alias("base_sha256"), _listed(F.col("spans")).alias("spans"),
        F.array_join(F.transform("spans", lambda s: s["score"].cast("string")), ",").alias("scores"),
    )
