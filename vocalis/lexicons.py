"""Word lists and tables the text steps run with. All of them are parameters; these are the defaults."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# They must equal the published lists for the results to agree.
# ---------------------------------------------------------------------------

#: The usual public English stop-word list. Entries with an apostrophe cannot occur in cleaned text.
ENGLISH_STOPWORDS = """
i me my myself we our ours ourselves you you're you've you'll you'd your yours yourself yourselves
he him his himself she she's her hers herself it it's its itself they them their theirs themselves
what which who whom this that that'll these those am is are was were be been being have has had
having do does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on off over
under again further then once here there when where why how all any both each few more most other
some such no nor not only own same so than too very s t can will just don don't should should've
now d ll m o re ve y ain aren aren't couldn couldn't didn didn't doesn doesn't hadn hadn't hasn
hasn't haven haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan shan't shouldn
shouldn't wasn wasn't weren weren't won won't wouldn wouldn't
""".split()

#: Further words removed from comments and headlines.
COMMENT_STOPWORDS = """
i me my mine we us our you your he him his she her it its
is are am do does did be been being
have has had can could will would shall should may might must
myself ourselves yourself yourselves himself herself themselves
what which who whom whose where when why how
they them their that this there here a an the
was were in on of at for with as to from by
about against between into through during before after above
below up down out off over under again further then once
thank thanks please plz pls yes no yeah yep yup ok okay
subscribe subscribed subscribing like liked liking
bro nobody none everybody everyone everything everywhere anyone anybody anything anywhere
""".split()

STOPWORDS = sorted(set(ENGLISH_STOPWORDS) | set(COMMENT_STOPWORDS))

PHONE_MODELS = ["samsung", "huawei", "xiaomi", "nokia"]

#: Topic -> keywords, matched as they stand (case-sensitively) inside cleaned text.
TOPICS = {
    "dimensions": ["size", "dimensions", "length", "width", "height", "compact"],
    "OS": ["operating system", "iOS", "Android", "software", "update", "version"],
    "screen size": ["screen size", "display", "inches", "size", "screen"],
    "resolution": ["resolution", "pixel", "PPI", "HD", "4K", "2K", "FHD", "retina"],
    "CPU": ["CPU", "processor", "chip", "performance", "speed", "cores", "GHz"],
    "RAM": ["RAM", "memory", "gigabytes", "GB", "performance", "multitasking"],
    "storage": ["storage", "internal storage", "capacity", "GB", "TB", "memory"],
    "battery": ["battery", "mAh", "battery life", "charge", "charging", "power"],
    "camera": ["camera", "megapixels", "photo", "picture", "video", "selfie", "lens", "image"],
    "performance": ["performance", "fast", "speed", "lag", "smooth", "gaming", "multi-tasking"],
    "design": ["design", "style", "look", "color", "build quality", "material", "aesthetic"],
    "price": ["price", "cost", "expensive", "cheap", "affordable", "value"],
}

MENTION = "iphone"
SUBREDDITS = ["apple", "iphone", "technology"]
SEARCH_TEXT = "iphone 16"

#: Texts a CSV reader with the usual defaults takes for a missing value.
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "n/a", "nan", "null",
]

# Rule words and weights of the published rule-based polarity scorer.
INTENSIFY = 0.293
INTENSIFIERS = """
absolutely amazingly awfully completely considerably decidedly deeply effing enormously entirely
especially exceptionally extremely fabulously flipping flippin fricking frickin frigging friggin
fully fucking greatly hella highly hugely incredibly intensely majorly more most particularly
purely quite really remarkably so substantially thoroughly totally tremendously uber unbelievably
unusually utterly very
""".split()
DAMPENERS = """
almost barely hardly kinda kindof less little marginally occasionally partly scarcely slightly
somewhat sorta sortof
""".split()
DAMPENER_PAIRS = ["just enough", "kind of", "sort of"]
NEGATORS = """
aint arent cannot cant couldnt darent didnt doesnt dont hadnt hasnt havent isnt mightnt mustnt
neither neednt never none nope nor not nothing nowhere oughtnt shant shouldnt uhuh wasnt werent
without wont wouldnt rarely seldom despite
""".split()
EMPHATIC_AFTER_NEVER = ["so", "this"]
IDIOMS = {
    "the shit": 3.0,
    "the bomb": 3.0,
    "bad ass": 1.5,
    "yeah right": -2.0,
    "cut the mustard": 2.0,
    "kiss of death": -1.5,
    "hand to mouth": -2.0,
}
NEGATION_WEIGHT = -0.74
DISTANCE_WEIGHTS = (1.0, 0.95, 0.9)
EMPHASIS_WEIGHTS = (1.0, 1.5, 1.25)
NORMALIZER = 15.0
POSITIVE_ABOVE = 0.2
NEGATIVE_BELOW = -0.2

# ---------------------------------------------------------------------------

#: A small starter list of word valences (about -4 .. +4). Real runs load a full list with ``read_valences``.
STARTER_VALENCES = {
    "amazing": 2.8, "awesome": 3.1, "beautiful": 2.9, "best": 3.2, "better": 1.9, "brilliant": 2.8,
    "cool": 1.3, "excellent": 2.7, "excited": 1.4, "fantastic": 2.6, "fine": 0.8, "free": 2.3,
    "fun": 2.3, "good": 1.9, "great": 3.1, "happy": 2.7, "hope": 1.9, "impressive": 2.3,
    "improved": 2.1, "improvement": 2.0, "interesting": 1.7, "love": 3.2, "loved": 2.9, "nice": 1.8,
    "perfect": 2.7, "pretty": 2.2, "smart": 1.7, "solid": 0.6, "strong": 2.3, "superior": 2.5,
    "win": 2.8, "winner": 2.8, "worth": 0.9, "wow": 2.8,
    "angry": -2.3, "annoying": -1.7, "awful": -2.0, "bad": -2.5, "boring": -1.3, "broken": -2.1,
    "crap": -1.6, "cry": -2.1, "dead": -3.3, "disappointed": -1.9, "disappointing": -2.2, "fail": -2.5,
    "failed": -2.3, "fake": -2.1, "garbage": -1.5, "hate": -2.7, "horrible": -2.5, "issue": -0.9,
    "issues": -1.1, "joke": 1.2, "kill": -3.7, "lost": -1.3, "mistake": -1.4, "pathetic": -2.7,
    "poor": -2.1, "problem": -1.7, "problems": -1.7, "sad": -2.1, "scam": -2.7, "stupid": -2.4,
    "terrible": -2.1, "trash": -1.2, "ugly": -2.3, "useless": -1.8, "waste": -1.8, "weak": -1.9,
    "worse": -2.1, "worst": -3.1, "wrong": -2.1,
}


@dataclass(frozen=True)
class PolarityRules:
    """Context words of the polarity scorer; valences come separately, as a table."""

    boosters: dict[str, float] = field(
        default_factory=lambda: {**{w: INTENSIFY for w in INTENSIFIERS}, **{w: -INTENSIFY for w in DAMPENERS}}
    )
    booster_pairs: tuple[str, ...] = tuple(DAMPENER_PAIRS)
    negators: tuple[str, ...] = tuple(NEGATORS)
    emphatic: tuple[str, ...] = tuple(EMPHATIC_AFTER_NEVER)
    idioms: dict[str, float] = field(default_factory=lambda: dict(IDIOMS))

    def reachable(self, stopwords: Iterable[str]) -> PolarityRules:
        """The rules that can still apply to text without the stop words; the others are dead weight in a plan."""
        stop = set(stopwords)

        def alive(phrase: str) -> bool:
            return not stop.intersection(phrase.split())

        return PolarityRules(
            boosters={w: b for w, b in self.boosters.items() if alive(w)},
            booster_pairs=tuple(filter(alive, self.booster_pairs)),
            negators=tuple(filter(alive, self.negators)),
            emphatic=tuple(filter(alive, self.emphatic)),
            idioms={p: v for p, v in self.idioms.items() if alive(p)},
        )


def valence_table(spark: SparkSession, valences: dict[str, float] | None = None) -> DataFrame:
    """Valences given as a dictionary, as a (token, valence) table."""
    given = STARTER_VALENCES if valences is None else valences
    return small_table(spark, "token string, valence double", list(given), [float(v) for v in given.values()])


def small_table(spark: SparkSession, schema: str, *columns: list) -> DataFrame:
    """Columns held by the driver as a table that needs no job to read; none of them may be long."""
    kinds = {"string": pa.string(), "double": pa.float64()}
    names, types = zip(*[field.split() for field in schema.split(", ")])
    arrays = [pa.array(values, kinds[kind]) for values, kind in zip(columns, types)]
    return spark.createDataFrame(pa.Table.from_arrays(arrays, names=list(names)), schema)


def read_valences(spark: SparkSession, path: str) -> DataFrame:
    """Valences from a tab-separated file: word, mean valence, then columns that are ignored."""
    cells = spark.read.text(path).select(F.split("value", "\t").alias("cells"))
    word, mean = F.get("cells", F.lit(0)), F.get("cells", F.lit(1))
    rows = cells.select(F.lower(F.trim(word)).alias("token"), mean.try_cast("double").alias("valence"))
    return rows.where("token <> '' and valence is not null")
