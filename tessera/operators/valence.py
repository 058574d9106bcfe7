"""Polarity with context (TXT5): a word's valence depends on the words before
it, on "but", on capitals and on exclamation marks.

Everything happens on the token array of the row: no token is exploded,
joined or shuffled; the lexicon is a fixed dictionary of the plan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.folds import dictionary
from ..functions.strings import words

LOOKBACK = 3               # words before a word that can change it


@dataclass(frozen=True)
class Rules:
    """Valences and what changes them (the library's own numbers)."""
    valence: dict
    #: Words that strengthen (above 0) or weaken (below 0) a following word.
    degree: dict = field(default_factory=lambda: {
        "very": 0.3, "really": 0.3, "so": 0.3, "extremely": 0.4, "slightly": -0.3, "barely": -0.3,
        "somewhat": -0.2})
    #: Words that turn a following word round.
    negation: tuple = ("not", "no", "never", "nothing", "without")
    turn: str = "but"      # weighs what stands before it less, what follows more
    negated: float = -0.75
    distance: tuple = (1.0, 0.75, 0.5)      # how much of a degree reaches the next words
    capitals: float = 0.7
    before_turn: float = 0.5
    after_turn: float = 1.5
    mark: float = 0.3      # per exclamation mark, for at most ``marks`` of them
    marks: int = 4
    alpha: float = 15.0


def word_scores(rows: DataFrame, text: str, rules: Rules, out: str) -> DataFrame:
    """``rows`` and the valence in context of every word, as an array.

    For a word with a valence: capitals in a text that has lower-case words
    add to its size; each of the three words before it adds its degree, less
    with distance, never beyond nought; one negation among them turns it
    round; the first ``turn`` word weighs both sides."""
    value = dictionary(rules.valence, lambda v: F.lit(float(v)))
    degree = dictionary(rules.degree, lambda v: F.lit(float(v)))
    negation = dictionary({w: 1 for w in rules.negation}, F.lit)
    rows = rows.withColumn("_said", words(F.col(f"`{text}`")))
    rows = rows.withColumn("_words", F.transform("_said", lambda t: F.lower(t)))
    rows = rows.withColumns({
        "_value": F.transform("_words", lambda t: F.coalesce(value(t), F.lit(0.0))),
        "_degree": F.transform("_words", lambda t: F.coalesce(degree(t), F.lit(0.0))),
        "_not": F.transform("_words", lambda t: negation(t).isNotNull()),
        "_mixed": F.exists(F.zip_with("_said", "_words", lambda a, b: (a == b) & (F.upper(b) != b)),
                           lambda lower: lower),
        "_turn": F.array_position("_words", rules.turn)})
    zero = F.lit(0.0)

    def score(v: Column, i: Column) -> Column:
        said = F.get("_said", i)
        loud = F.col("_mixed") & (F.length(said) > 1) & (F.upper(said) == said) & (F.lower(said) != said)
        size = F.abs(v) + F.when(loud, F.lit(rules.capitals)).otherwise(zero)
        for back, share in enumerate(rules.distance[:LOOKBACK], 1):
            size = size + F.when(i >= back, F.get("_degree", i - back) * share).otherwise(zero)
        turned = zero != zero
        for back in range(1, LOOKBACK + 1):
            turned = turned | ((i >= back) & F.get("_not", i - back))
        side = F.when(F.col("_turn") == 0, F.lit(1.0)).when(i + 1 < F.col("_turn"), F.lit(rules.before_turn)) \
            .when(i + 1 > F.col("_turn"), F.lit(rules.after_turn)).otherwise(F.lit(1.0))
        return F.signum(v) * F.greatest(size, zero) * F.when(turned, F.lit(rules.negated)) \
            .otherwise(F.lit(1.0)) * side
    rows = rows.withColumn(out, F.transform("_value", lambda v, i: F.when(v != 0, score(v, i)).otherwise(zero)))
    return rows.drop("_said", "_words", "_value", "_degree", "_not", "_mixed", "_turn")


def polarity_in_context(df: DataFrame, text: str, rules: Rules, keep=()) -> DataFrame:
    """``keep`` with ``Compound``, ``Positive``, ``Neutral`` and ``Negative`` of
    every text.

    ``s`` is the sum of the words' scores, moved away from nought by the
    exclamation marks; ``Compound = s / sqrt(s * s + alpha)``.  The shares are
    the weights (score + 1, 1 - score, 1) of positive, negative and other words
    over their sum.  A null text, and one without words, scores 0."""
    rows = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"))
    rows = word_scores(rows, "_text", rules, "_scores")
    loud = F.least(F.coalesce(F.regexp_count("_text", F.lit("!")), F.lit(0)), F.lit(rules.marks)) \
        * F.lit(rules.mark)

    def total(f):
        return F.aggregate(F.coalesce("_scores", F.array().cast("array<double>")), F.lit(0.0),
                           lambda a, x: a + f(x))
    rows = rows.select(
        *[F.col(f"`{c}`") for c in keep], loud.alias("_loud"), total(lambda x: x).alias("_sum"),
        total(lambda x: F.when(x > 0, x + 1).otherwise(0.0)).alias("_up"),
        total(lambda x: F.when(x < 0, 1 - x).otherwise(0.0)).alias("_down"),
        total(lambda x: F.when(x == 0, 1.0).otherwise(0.0)).alias("_flat"))
    s = F.col("_sum") + F.signum("_sum") * F.col("_loud")
    every = F.col("_up") + F.col("_down") + F.col("_flat")

    def share(c):
        return F.when(every > 0, F.col(c) / every).otherwise(F.lit(0.0))
    return rows.select(*[F.col(f"`{c}`") for c in keep],
                       (s / F.sqrt(s * s + F.lit(rules.alpha))).alias("Compound"),
                       share("_up").alias("Positive"), share("_flat").alias("Neutral"),
                       share("_down").alias("Negative"))
