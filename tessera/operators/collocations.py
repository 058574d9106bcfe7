"""Two-word terms of a word cloud (TXT6): pairs of neighbours that stand
together more often than their words' own counts explain become terms, and
their occurrences leave the counts of the single words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import lower_words
from ..session import stored
from .text import term_weights

THRESHOLD = 30.0           # likelihood ratio from which a pair is a term


def pair_counts(df: DataFrame, text: str, stop: DataFrame) -> DataFrame:
    """(a, b, n): neighbours of which neither is a stop word.  Pairs are
    counted in the tasks before they shuffle, and stop words leave the counted
    table."""
    rows = df.select(lower_words(F.col(f"`{text}`")).alias("_w"))
    after = F.slice("_w", F.lit(2), F.greatest(F.size("_w") - 1, F.lit(0)))
    pairs = F.arrays_zip(F.col("_w").alias("a"), after.alias("b"))       # the last has no b
    counted = (rows.select(F.explode_outer(pairs).alias("p")).where("p.b IS NOT NULL").select("p.a", "p.b")
               .groupBy("a", "b").agg(F.count(F.lit(1)).alias("n")))
    for side in ("a", "b"):
        counted = counted.join(stop.select(F.col("token").alias(side)), side, "left_anti")
    return counted.select("a", "b", "n")


def likelihood_ratio(n: Column, left: Column, right: Column, total: Column) -> Column:
    """Twice the log likelihood ratio of the 2 x 2 table of a pair: together
    ``n`` times, its words first ``left`` and second ``right`` times, among
    ``total`` pairs."""
    cells = ((n, left, right), (left - n, left, total - right), (right - n, total - left, right),
             (total - left - right + n, total - left, total - right))
    out = F.lit(0.0)
    for seen, row, column in cells:
        seen, row, column = (c.cast("double") for c in (seen, row, column))
        out = out + F.when(seen > 0, seen * F.ln(seen * total / (row * column))).otherwise(0.0)
    return 2 * out


def collocations(pairs: DataFrame, threshold: float = THRESHOLD, least: int = 2) -> DataFrame:
    """(a, b, n, ratio): the pairs that are terms, at least ``least`` times
    together and more often than by chance.  The counted pairs are stored, as
    their number, the words' counts and the ratio read them; only pairs that
    are frequent enough meet the words' counts.  One number, the count of all
    pairs, reaches the driver."""
    pairs = stored(pairs, "pairs")
    total = pairs.agg(F.sum("n")).first()[0] or 0
    left = pairs.groupBy("a").agg(F.sum("n").alias("_l"))
    right = pairs.groupBy("b").agg(F.sum("n").alias("_r"))
    rated = pairs.where(F.col("n") >= least).join(left, "a").join(right, "b").withColumn(
        "ratio", likelihood_ratio(F.col("n"), F.col("_l"), F.col("_r"), F.lit(total)))
    more = F.col("n").cast("double") * total > F.col("_l").cast("double") * F.col("_r")
    return rated.where(more & (F.col("ratio") >= threshold)).select("a", "b", "n", "ratio")


def cloud_terms(singles: DataFrame, found: DataFrame) -> DataFrame:
    """(token, n): the single words without their occurrences inside pairs,
    and the pairs, written with a blank.  A word inside several pairs loses all
    of them, and is gone at nought or below."""
    inside = found.select(F.explode(F.array("a", "b")).alias("token"), "n") \
        .groupBy("token").agg(F.sum("n").alias("_in"))
    left = singles.join(inside, "token", "left").select(
        "token", (F.col("n") - F.coalesce("_in", F.lit(0))).alias("n")).where("n > 0")
    return left.unionByName(found.select(F.concat_ws(" ", "a", "b").alias("token"), "n"))


def cloud_weights(singles: DataFrame, pairs: DataFrame, k: int = 200,
                  threshold: float = THRESHOLD) -> DataFrame:
    """The ``k`` most frequent terms with ``rank`` and ``weight``, the count
    relative to the largest."""
    return term_weights(cloud_terms(singles, stored(collocations(pairs, threshold), "terms")), k=k)
