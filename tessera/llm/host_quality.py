"""Host-level quality rules (operator 6).

Every document is measured inside its own row; failures are aggregated by
domain, the failure rates are drawn towards an empirical beta prior, and the
verdict of the host is joined back.  Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WS_CHARS, WS_CLASS, saved

SYMBOLS = "#*$%&|<>"
MAX_RATE = 0.5             # a host is rejected above this shrunk failure rate
MAX_STRENGTH = 1000.0      # bound of the prior's weight, in documents


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once per row."""
    return F.transform(F.array(value), body)[0]


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, WS_CLASS), "")


def repeated_words(ws: Column) -> Column:
    """Words in windows of three words that occur twice or more (the first
    occurrence included).

    Windows are 64-bit hashes.  A row where all are distinct is done; else
    (hash, position) pairs packed into one long are sorted, equal neighbours
    are compared by their whole hashes, and the covered words are counted from
    the sorted positions.
    """
    windows = F.when(F.size(ws) >= 3, F.transform(
        F.sequence(F.lit(0), F.size(ws) - 3),
        lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2))))

    def covered(w: Column) -> Column:
        bits = F.length(F.bin(F.size(w).cast("long")))
        packed = F.sort_array(F.transform(w, lambda h, i: F.call_function(
            "shiftleft", F.call_function("shiftright", h, bits), bits).bitwiseOR(i.cast("long"))))

        def positions(s: Column) -> Column:
            mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1

            def at(j):
                return F.get(s, j).bitwiseAND(mask).cast("int")

            def twin(p, j):
                return F.coalesce(F.get(w, at(j)) == F.get(w, p.bitwiseAND(mask).cast("int")),
                                  F.lit(False))
            hits = F.filter(s, lambda p, j: twin(p, j - 1) | twin(p, j + 1))
            return F.sort_array(F.transform(hits, lambda p: p.bitwiseAND(mask).cast("int")))

        return let(let(packed, positions), lambda p: F.aggregate(
            F.transform(p, lambda x, j: F.least(F.lit(3), F.coalesce(F.get(p, j + 1), x + 3) - x)),
            F.lit(0), lambda a, v: a + v))

    return let(windows, lambda w: F.when(
        F.size(w) > F.size(F.array_distinct(w)), covered(w)).otherwise(F.lit(0)))


def measure(df: DataFrame, text: str = "text") -> dict[str, Column]:
    """The measures of one text, by name; a null text has none of anything."""
    t = F.coalesce(F.col(text), F.lit(""))
    lines = F.filter(F.split(t, "\n"), lambda s: F.length(F.btrim(s, F.lit(WS_CHARS))) > 0)
    per_words = let(words(t), lambda w: F.struct(
        F.size(w).cast("long").alias("n"), repeated_words(w).cast("long").alias("repeat")))
    per_lines = let(lines, lambda s: F.struct(
        F.size(s).cast("long").alias("n"), F.size(F.array_distinct(s)).cast("long").alias("d")))
    return {
        "__w": per_words, "__l": per_lines,
        "word_chars": F.length(F.translate(t, WS_CHARS, "")).cast("long"),
        "n_symbols": (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long"),
    }


def base_rules() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def any_rule() -> Column:
    """A document fails if it fails the base rules, a tenth as many symbols as
    words, half of its lines repeated, or a mean word length outside 2 to 15."""
    return (F.col("base_failed") | (10 * F.col("n_symbols") > F.col("n_words"))
            | (2 * F.col("n_dup_lines") > F.col("n_lines"))
            | (F.col("word_chars") < 2 * F.col("n_words"))
            | (F.col("word_chars") > 15 * F.col("n_words")))


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """(alpha, beta) from the moments of the host failure rates: the mean over
    all documents, and the spread between hosts that sampling alone does not
    explain.  Hosts no different from each other give the largest weight."""
    n, f, h = hosts.agg(F.sum("n"), F.sum("failed"), F.count("*")).first()
    if not n:
        return 1.0, 1.0
    mean = min(max(f / n, 1 / (n + 2)), 1 - 1 / (n + 2))
    (spread,) = hosts.agg(F.sum(F.col("n") * F.pow(F.col("failed") / F.col("n") - F.lit(f / n), 2.0))
                          / F.lit(float(n))).first()
    between = spread - mean * (1 - mean) * (h - 1) / n
    strength = MAX_STRENGTH
    if between > 0:
        strength = min(MAX_STRENGTH, max(1.0, mean * (1 - mean) / between - 1))
    return mean * strength, (1 - mean) * strength


def host_rules(df: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source",
               max_rate: float = MAX_RATE) -> DataFrame:
    """Measures and verdict of every document: ``doc_id, n_words, word_chars,
    n_symbols, n_dup_lines, n_repeat_words, base_failed, kept`` and the host's
    ``host_rate``.

    ``kept`` is false for documents that fail the base rules and for all
    documents of a host whose shrunk failure rate exceeds ``max_rate``.  A
    null text has no words and fails; a document without a host (null) is
    judged by its own rules alone.  Repeated rows count and come out as often
    as they occur; an empty table gives an empty result; other columns of
    ``df`` are not read.
    """
    rows = df.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("host"),
                     F.col(text).alias("text"))
    measured = rows.withColumns(measure(rows)).select(
        "doc_id", "host", F.col("__w.n").alias("n_words"), "word_chars", "n_symbols",
        (F.col("__l.n") - F.col("__l.d")).alias("n_dup_lines"),
        F.col("__w.repeat").alias("n_repeat_words"), F.col("__l.n").alias("n_lines"))
    docs = saved(measured.withColumn("base_failed", base_rules())
                 .withColumn("failed", any_rule()), "quality")
    hosts = (docs.where(F.col("host").isNotNull()).groupBy("host")
             .agg(F.count("*").alias("n"), F.sum(F.col("failed").cast("long")).alias("failed")))
    alpha, beta = beta_prior(hosts)
    rates = hosts.select("host", ((F.col("failed") + F.lit(alpha))
                                  / (F.col("n") + F.lit(alpha + beta))).alias("host_rate"))
    return docs.join(rates, "host", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed",
        (~F.col("base_failed") & (F.coalesce("host_rate", F.lit(0.0)) <= max_rate)).alias("kept"),
        "host_rate")
