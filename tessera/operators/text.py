"""Review text operators (FLT6, STR10-12 over corpora, TXT1-7, AGG11).

Corpus-wide counts explode the tokens and use a hash aggregate with map-side
combine; stop words are removed after counting, on the far smaller
(token, count) table.  Lexicons (tags, valences, stop words) are tables joined
on the token, of any size: a local relation under the broadcast threshold is
joined where the tokens are, a larger one is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import _c, lower_words
from .aggregates import per_group, top_k_per_group
from .joins import fixed_table

# Fixed values -------------------------------------------------------------
# English stop words (a common public list) plus the analysis' own additions
# "translated", "google", "show", "less", "show less"; "not" is kept as a
# content word because it carries negation.
ENGLISH_STOP_WORDS = (
    "i me my myself we our ours ourselves you you're you've you'll you'd your "
    "yours yourself yourselves he him his himself she she's her hers herself "
    "it it's its itself they them their theirs themselves what which who whom "
    "this that that'll these those am is are was were be been being have has "
    "had having do does did doing a an the and but if or because as until "
    "while of at by for with about against between into through during before "
    "after above below to from up down in out on off over under again further "
    "then once here there when where why how all any both each few more most "
    "other some such no nor not only own same so than too very s t can will "
    "just don don't should should've now d ll m o re ve y ain aren aren't "
    "couldn couldn't didn didn't doesn doesn't hadn hadn't hasn hasn't haven "
    "haven't isn isn't ma mightn mightn't mustn mustn't needn needn't shan "
    "shan't shouldn shouldn't wasn wasn't weren weren't won won't wouldn wouldn't"
).split()
CUSTOM_STOP_WORDS = ("translated", "google", "show", "less", "show less")
KEPT_WORDS = ("not",)

# Part-of-speech tags and their descriptions, as used by the analysis.
TAG_DESCRIPTIONS = (
    ("CC", "Conjunction"),
    ("CD", "cardinal digit"),
    ("DT", "determiner"),
    ("EX", "existential"),
    ("FW", "foreign word"),
    ("IN", "preposition/subordinating conjunction"),
    ("JJ", "adjective"),
    ("JJR", "adjective, comparative"),
    ("JJS", "adjective, superlative"),
    ("LS", "list marker"),
    ("MD", "modal"),
    ("NN", "noun, singular"),
    ("NNS", "noun plural"),
    ("NNP", "proper noun"),
    ("NNPS", "proper noun"),
    ("PDT", "predeterminer"),
    ("POS", "possessive ending"),
    ("PRP", "personal pronoun"),
    ("PRP$", "possessive pronoun"),
    ("RB", "adverb"),
    ("RBR", "adverb"),
    ("RBS", "adverb, superlative"),
    ("RP", "particle"),
    ("TO", "to"),
    ("UH", "interjection"),
    ("VB", "verb, base form"),
    ("VBD", "verb, past tense"),
    ("VBG", "verb, gerund/present"),
    ("VBN", "verb, past participle taken"),
    ("VBP", "verb, present"),
    ("VBZ", "verb, 3rd person"),
    ("WDT", "wh-determiner"),
    ("WP", "wh-pronoun"),
    ("WP$", "possessive wh-pronoun"),
    ("WRB", "wh-abverb where, when"),
)

# Word families compared by the analysis: tag prefix -> family name.
TAG_FAMILIES = (("NN", "Noun"), ("V", "Verb"), ("JJ", "Adjective"), ("RB", "Adverb"))
# -------------------------------------------------------------------------

# Closed-class words of a small rule-based tagger (own table).
CLOSED_CLASS = {
    "the": "DT", "a": "DT", "an": "DT", "this": "DT", "that": "DT", "these": "DT",
    "those": "DT", "and": "CC", "or": "CC", "but": "CC", "of": "IN", "in": "IN",
    "on": "IN", "at": "IN", "by": "IN", "for": "IN", "with": "IN", "from": "IN",
    "as": "IN", "than": "IN", "to": "TO", "is": "VBZ", "are": "VBP", "was": "VBD",
    "were": "VBD", "be": "VB", "been": "VBN", "has": "VBZ", "have": "VBP",
    "had": "VBD", "it": "PRP", "he": "PRP", "she": "PRP", "they": "PRP", "we": "PRP",
    "i": "PRP", "you": "PRP", "his": "PRP$", "her": "PRP$", "their": "PRP$",
    "not": "RB", "very": "RB", "then": "RB", "there": "EX", "can": "MD",
    "will": "MD", "would": "MD", "should": "MD", "who": "WP", "which": "WDT",
    "when": "WRB", "where": "WRB",
}

# Suffix rules of the tagger, tried in order after the closed-class words.
SUFFIX_RULES = (
    ("ing", "VBG"), ("ed", "VBD"), ("ly", "RB"), ("tion", "NN"), ("ment", "NN"),
    ("ness", "NN"), ("ble", "JJ"), ("ous", "JJ"), ("ful", "JJ"), ("ive", "JJ"),
    ("est", "JJS"), ("er", "NN"),
)

# Small valence lexicon for polarity scoring (own values, -4..4 scale).
DEFAULT_VALENCE = {
    "good": 1.9, "great": 3.1, "nice": 1.8, "excellent": 2.7, "delicious": 2.7,
    "friendly": 2.2, "love": 3.2, "best": 3.2, "tasty": 2.0, "fresh": 1.3,
    "bad": -2.5, "poor": -2.1, "worst": -3.1, "slow": -1.0, "rude": -2.0,
    "dirty": -1.9, "bland": -1.2, "expensive": -0.9, "terrible": -2.1, "not": -0.8,
}


def stop_words() -> list:
    words = dict.fromkeys(ENGLISH_STOP_WORDS + list(CUSTOM_STOP_WORDS))
    return [w for w in words if w not in KEPT_WORDS]


def stop_table(spark: SparkSession) -> DataFrame:
    return fixed_table(spark, [(w,) for w in stop_words()], "token string")


def tag_table(spark: SparkSession) -> DataFrame:
    return fixed_table(spark, list(TAG_DESCRIPTIONS), "tag string, description string")


def tokens(df: DataFrame, text: str, keep=(), pos: bool = False) -> DataFrame:
    """One row per lower-cased word token (STR10, STR11, ARR1)."""
    t = lower_words(F.col(text))
    if pos:
        return df.select(*keep, F.posexplode(t).alias("pos", "token"))
    return df.select(*keep, F.explode(t).alias("token"))


def drop_stopwords(tok: DataFrame, stop: DataFrame, token: str = "token",
                   count: str | None = None) -> DataFrame:
    """Tokens not in the stop list (FLT6): anti join with the broadcast list.

    Catalyst pushes an anti join on grouping keys below their aggregate, where
    every occurrence is looked up.  For counted tokens ``count`` names the
    count (always > 0); the join is tied to it and looks up every word once."""
    if count is not None:
        listed = stop.select(F.col("token").alias("_stop"))
        return tok.join(listed, per_group(F.col(token), count) == F.col("_stop"), "left_anti")
    return tok.join(stop.withColumnRenamed("token", token), on=token, how="left_anti")


def lexicon_table(spark: SparkSession, words: dict | None = None) -> DataFrame:
    """(token, tag) of the closed-class words, or of a given lexicon."""
    words = CLOSED_CLASS if words is None else words
    return fixed_table(spark, list(words.items()), "token string, tag string")


def valence_table(spark: SparkSession, words: dict | None = None) -> DataFrame:
    """(token, valence) of the default or a given polarity lexicon."""
    words = DEFAULT_VALENCE if words is None else words
    return fixed_table(spark, [(w, float(v)) for w, v in words.items()],
                       "token string, valence double")


def rule_tag(token) -> Column:
    """Tag of a lower-cased token no lexicon lists: digits, suffix rules, else NN."""
    t = _c(token)
    # digits only, without a regex: deleting the digits leaves nothing
    e = F.when((t != "") & (F.translate(t, "0123456789", "") == ""), F.lit("CD"))
    for suf, tag in SUFFIX_RULES:
        # the cheap byte comparison first; the length is only counted on a match
        e = e.when(t.endswith(suf) & (F.length(t) > len(suf) + 1), F.lit(tag))
    return e.otherwise(F.lit("NN"))


def with_tag(terms: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """``terms`` (with a ``token``) and the tag of each: the lexicon's if it
    lists the token, else the rules'.  A token is listed once; null for null."""
    lex = lexicon_table(terms.sparkSession) if lexicon is None else lexicon
    lex = lex.select("token", F.col("tag").alias("_tag"))
    out = terms.join(lex, "token", "left")
    tag = F.when(F.col("token").isNotNull(), F.coalesce("_tag", rule_tag("token")))
    return out.withColumn("tag", tag).drop("_tag")


def tag_tokens(df: DataFrame, text: str, lexicon: DataFrame | None = None, keep=()) -> DataFrame:
    """Every token of every text with its position and tag (TXT1)."""
    return with_tag(tokens(df, text, keep, pos=True), lexicon)


def family_expr(tag) -> Column:
    t = _c(tag)
    e = None
    for prefix, name in TAG_FAMILIES:
        e = F.when(t.startswith(prefix), F.lit(name)) if e is None else \
            e.when(t.startswith(prefix), F.lit(name))
    return e


def counted_terms(tok: DataFrame, stop: DataFrame, by=(), times: str | None = None) -> DataFrame:
    """(by..., token, n) with stop words removed after counting (AGG11, FLT6).
    ``times`` names a column that says how often (at least once) a row counts."""
    n = F.count(F.lit(1)) if times is None else F.sum(times)
    counts = tok.groupBy(*by, "token").agg(n.cast("bigint").alias("n"))
    return drop_stopwords(counts, stop, count="n")


def top_terms(counts: DataFrame, by=(), k: int = 20) -> DataFrame:
    """Top ``k`` terms per group by count, ties by token (SRT5, TXT7)."""
    order = [F.col("n").desc(), F.col("token").asc()]
    if not by:
        from .relational import with_rank
        return with_rank(counts.orderBy(*order).limit(k), order)
    # Spark inserts a partial WindowGroupLimit before the shuffle: every map
    # task forwards at most k rows per group, so no task sees a whole group.
    return top_k_per_group(counts, list(by), order, k)


def top_by_tag(tokens_df: DataFrame, stop: DataFrame, k: int = 20,
               lexicon: DataFrame | None = None, times: str | None = None) -> DataFrame:
    """Most frequent words of each family (noun, verb, adjective, adverb),
    stop words out, top ``k`` per family (TXT2) — one pass for all families.

    The tagger looks at the token alone, so tokens are counted first and
    only the vocabulary is tagged: the tag rules run once per distinct word,
    not once per occurrence."""
    return top_of_counts(counted_terms(tokens_df, stop, times=times), k, lexicon)


def top_of_counts(counts: DataFrame, k: int = 20, lexicon: DataFrame | None = None) -> DataFrame:
    """``top_by_tag`` of words that are counted already: (token, n), each word
    once, stop words out."""
    counts = with_tag(counts, lexicon)
    fam = counts.withColumn("family", per_group(family_expr("tag")))
    return top_terms(fam.filter(F.col("family").isNotNull()).select("family", "token", "n"),
                     by=["family"], k=k)


def describe_terms(terms: DataFrame, tags: DataFrame, lexicon: DataFrame | None = None) -> DataFrame:
    """Tag each listed term and describe its tag; unknown tags give null (TXT3)."""
    return with_tag(terms, lexicon).join(tags, on="tag", how="left")


def polarity(df: DataFrame, text: str, lexicon: DataFrame | dict | None = None, keep=(),
             alpha: float = 15.0) -> DataFrame:
    """Lexicon polarity of every text (TXT5): the columns ``keep`` with
    ``Compound``, ``Positive``, ``Neutral`` and ``Negative``.

    ``s`` is the sum of the valences of the text's tokens;
    ``compound = s / sqrt(s*s + alpha)``.  The shares are the positive weight
    (valence + 1 per positive token), the negative weight (1 - valence per
    negative token) and the neutral weight (1 per other token) over their sum.
    Tokens are joined with the lexicon (a table with ``token`` and
    ``valence``, each token once).  A lexicon under the broadcast threshold is
    joined in the task that read the text, which also sums up, so one row per
    text is shuffled; a larger one shuffles the tokens.  A text without tokens
    scores 0.
    """
    if not isinstance(lexicon, DataFrame):
        lexicon = valence_table(df.sparkSession, lexicon)
    lex = lexicon.select(F.col("token").alias("_t"), F.col("valence").alias("_v"))
    kept = F.struct(*[F.col(c) for c in keep]) if keep else F.struct(F.lit(0).alias("_none"))
    numbered = df.select(F.monotonically_increasing_id().alias("_row"), kept.alias("_kept"),
                         lower_words(F.col(text)).alias("_words"))
    rows = numbered.select("_row", "_kept", F.explode_outer("_words").alias("_t"))
    zero = F.lit(0.0)
    x = F.coalesce("_v", zero)
    sums = rows.join(lex, "_t", "left").groupBy("_row").agg(
        F.first("_kept").alias("_kept"), F.sum(x).alias("s"),
        F.sum(F.when(x > 0, x + 1).otherwise(zero)).alias("pw"),
        F.sum(F.when(x < 0, 1 - x).otherwise(zero)).alias("nw"),
        F.count_if(F.col("_t").isNotNull() & (x == 0)).cast("double").alias("uw"))
    s, pw, nw, uw = (F.col(k) for k in ("s", "pw", "nw", "uw"))
    all_w = pw + nw + uw

    def share(w):
        return F.when(all_w > 0, w / all_w).otherwise(zero)
    return sums.select(*[F.col("_kept")[c].alias(c) for c in keep],
                       (s / F.sqrt(s * s + F.lit(alpha))).alias("Compound"),
                       share(pw).alias("Positive"), share(uw).alias("Neutral"),
                       share(nw).alias("Negative"))


def term_weights(counts: DataFrame, by=(), k: int = 200) -> DataFrame:
    """Word-cloud weights: count relative to the group's largest count, for
    the top ``k`` terms of each group (TXT6)."""
    top = top_terms(counts, by, k)
    from pyspark.sql import Window
    w = Window.partitionBy(*by) if by else Window.partitionBy()
    return top.withColumn("weight", F.col("n") / F.max("n").over(w))
