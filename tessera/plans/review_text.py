"""P3 text analytics: tokens, stop words, unigrams per sentiment, word
families by tag, tag descriptions, word-cloud weights and polarity
(STR10-11, ARR1, FLT6, FLT9, AGG9, AGG11, SRT5-6, JN6-7, PRJ5, TXT1-7)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.strings import words
from ..operators import aggregates as agg
from ..operators import joins, relational as rel
from ..operators import text as T
from ..session import stored
from .catalog import query, table
from .reviews import (BIN_WIDTH, CLEAN_SQL, N_BINS, R, bins_table, combined, distinct_texts, tokens_sql,
                      with_word_count)

DOC = "documents"
TOP = 20
SHOWN = 10
LABELS = ("Positive", "Neutral", "Negative")

# Valences used by the registered polarity queries.  The test corpus is
# invented prose, so the lexicon names frequent tokens of that prose
# (besides a few English words); the library default is ``T.DEFAULT_VALENCE``.
TEST_VALENCE = {
    "good": 1.9, "not": -0.8, "ing": 1.2, "tion": 0.8, "ly": -0.6, "ble": 1.5, "ed": -1.1,
    "ther": 0.4, "than": -0.3, "nicht": -1.4, "pas": -1.2, "bien": 1.6, "bueno": 1.7,
}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


STOP_SQL = sql_in(T.stop_words())
WORDS_SQL = "regexp_extract_all({c}, '[\\p{{L}}\\p{{N}}_]+')"


def words_sql(c: str) -> str:
    return WORDS_SQL.format(c=c)


def tag_sql(tok: str) -> str:
    closed = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in T.CLOSED_CLASS.items())
    rules = " ".join(f"WHEN length({tok}) > {len(s) + 1} AND ends_with({tok}, {_q(s)}) "
                     f"THEN {_q(t)}" for s, t in T.SUFFIX_RULES)
    return (f"COALESCE(CASE {tok} {closed} END, CASE WHEN regexp_full_match({tok}, '[0-9]+') "
            f"THEN 'CD' {rules} ELSE 'NN' END)")


def family_sql(tag: str) -> str:
    return "CASE " + " ".join(f"WHEN starts_with({tag}, {_q(p)}) THEN {_q(n)}"
                              for p, n in T.TAG_FAMILIES) + " END"


TAGS_SQL = "(VALUES " + ", ".join(f"({_q(t)}, {_q(d)})" for t, d in T.TAG_DESCRIPTIONS) + \
    ") AS tg(tag, description)"


def lexicon_sql(lex: dict) -> str:
    return "(VALUES " + ", ".join(f"({_q(k)}, CAST({v} AS DOUBLE))" for k, v in lex.items()) + \
        ") AS lx(token, val)"


# --- Spark building blocks -------------------------------------------------

def review_tokens(spark, sf, by=()) -> DataFrame:
    """(by..., times, token): the words of the cleaned reviews.  A text is cut
    once (per ``by``), and its words stand for ``times`` reviews."""
    return T.tokens(distinct_texts(spark, sf, by), "Review", keep=[*by, "times"])


def label_counts(spark, sf) -> DataFrame:
    tok = review_tokens(spark, sf, by=["Label"])
    return T.counted_terms(tok, T.stop_table(spark), by=["Label"], times="times") \
        .filter(F.col("Label").isNotNull())


def overall_counts(spark, sf) -> DataFrame:
    return T.counted_terms(review_tokens(spark, sf), T.stop_table(spark), times="times")


def label_top(spark, sf, k: int = TOP) -> DataFrame:
    top = T.top_terms(label_counts(spark, sf), by=["Label"], k=k)
    return top.withColumn("rank", F.col("rank").cast("int"))


def doc_tags(spark, sf) -> DataFrame:
    return T.tag_tokens(table(spark, sf, DOC), "text", keep=["doc_id"])


# --- SQL building blocks ---------------------------------------------------

_LABEL_TOP_SQL = f"""
, tk AS (SELECT Label, unnest({words_sql('lower(Review)')}) AS token FROM cl),
lc AS (SELECT Label, token, CAST(COUNT(*) AS BIGINT) AS n FROM tk
       WHERE token NOT IN {STOP_SQL} AND Label IS NOT NULL GROUP BY Label, token),
lt AS (SELECT Label, CAST(ROW_NUMBER() OVER (PARTITION BY Label ORDER BY n DESC, token) AS INT)
              AS rank, token, n FROM lc)
"""

_OVERALL_SQL = f"""
, ot AS (SELECT unnest({words_sql('lower(Review)')}) AS token FROM cl),
oc AS (SELECT token, CAST(COUNT(*) AS BIGINT) AS n FROM ot WHERE token NOT IN {STOP_SQL}
       GROUP BY token),
otop AS (SELECT CAST(ROW_NUMBER() OVER (ORDER BY n DESC, token) AS INT) AS rank, token, n
         FROM oc ORDER BY n DESC, token LIMIT {TOP})
"""

_DOC_TOK_SQL = f"""
SELECT doc_id, unnest(generate_series(0, len(t) - 1)) AS pos, unnest(t) AS token
FROM (SELECT doc_id, {words_sql('lower(text)')} AS t FROM documents)
"""

_FAMILY_SQL = f"""
, rt AS (SELECT unnest({words_sql('lower(Review)')}) AS token FROM cl),
fm AS (SELECT {family_sql(tag_sql('token'))} AS family, token FROM rt),
fc AS (SELECT family, token, CAST(COUNT(*) AS BIGINT) AS n FROM fm
       WHERE family IS NOT NULL AND token NOT IN {STOP_SQL} GROUP BY family, token),
ft AS (SELECT family, CAST(ROW_NUMBER() OVER (PARTITION BY family ORDER BY n DESC, token) AS INT)
              AS rank, token, n FROM fc)
"""


# --- registered queries ----------------------------------------------------

@query("str10_lower", "SELECT doc_id, md5(lower(text)) AS lower_md5 FROM documents")
def str10(spark, sf):
    return table(spark, sf, DOC).select("doc_id", F.md5(F.lower("text")).alias("lower_md5"))


@query("str11_words", f"""
SELECT doc_id, CAST(len(t) AS INT) AS n_tokens, md5(array_to_string(t, ' ')) AS tokens_md5
FROM (SELECT doc_id, {words_sql('text')} AS t FROM documents)""")
def str11(spark, sf):
    t = words("text")
    return table(spark, sf, DOC).select(
        "doc_id", F.size(t).cast("int").alias("n_tokens"),
        F.md5(F.array_join(t, " ")).alias("tokens_md5"))


@query("arr1_explode_tokens", _DOC_TOK_SQL)
def arr1(spark, sf):
    return T.tokens(table(spark, sf, DOC), "text", keep=["doc_id"], pos=True) \
        .withColumn("pos", F.col("pos").cast("bigint"))


@query("agg11_term_freq", f"""
SELECT token, CAST(COUNT(*) AS BIGINT) AS n
FROM (SELECT unnest({words_sql('lower(text)')}) AS token FROM documents) GROUP BY token""")
def agg11(spark, sf):
    out = agg.term_freq(T.tokens(table(spark, sf, DOC), "text"))
    return out.withColumn("n", F.col("n").cast("bigint"))


@query("flt6_drop_stopwords", f"""
SELECT token, CAST(COUNT(*) AS BIGINT) AS n
FROM (SELECT unnest({words_sql('lower(text)')}) AS token FROM documents)
WHERE token NOT IN {STOP_SQL} GROUP BY token""")
def flt6(spark, sf):
    tok = T.tokens(table(spark, sf, DOC), "text")
    return T.counted_terms(tok, T.stop_table(spark))


@query("txt7_unigrams", CLEAN_SQL + _LABEL_TOP_SQL + f"SELECT * FROM lt WHERE rank <= {TOP}",
       uses=R)
def txt7(spark, sf):
    return label_top(spark, sf).select("Label", "rank", "token", "n")


@query("srt5_top_terms", CLEAN_SQL + _OVERALL_SQL + "SELECT * FROM otop", uses=R)
def srt5(spark, sf):
    top = T.top_terms(overall_counts(spark, sf), k=TOP)
    return top.select(F.col("rank").cast("int").alias("rank"), "token", "n")


@query("prj5_rename", CLEAN_SQL + _OVERALL_SQL +
       "SELECT rank, token AS Unigram, n AS Count FROM otop", uses=R)
def prj5(spark, sf):
    top = srt5(spark, sf)
    return top.withColumnRenamed("token", "Unigram").withColumnRenamed("n", "Count")


@query("jn7_side_by_side", CLEAN_SQL + _LABEL_TOP_SQL + f"""
SELECT rank, MAX(CASE WHEN Label = 'Positive' THEN token END) AS Positive,
       MAX(CASE WHEN Label = 'Neutral' THEN token END) AS Neutral,
       MAX(CASE WHEN Label = 'Negative' THEN token END) AS Negative
FROM lt WHERE rank <= {SHOWN} GROUP BY rank""", uses=R)
def jn7(spark, sf):
    return joins.side_by_side(label_top(spark, sf), "Label", "rank", "token", LABELS, SHOWN)


@query("srt6_first_rows_of_concat", CLEAN_SQL + _LABEL_TOP_SQL + f"""
, cc AS (SELECT CASE Label WHEN 'Positive' THEN 1 WHEN 'Neutral' THEN 2 ELSE 3 END AS list_no,
                rank, token, n FROM lt WHERE rank <= {TOP})
SELECT list_no, rank, token, n FROM cc ORDER BY list_no, rank LIMIT {SHOWN}""", uses=R)
def srt6(spark, sf):
    """The three top-20 lists stacked in order, first 10 rows (S:538-542)."""
    no = F.when(F.col("Label") == "Positive", 1).when(F.col("Label") == "Neutral", 2).otherwise(3)
    cc = label_top(spark, sf).select(no.alias("list_no"), "rank", "token", "n")
    return cc.orderBy("list_no", "rank").limit(SHOWN)


@query("txt6_term_weights", CLEAN_SQL + _LABEL_TOP_SQL + """
SELECT Label, rank, token, n, ROUND(n / MAX(n) OVER (PARTITION BY Label), 6) AS weight
FROM lt WHERE rank <= 200""", uses=R)
def txt6(spark, sf):
    w = T.term_weights(label_counts(spark, sf), by=["Label"], k=200)
    return w.select("Label", F.col("rank").cast("int").alias("rank"), "token", "n",
                    F.round("weight", 6).alias("weight"))


@query("txt6_overall_term_weights", CLEAN_SQL + _OVERALL_SQL + """
SELECT CAST(rank AS INT) AS rank, token, n, ROUND(n / MAX(n) OVER (), 6) AS weight FROM (
  SELECT ROW_NUMBER() OVER (ORDER BY n DESC, token) AS rank, token, n FROM oc) WHERE rank <= 200""",
       uses=R)
def txt6_overall(spark, sf):
    """Word-cloud weights of all reviews together (S:411)."""
    w = T.term_weights(overall_counts(spark, sf), k=200)
    return w.select(F.col("rank").cast("int").alias("rank"), "token", "n",
                    F.round("weight", 6).alias("weight"))


@query("txt3_describe_terms", CLEAN_SQL + _LABEL_TOP_SQL + f"""
, terms AS (SELECT token, {tag_sql('token')} AS tag FROM lt WHERE Label = 'Neutral'
            AND rank <= {TOP})
SELECT terms.token, terms.tag, tg.description FROM terms LEFT JOIN {TAGS_SQL}
  ON terms.tag = tg.tag""", uses=R)
def txt3(spark, sf):
    terms = label_top(spark, sf).filter(F.col("Label") == "Neutral").select("token")
    return T.describe_terms(terms, T.tag_table(spark)).select("token", "tag", "description")


@query("txt1_tag_tokens", f"SELECT doc_id, pos, token, {tag_sql('token')} AS tag FROM "
       f"({_DOC_TOK_SQL})")
def txt1(spark, sf):
    return doc_tags(spark, sf).select("doc_id", F.col("pos").cast("bigint").alias("pos"),
                                      "token", "tag")


@query("flt9_tag_prefix", f"""
SELECT DISTINCT token, tag FROM (SELECT token, {tag_sql('token')} AS tag FROM ({_DOC_TOK_SQL}))
WHERE starts_with(tag, 'NN')""")
def flt9(spark, sf):
    """Distinct words first, then the (context-free) tag of each word."""
    vocab = agg.term_freq(T.tokens(table(spark, sf, DOC), "text"))
    t = T.with_tag(vocab).select("token", agg.per_group(F.col("tag")).alias("tag"))
    return rel.with_tag_prefix(t, "tag", "NN")


@query("jn6_describe_tag", f"""
SELECT d.token, d.tag, tg.description FROM (
  SELECT DISTINCT token, {tag_sql('token')} AS tag FROM ({_DOC_TOK_SQL})) d
LEFT JOIN {TAGS_SQL} ON d.tag = tg.tag""")
def jn6(spark, sf):
    d = T.with_tag(T.tokens(table(spark, sf, DOC), "text").distinct())
    return joins.describe_tag(d, T.tag_table(spark)).select("token", "tag", "description")


@query("txt2_top_by_tag", CLEAN_SQL + _FAMILY_SQL + f"SELECT * FROM ft WHERE rank <= {TOP}",
       uses=R)
def txt2(spark, sf):
    out = T.top_by_tag(review_tokens(spark, sf), T.stop_table(spark), TOP, times="times")
    return out.select("family", F.col("rank").cast("int").alias("rank"), "token", "n")


@query("txt4_compare_families", CLEAN_SQL + _FAMILY_SQL + f"""
SELECT rank, MAX(CASE WHEN family = 'Noun' THEN token END) AS Noun,
       MAX(CASE WHEN family = 'Verb' THEN token END) AS Verb,
       MAX(CASE WHEN family = 'Adjective' THEN token END) AS Adjective,
       MAX(CASE WHEN family = 'Adverb' THEN token END) AS Adverb
FROM ft WHERE rank <= {SHOWN} GROUP BY rank""", uses=R)
def txt4(spark, sf):
    top = txt2(spark, sf)
    return joins.side_by_side(top, "family", "rank", "token",
                              [n for _, n in T.TAG_FAMILIES], SHOWN)


def polarity_frame(spark, sf) -> DataFrame:
    c = combined(spark, sf).withColumn("review_md5", F.md5("Review"))
    return T.polarity(c, "Review", TEST_VALENCE,
                      keep=["review_md5", "Restaurant", "Location", "Rating", "Label"])


SCORES = ("Compound", "Positive", "Neutral", "Negative")

_POLARITY_SQL = f"""
, pt AS (SELECT md5(Review) AS review_md5, Restaurant, Location, Rating, Label,
                unnest({words_sql('lower(Review)')}) AS token FROM cl),
pv AS (SELECT pt.*, COALESCE(lx.val, 0.0) AS val FROM pt LEFT JOIN {lexicon_sql(TEST_VALENCE)}
         ON pt.token = lx.token),
ps AS (SELECT review_md5, Restaurant, Location, Rating, Label, SUM(val) AS s,
              SUM(CASE WHEN val > 0 THEN val + 1 ELSE 0 END) AS pw,
              SUM(CASE WHEN val < 0 THEN 1 - val ELSE 0 END) AS nw,
              SUM(CASE WHEN val = 0 THEN 1 ELSE 0 END) AS uw
       FROM pv GROUP BY ALL),
pz AS (SELECT c.review_md5, c.Restaurant, c.Location, c.Rating, c.Label,
              COALESCE(ps.s, 0) AS s, COALESCE(ps.pw, 0) AS pw, COALESCE(ps.nw, 0) AS nw,
              COALESCE(ps.uw, 0) AS uw
       FROM (SELECT md5(Review) AS review_md5, Restaurant, Location, Rating, Label FROM cl) c
       LEFT JOIN ps ON c.review_md5 = ps.review_md5 AND c.Restaurant = ps.Restaurant
        AND c.Location IS NOT DISTINCT FROM ps.Location AND c.Rating = ps.Rating),
pol AS (SELECT review_md5, Restaurant, Location, Rating, Label,
               s / sqrt(s * s + 15) AS Compound,
               CASE WHEN pw + nw + uw > 0 THEN pw / (pw + nw + uw) ELSE 0 END AS Positive,
               CASE WHEN pw + nw + uw > 0 THEN uw / (pw + nw + uw) ELSE 0 END AS Neutral,
               CASE WHEN pw + nw + uw > 0 THEN nw / (pw + nw + uw) ELSE 0 END AS Negative
        FROM pz)
"""


@query("txt5_polarity", CLEAN_SQL + _POLARITY_SQL + """
SELECT review_md5, Restaurant, Location, Rating, Label, ROUND(Compound, 6) + 0.0 AS Compound,
       ROUND(Positive, 6) + 0.0 AS Positive, ROUND(Neutral, 6) + 0.0 AS Neutral,
       ROUND(Negative, 6) + 0.0 AS Negative FROM pol""", uses=R)
def txt5(spark, sf):
    p = polarity_frame(spark, sf)
    return p.select("review_md5", "Restaurant", "Location", "Rating", "Label", *[(F.round(c, 6) + 0.0).alias(c) for c in SCORES])


@query("agg9_mean_scores", CLEAN_SQL + _POLARITY_SQL + """
SELECT ROUND(AVG(Compound), 6) + 0.0 AS Compound, ROUND(AVG(Positive), 6) + 0.0 AS Positive,
       ROUND(AVG(Neutral), 6) + 0.0 AS Neutral, ROUND(AVG(Negative), 6) + 0.0 AS Negative FROM pol""",
       uses=R)
def agg9(spark, sf):
    m = agg.mean_scores(polarity_frame(spark, sf), SCORES)
    return m.select(*[(F.round(c, 6) + 0.0).alias(c) for c in SCORES])



def review_report(spark, sf) -> tuple[dict, DataFrame]:
    """The whole review analysis over one cleaned-review table.

    The padded, de-duplicated, labelled reviews are computed once, with their
    word counts, and persisted (spilling to disk; recomputed from lineage if an
    executor is lost); every branch — distributions, top restaurants, length
    bins, correlation, polarity — reads that table and ends in a small
    aggregate.  Terms are counted once per label and stored; unigrams, term
    weights and word families read those counts.  Returns the branch DataFrames
    and the persisted table, which the caller unpersists when done.
    """
    from pyspark import StorageLevel

    from ..functions.numeric import bin_index

    c = with_word_count(combined(spark, sf)).persist(StorageLevel.MEMORY_AND_DISK)
    bins = c.select(bin_index("Word_count", BIN_WIDTH, N_BINS).alias("bin"), "Rating") \
        .filter(F.col("bin").isNotNull()).groupBy("bin").agg(F.avg("Rating").alias("avg_rating"))
    terms = stored(T.counted_terms(T.tokens(c, "Review", keep=["Label"]), T.stop_table(spark), by=["Label"]),
                   "review_terms")
    counts = terms.filter(F.col("Label").isNotNull())
    pol = T.polarity(c, "Review", TEST_VALENCE)
    mean = c.groupBy("Restaurant").agg(F.avg("Rating").alias("Rating"),
                                       F.count(F.lit(1)).cast("bigint").alias("count"))
    report = {
        "location_counts": agg.value_counts(c, "Location"),
        "rating_counts": agg.value_counts(c, "Rating"),
        "average_rating": agg.mean_rounded(c, "Rating", 2),
        "location_mean": agg.group_mean(c, "Location", "Rating"),
        "label_share": agg.class_share(c, "Label"),
        "top_restaurants": rel.top_k(mean, "count", 10, tiebreak=["Restaurant"]),
        "length_bins": bins_table(spark).join(bins, "bin", "left"),
        "length_rating_corr": agg.corr_matrix(
            c.select(F.col("Word_count").cast("double").alias("Word_count"),
                      F.col("Rating").cast("double").alias("Rating")), ["Word_count", "Rating"]),
        "unigrams": T.top_terms(counts, by=["Label"], k=TOP),
        "term_weights": T.term_weights(counts, by=["Label"], k=200),
        "families": T.top_of_counts(terms.groupBy("token").agg(F.sum("n").alias("n")), TOP),
        "polarity_means": agg.mean_scores(pol, SCORES),
    }
    return report, c


@query("p3_review_report", CLEAN_SQL + _LABEL_TOP_SQL + _FAMILY_SQL + _POLARITY_SQL + f"""
, top AS (SELECT Restaurant, COUNT(*) AS n FROM cl WHERE Restaurant IS NOT NULL GROUP BY Restaurant
          ORDER BY n DESC, Restaurant LIMIT 10),
wc AS (SELECT Rating, len({tokens_sql('Review')}) AS Word_count FROM cl),
lb AS (SELECT CAST(floor(Word_count / {BIN_WIDTH}) AS INT) AS bin, AVG(Rating) AS avg_rating FROM wc
       WHERE Word_count < {BIN_WIDTH * N_BINS} GROUP BY 1),
ln AS (SELECT CAST(i AS INT) AS bin, concat(CAST(CASE WHEN i = 0 THEN 0 ELSE i * {BIN_WIDTH} + 1 END
              AS VARCHAR), '-', CAST((i + 1) * {BIN_WIDTH} AS VARCHAR)) AS label FROM range({N_BINS}) t(i)),
lr AS (SELECT corr(CAST(Word_count AS DOUBLE), CAST(Rating AS DOUBLE)) AS r FROM wc)
SELECT 'location_counts' AS part, Location AS key, CAST(COUNT(*) AS DOUBLE) AS value FROM cl
WHERE Location IS NOT NULL GROUP BY Location
UNION ALL SELECT 'location_mean', Location, ROUND(AVG(Rating), 6) FROM cl
WHERE Location IS NOT NULL GROUP BY Location
UNION ALL SELECT 'average_rating', 'all', round_even(AVG(Rating), 2) FROM cl
UNION ALL SELECT 'label_share', Label, ROUND(p, 6) FROM (
  SELECT Label, COUNT(*) / SUM(COUNT(*)) OVER () * 100 AS p FROM cl GROUP BY Label)
WHERE Label IS NOT NULL
UNION ALL SELECT 'top_restaurants', Restaurant, CAST(n AS DOUBLE) FROM top
UNION ALL SELECT 'rating_counts', CAST(Rating AS VARCHAR), CAST(COUNT(*) AS DOUBLE) FROM cl
WHERE Rating IS NOT NULL GROUP BY Rating
UNION ALL SELECT 'length_bins', ln.label, ROUND(lb.avg_rating, 6) FROM ln LEFT JOIN lb ON ln.bin = lb.bin
UNION ALL SELECT 'length_rating_corr', 'Word_count:Word_count', 1.0
UNION ALL SELECT 'length_rating_corr', 'Word_count:Rating', ROUND(r, 6) FROM lr
UNION ALL SELECT 'length_rating_corr', 'Rating:Word_count', ROUND(r, 6) FROM lr
UNION ALL SELECT 'length_rating_corr', 'Rating:Rating', 1.0
UNION ALL SELECT 'term_weights', concat(Label, ':', token), ROUND(n / MAX(n) OVER (PARTITION BY Label), 6)
FROM lt WHERE rank <= 200
UNION ALL SELECT 'unigrams', concat(Label, ':', token), CAST(n AS DOUBLE) FROM lt WHERE rank <= {TOP}
UNION ALL SELECT 'families', concat(family, ':', token), CAST(n AS DOUBLE) FROM ft WHERE rank <= {TOP}
UNION ALL SELECT 'polarity_means', 'Compound', ROUND(AVG(Compound), 6) + 0.0 FROM pol
UNION ALL SELECT 'polarity_means', 'Positive', ROUND(AVG(Positive), 6) + 0.0 FROM pol
UNION ALL SELECT 'polarity_means', 'Neutral', ROUND(AVG(Neutral), 6) + 0.0 FROM pol
UNION ALL SELECT 'polarity_means', 'Negative', ROUND(AVG(Negative), 6) + 0.0 FROM pol""", uses=R)
def p3(spark, sf):
    """The review analysis as one table (part, key, value), every branch read
    from one stored table of cleaned reviews."""
    parts, cleaned = review_report(spark, sf)

    def rows(name, key, value):
        return parts[name].select(F.lit(name).alias("part"), key.cast("string").alias("key"),
                                  value.cast("double").alias("value"))
    means = parts["polarity_means"].selectExpr(
        "stack(4, " + ", ".join(f"'{c}', `{c}`" for c in SCORES) + ") AS (key, value)")
    parts["polarity_means"] = means
    out = [rows("location_counts", F.col("Location"), F.col("count")),
           rows("location_mean", F.col("Location"), F.round("Rating", 6)),
           rows("average_rating", F.lit("all"), F.col("avg")),
           rows("label_share", F.col("Label"), F.round("Percentage", 6)),
           rows("top_restaurants", F.col("Restaurant"), F.col("count")),
           rows("rating_counts", F.col("Rating"), F.col("count")),
           rows("length_bins", F.col("label"), F.round("avg_rating", 6)),
           rows("length_rating_corr", F.concat_ws(":", "col_a", "col_b"), F.round("r", 6)),
           rows("term_weights", F.concat_ws(":", "Label", "token"), F.round("weight", 6)),
           rows("unigrams", F.concat_ws(":", "Label", "token"), F.col("n")),
           rows("families", F.concat_ws(":", "family", "token"), F.col("n")),
           rows("polarity_means", F.col("key"), F.round("value", 6) + F.lit(0.0))]
    report = stored(reduce(DataFrame.unionByName, out), "review_report")
    cleaned.unpersist()
    return report
