"""P3 review analytics up to the timeline: cleaning, union, labels,
distributions, top restaurants, review length and monthly counts
(STR6-9, STR12, NUM1-2, NUM6-7, FLT4, FLT7-8, SET1-2, PRF5-6, AGG5-8,
AGG10, AGG12, JN4, SRT4, DT3, DT5)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import strings as S
from ..functions.dates import month_end, review_date
from ..functions.numeric import bin_index, bin_label, sentiment_label, to_int_trunc, to_number
from ..operators import aggregates as agg
from ..operators import joins, profile, relational as rel
from .catalog import query, table

A, B = "reviews_a", "reviews_b"
AS_OF = "2024-12-01"

# The cities looked for in the location text, in list order,
# and the word-count bins (width 200, ten bins).
CITY_NAMES = ("Ipoh", "Johor Bahru", "Kuala Lumpur", "Kuching", "Langkawi", "Melaka", "Miri",
              "Penang", "Petaling Jaya", "Shah Alam")
BIN_WIDTH, N_BINS = 200, 10
PAD_WIDTH = 200


def parsed(df: DataFrame) -> DataFrame:
    """Rating text → int: first decimal number, truncated (STR6, NUM1)."""
    return df.withColumn("Rating", to_int_trunc(S.rating_value("Rating")))


def cleaned_source(df: DataFrame, drop) -> DataFrame:
    """One review export after S:86-125: drop columns, parse the rating,
    drop incomplete rows, reduce the location to a city name."""
    df = rel.drop_incomplete(parsed(rel.drop_columns(df, *drop)))
    return df.withColumn("Location", S.first_contained("Location", CITY_NAMES))


def united(spark, sf) -> DataFrame:
    """Both exports, united by name (S:139)."""
    trip = cleaned_source(table(spark, sf, B), ["url", "Dates"])
    google = cleaned_source(table(spark, sf, A), ["url"])
    return rel.union_by_name(trip, google)


def combined(spark, sf) -> DataFrame:
    """Padded, de-duplicated, labelled reviews (S:145-175).  Padding comes
    before de-duplication, as in the analysis."""
    u = united(spark, sf).withColumn("Review", S.pad_min("Review", PAD_WIDTH))
    d = rel.drop_duplicates(u)
    return d.withColumn("Label", sentiment_label("Rating"))


def reviewed(spark, sf) -> DataFrame:
    """The rows of ``combined`` without their texts: a row is known by the
    SHA-256 of its padded text, and what later steps need of the text (its MD5
    and word count) is computed before the shuffle.  Texts never travel."""
    u = united(spark, sf).withColumn("Review", S.pad_min("Review", PAD_WIDTH))
    rows = u.select("Restaurant", "Location", "Rating", F.sha2("Review", 256).alias("digest"),
                    F.md5("Review").alias("review_md5"), S.word_count("Review").alias("Word_count"))
    d = rows.dropDuplicates(["Restaurant", "Location", "Rating", "digest"])
    return d.withColumn("Label", sentiment_label("Rating"))


def distinct_texts(spark, sf, by=()) -> DataFrame:
    """(by..., Review, times): the padded texts of ``combined``, each once per
    ``by``, and the number of its rows.  Rows are counted without their texts
    (``reviewed``); equal texts are met in the tasks before they shuffle, so
    many copies of one text do not gather."""
    u = united(spark, sf).select(S.pad_min("Review", PAD_WIDTH).alias("Review"))
    texts = u.groupBy(F.sha2("Review", 256).alias("digest")).agg(F.any_value("Review").alias("Review"))
    times = reviewed(spark, sf).groupBy("digest", *by).agg(F.count(F.lit(1)).alias("times"))
    return texts.join(times, "digest").select(*by, "Review", "times")


def with_word_count(df: DataFrame) -> DataFrame:
    return df.withColumn("Word_count", S.word_count("Review"))


# --- SQL mirrors of the cleaning steps ------------------------------------

def _city_sql(col: str) -> str:
    return "COALESCE(" + ", ".join(
        f"CASE WHEN contains({col}, '{c}') THEN '{c}' END" for c in CITY_NAMES) + ")"


_RATING = ("TRY_CAST(trunc(TRY_CAST(nullif(regexp_extract(Rating, '(\\d+\\.\\d+)', 1), '') "
           "AS DOUBLE)) AS INT)")

CLEAN_SQL = f"""
, ga AS (SELECT Restaurant, Location, {_RATING} AS Rating, Review FROM reviews_a),
ta AS (SELECT Restaurant, Location, {_RATING} AS Rating, Review FROM reviews_b),
gc AS (SELECT Restaurant, {_city_sql('Location')} AS Location, Rating, Review FROM ga
       WHERE Restaurant IS NOT NULL AND Location IS NOT NULL AND Rating IS NOT NULL
         AND Review IS NOT NULL),
tc AS (SELECT Restaurant, {_city_sql('Location')} AS Location, Rating, Review FROM ta
       WHERE Restaurant IS NOT NULL AND Location IS NOT NULL AND Rating IS NOT NULL
         AND Review IS NOT NULL),
un AS (SELECT * FROM tc UNION ALL SELECT * FROM gc),
cr AS (SELECT DISTINCT Restaurant, Location, Rating,
              CASE WHEN length(Review) < {PAD_WIDTH} THEN rpad(Review, {PAD_WIDTH}, ' ')
                   ELSE Review END AS Review FROM un),
cl AS (SELECT *, CASE WHEN Rating > 3 THEN 'Positive' WHEN Rating < 3 THEN 'Negative'
                      WHEN Rating = 3 THEN 'Neutral' END AS Label FROM cr)
"""
R = [A, B]

_TOKENS_SQL = "regexp_extract_all({c}, '[\\p{{L}}\\p{{N}}_]+')"


def tokens_sql(col: str) -> str:
    return _TOKENS_SQL.format(c=col)


@query("set1_union_by_name", CLEAN_SQL + "SELECT Restaurant, Location, Rating, md5(Review) AS "
       "review_md5 FROM un", uses=R)
def set1(spark, sf):
    return united(spark, sf).select("Restaurant", "Location", "Rating",
                                    F.md5("Review").alias("review_md5"))


@query("str6_rating_value", """
SELECT url, nullif(regexp_extract(Rating, '(\\d+\\.\\d+)', 1), '') AS rating_text FROM reviews_b
""", uses=[B])
def str6(spark, sf):
    return table(spark, sf, B).select("url", S.rating_value("Rating").alias("rating_text"))


@query("num1_to_int_trunc", f"SELECT url, {_RATING} AS Rating FROM reviews_a", uses=[A])
def num1(spark, sf):
    return parsed(table(spark, sf, A)).select("url", "Rating")


@query("num2_to_number", """
SELECT url, TRY_CAST(nullif(regexp_extract(Rating, '(\\d+\\.\\d+)', 1), '') AS DOUBLE) AS rating
FROM reviews_b""", uses=[B])
def num2(spark, sf):
    return table(spark, sf, B).select("url", to_number(S.rating_value("Rating")).alias("rating"))


@query("flt7_drop_incomplete", f"""
SELECT url, Rating FROM (SELECT url, Restaurant, Location, {_RATING} AS Rating, Review FROM reviews_a)
WHERE url IS NOT NULL AND Restaurant IS NOT NULL AND Location IS NOT NULL AND Rating IS NOT NULL
  AND Review IS NOT NULL""", uses=[A])
def flt7(spark, sf):
    return rel.drop_incomplete(parsed(table(spark, sf, A))).select("url", "Rating")


@query("flt8_drop_subset", f"""
SELECT url, {_city_sql('Location')} AS Location FROM reviews_b WHERE Location IS NOT NULL""",
       uses=[B])
def flt8(spark, sf):
    """S:330-331: rows without a location dropped, the rest reduced to a city."""
    d = rel.drop_incomplete(table(spark, sf, B), subset=["Location"])
    return d.select("url", S.first_contained("Location", CITY_NAMES).alias("Location"))


@query("str7_first_contained", f"SELECT url, {_city_sql('Location')} AS city FROM reviews_a",
       uses=[A])
def str7(spark, sf):
    return table(spark, sf, A).select("url", S.first_contained("Location", CITY_NAMES).alias("city"))


@query("str8_pad_min", f"""
SELECT url, CAST(length(p) AS INT) AS padded_len, md5(p) AS padded_md5 FROM (
  SELECT url, CASE WHEN length(Review) < {PAD_WIDTH} THEN rpad(Review, {PAD_WIDTH}, ' ')
                   ELSE Review END AS p FROM reviews_a)""", uses=[A])
def str8(spark, sf):
    p = S.pad_min("Review", PAD_WIDTH)
    return table(spark, sf, A).select("url", F.length(p).cast("int").alias("padded_len"),
                                      F.md5(p).alias("padded_md5"))


@query("set2_drop_duplicates", CLEAN_SQL +
       "SELECT Restaurant, Location, Rating, md5(Review) AS review_md5 FROM cr", uses=R)
def set2(spark, sf):
    return reviewed(spark, sf).select("Restaurant", "Location", "Rating", "review_md5")


@query("prf5_row_count", CLEAN_SQL + "SELECT CAST(COUNT(*) AS BIGINT) AS n FROM un", uses=R)
def prf5(spark, sf):
    return profile.row_count(united(spark, sf))


@query("prf6_distinct_count", CLEAN_SQL + """
SELECT CAST(COUNT(DISTINCT Restaurant) + MAX(CASE WHEN Restaurant IS NULL THEN 1 ELSE 0 END)
            AS BIGINT) AS n_distinct FROM un""", uses=R)
def prf6(spark, sf):
    return profile.distinct_count(united(spark, sf), "Restaurant")


@query("num7_sentiment_label", CLEAN_SQL +
       "SELECT Restaurant, Location, Rating, Label, md5(Review) AS review_md5 FROM cl", uses=R)
def num7(spark, sf):
    return reviewed(spark, sf).select("Restaurant", "Location", "Rating", "Label", "review_md5")


@query("flt4_split_by_sentiment", CLEAN_SQL + """
SELECT Label, CAST(COUNT(*) AS BIGINT) AS n FROM cl WHERE Label IS NOT NULL GROUP BY Label""",
       uses=R)
def flt4(spark, sf):
    """The three rating filters of S:375-377 as one pass grouped by label."""
    c = reviewed(spark, sf).filter(F.col("Label").isNotNull())
    return c.groupBy("Label").agg(F.count(F.lit(1)).cast("bigint").alias("n"))


@query("agg5_value_counts", CLEAN_SQL + """
SELECT Location, CAST(COUNT(*) AS BIGINT) AS count FROM cl WHERE Location IS NOT NULL
GROUP BY Location""", uses=R)
def agg5(spark, sf):
    out = agg.value_counts(reviewed(spark, sf), "Location")
    return out.withColumn("count", F.col("count").cast("bigint"))


@query("agg6_class_share", CLEAN_SQL + """
SELECT Label, Percentage FROM (
  SELECT Label, COUNT(*) / SUM(COUNT(*)) OVER () * 100 AS Percentage FROM cl GROUP BY Label)
WHERE Label IS NOT NULL""", uses=R)
def agg6(spark, sf):
    return agg.class_share(reviewed(spark, sf), "Label")


@query("agg7_mean_rounded", CLEAN_SQL + "SELECT round_even(AVG(Rating), 2) AS avg FROM cl", uses=R)
def agg7(spark, sf):
    return agg.mean_rounded(reviewed(spark, sf), "Rating", 2)


@query("agg8_group_mean", CLEAN_SQL + """
SELECT Location, AVG(Rating) AS Rating FROM cl WHERE Location IS NOT NULL GROUP BY Location""",
       uses=R)
def agg8(spark, sf):
    return agg.group_mean(reviewed(spark, sf), "Location", "Rating")


def restaurant_table(spark, sf) -> DataFrame:
    """Mean rating and review count per restaurant (S:235-247).  The two
    aggregates of the analysis merged on the key (JN4)."""
    c = reviewed(spark, sf)
    mean = c.groupBy("Restaurant").agg(F.avg("Rating").alias("Rating"))
    count = agg.value_counts(c, "Restaurant").withColumn("count", F.col("count").cast("bigint"))
    return joins.merge_on(mean, count, "Restaurant")


_REST_SQL = """
, rm AS (SELECT Restaurant, AVG(Rating) AS Rating FROM cl GROUP BY Restaurant),
rc AS (SELECT Restaurant, CAST(COUNT(*) AS BIGINT) AS count FROM cl WHERE Restaurant IS NOT NULL
       GROUP BY Restaurant),
rt AS (SELECT rm.Restaurant, rm.Rating, rc.count FROM rm JOIN rc ON rm.Restaurant = rc.Restaurant)
"""


@query("jn4_merge_on", CLEAN_SQL + _REST_SQL + "SELECT * FROM rt", uses=R)
def jn4(spark, sf):
    return restaurant_table(spark, sf)


@query("srt4_top_k", CLEAN_SQL + _REST_SQL + """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY count DESC, Restaurant) AS INT) AS rank, Restaurant,
       Rating, count
FROM rt ORDER BY count DESC, Restaurant LIMIT 10""", uses=R)
def srt4(spark, sf):
    """Top 10 restaurants by review count (what the analysis computes,
    though it calls it by rating, Q15)."""
    rated = (reviewed(spark, sf).filter(F.col("Restaurant").isNotNull()).groupBy("Restaurant")
             .agg(F.avg("Rating").alias("Rating"), F.count(F.lit(1)).cast("bigint").alias("count")))
    top = rel.top_k(rated, "count", 10, tiebreak=["Restaurant"])
    return rel.with_rank(top, [F.col("count").desc(), F.col("Restaurant")]) \
        .withColumn("rank", F.col("rank").cast("int"))


@query("str12_word_count", CLEAN_SQL + f"""
SELECT Restaurant, Location, Rating, md5(Review) AS review_md5,
       CAST(len({tokens_sql('Review')}) AS INT) AS Word_count FROM cl""", uses=R)
def str12(spark, sf):
    return reviewed(spark, sf).select(
        "Restaurant", "Location", "Rating", "review_md5",
        F.col("Word_count").cast("int").alias("Word_count"))


def bins_table(spark) -> DataFrame:
    rows = [(i,) for i in range(N_BINS)]
    b = joins.fixed_table(spark, rows, "bin int")
    return b.withColumn("label", bin_label("bin", BIN_WIDTH))


@query("num6_bin_200", CLEAN_SQL + f"""
, wc AS (SELECT Rating, len({tokens_sql('Review')}) AS Word_count FROM cl),
b AS (SELECT CAST(CASE WHEN Word_count >= 0 AND Word_count < {BIN_WIDTH * N_BINS}
                      THEN floor(Word_count / {BIN_WIDTH}) END AS INT) AS bin, Rating FROM wc),
g AS (SELECT bin, AVG(Rating) AS avg_rating, CAST(COUNT(*) AS BIGINT) AS n FROM b
      WHERE bin IS NOT NULL GROUP BY bin),
bin_labels AS (SELECT CAST(i AS INT) AS bin,
                  concat(CAST(CASE WHEN i = 0 THEN 0 ELSE i * {BIN_WIDTH} + 1 END AS VARCHAR), '-',
                         CAST((i + 1) * {BIN_WIDTH} AS VARCHAR)) AS label
           FROM range({N_BINS}) t(i))
SELECT bin_labels.bin, bin_labels.label, g.avg_rating, COALESCE(g.n, 0) AS n
FROM bin_labels LEFT JOIN g ON bin_labels.bin = g.bin""", uses=R)
def num6(spark, sf):
    """Mean rating per 200-word bin; all ten bins listed, empty ones null (S:274-279).

    Rows are first reduced per word count (the count is computed once per
    review); bins are derived per distinct word count."""
    per_wc = reviewed(spark, sf).groupBy("Word_count").agg(
        F.sum("Rating").alias("_s"), F.count("Rating").alias("_c"),
        F.count(F.lit(1)).alias("_rows"))
    binned = per_wc.select(agg.per_group(bin_index("Word_count", BIN_WIDTH, N_BINS), "_rows")
                           .alias("bin"), "_s", "_c", "_rows")
    g = binned.filter(F.col("bin").isNotNull()).groupBy("bin").agg(
        (F.sum("_s") / F.sum("_c")).alias("avg_rating"), F.sum("_rows").cast("bigint").alias("n"))
    out = bins_table(spark).join(g, "bin", "left")
    return out.select("bin", "label", "avg_rating", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


@query("agg10_corr_matrix", CLEAN_SQL + f"""
, wc AS (SELECT CAST(len({tokens_sql('Review')}) AS DOUBLE) AS Word_count,
                CAST(Rating AS DOUBLE) AS Rating FROM cl),
r AS (SELECT corr(Word_count, Rating) AS c FROM wc)
SELECT col_a, col_b, ROUND(r, 6) AS r FROM (
  SELECT 'Word_count' AS col_a, 'Word_count' AS col_b, 1.0::DOUBLE AS r
  UNION ALL SELECT 'Word_count', 'Rating', c FROM r
  UNION ALL SELECT 'Rating', 'Word_count', c FROM r
  UNION ALL SELECT 'Rating', 'Rating', 1.0::DOUBLE)""", uses=R)
def agg10(spark, sf):
    c = reviewed(spark, sf).select(
        F.col("Word_count").cast("double").alias("Word_count"),
        F.col("Rating").cast("double").alias("Rating"))
    m = agg.corr_matrix(c, ["Word_count", "Rating"])
    return m.withColumn("r", F.round("r", 6))


def dated(spark, sf) -> DataFrame:
    """Second export with a review date (S:317-352); relative texts are
    counted back from the fixed as-of date."""
    t = rel.drop_incomplete(table(spark, sf, B), subset=["Location"])
    t = t.withColumn("Location", S.first_contained("Location", CITY_NAMES))
    t = t.withColumn("DateText", S.strip_prefix("Dates"))
    return t.withColumn("Date", review_date("DateText", AS_OF))


_DATED_SQL = f"""
, st AS (SELECT url, Review, trim(regexp_replace(Dates, 'Reviewed\\s', '', 'g')) AS DateText
         FROM reviews_b WHERE Location IS NOT NULL),
dd AS (SELECT url, Review, DateText,
         CASE WHEN regexp_matches(DateText, '\\bweeks?\\b')
                THEN DATE '{AS_OF}' - 7 * TRY_CAST(regexp_extract(DateText, '\\d+', 0) AS INT)
              WHEN regexp_matches(DateText, '\\bdays?\\b')
                THEN DATE '{AS_OF}' - TRY_CAST(regexp_extract(DateText, '\\d+', 0) AS INT)
              WHEN DateText = 'yesterday' THEN DATE '{AS_OF}' - 1
              WHEN DateText = 'today' THEN DATE '{AS_OF}'
              ELSE CAST(try_strptime(DateText, '%-d %B %Y') AS DATE) END AS Date
       FROM st)
"""


@query("str9_strip_prefix", _DATED_SQL + "SELECT url, DateText FROM dd",
       uses=[B])
def str9(spark, sf):
    return dated(spark, sf).select("url", "DateText")


@query("dt3_review_date", _DATED_SQL + "SELECT url, Date FROM dd",
       uses=[B])
def dt3(spark, sf):
    return dated(spark, sf).select("url", "Date")


@query("agg12_monthly_counts", _DATED_SQL + """
, m AS (SELECT last_day(Date) AS month_end, COUNT(Review) AS n FROM dd WHERE Date IS NOT NULL
        GROUP BY 1),
cal AS (SELECT last_day(CAST(g AS DATE)) AS month_end FROM (
          SELECT unnest(generate_series(CAST(date_trunc('month', MIN(Date)) AS TIMESTAMP),
                                        CAST(MAX(Date) AS TIMESTAMP), INTERVAL 1 MONTH)) AS g
          FROM dd))
SELECT cal.month_end, CAST(COALESCE(m.n, 0) AS BIGINT) AS n FROM cal LEFT JOIN m
  ON cal.month_end = m.month_end""", uses=[B])
def agg12(spark, sf):
    return agg.monthly_counts(dated(spark, sf), "Date", "Review")


@query("dt5_month_end", "SELECT o_orderkey, last_day(CAST(o_orderdate AS DATE)) AS month_end "
       "FROM orders")
def dt5(spark, sf):
    o = table(spark, sf, "orders")
    return o.select("o_orderkey", month_end(F.to_date("o_orderdate")).alias("month_end"))
