"""P3 with context: polarity that reads the words before a word (TXT5), and
two-word terms (TXT6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import collocations as C
from ..operators import text as T
from ..operators import valence as V
from .catalog import query, table
from .review_text import SCORES, STOP_SQL, TEST_VALENCE, lexicon_sql, sql_in, words_sql

DOC = "documents"

# The corpus is invented prose, so frequent tokens of it play the parts.
RULES = V.Rules(TEST_VALENCE | {"the": 0.7, "de": -0.5, "der": 1.1}, negation=("and", "la", "not", "die"),
                degree={"of": 0.3, "to": -0.2, "que": 0.4, "en": -0.9}, turn="is")


def _context_sql(r: V.Rules) -> str:
    degree = " ".join(f"WHEN '{w}' THEN CAST({d} AS DOUBLE)" for w, d in r.degree.items())
    size = "".join(f" + coalesce(lag(degree, {i}) OVER p, 0) * {share}"
                   for i, share in enumerate(r.distance, 1))
    turned = " OR ".join(f"coalesce(lag(neg, {i}) OVER p, FALSE)" for i in range(1, V.LOOKBACK + 1))
    return f"""
WITH t AS (SELECT doc_id, text, {words_sql('text')} AS w FROM documents),
e AS (SELECT doc_id, unnest(w) AS said, generate_subscripts(w, 1) AS i FROM t),
l AS (SELECT *, lower(said) AS word FROM e),
x AS (SELECT l.*, coalesce(lx.val, 0.0) AS val, CASE word {degree} ELSE 0.0 END AS degree,
             word IN {sql_in(r.negation)} AS neg,
             bool_or(said = word AND upper(word) <> word) OVER (PARTITION BY doc_id) AS mixed,
             min(CASE WHEN word = '{r.turn}' THEN i END) OVER (PARTITION BY doc_id) AS turn
      FROM l LEFT JOIN {lexicon_sql(r.valence)} ON l.word = lx.token),
y AS (SELECT *, greatest(abs(val) + CASE WHEN mixed AND length(said) > 1 AND upper(said) = said
                                          AND lower(said) <> said THEN {r.capitals} ELSE 0 END {size}, 0) AS size,
             ({turned}) AS turned
      FROM x WINDOW p AS (PARTITION BY doc_id ORDER BY i)),
z AS (SELECT doc_id, CASE WHEN val = 0 THEN 0 ELSE sign(val) * size * CASE WHEN turned THEN {r.negated} ELSE 1 END
               * CASE WHEN i < turn THEN {r.before_turn} WHEN i > turn THEN {r.after_turn} ELSE 1 END END AS v
      FROM y),
g AS (SELECT doc_id, SUM(v) AS s, SUM(CASE WHEN v > 0 THEN v + 1 ELSE 0 END) AS up,
             SUM(CASE WHEN v < 0 THEN 1 - v ELSE 0 END) AS down, SUM(CASE WHEN v = 0 THEN 1 ELSE 0 END) AS flat
      FROM z GROUP BY doc_id),
h AS (SELECT t.doc_id, coalesce(up, 0) AS up, coalesce(down, 0) AS down, coalesce(flat, 0) AS flat,
             coalesce(s, 0) + sign(coalesce(s, 0))
               * least(coalesce(length(text) - length(replace(text, '!', '')), 0), {r.marks}) * {r.mark} AS s
      FROM t LEFT JOIN g ON t.doc_id = g.doc_id)
SELECT doc_id, ROUND(s / sqrt(s * s + {r.alpha}), 6) + 0.0 AS Compound,
       ROUND(CASE WHEN up + down + flat > 0 THEN up / (up + down + flat) ELSE 0 END, 6) + 0.0 AS Positive,
       ROUND(CASE WHEN up + down + flat > 0 THEN flat / (up + down + flat) ELSE 0 END, 6) + 0.0 AS Neutral,
       ROUND(CASE WHEN up + down + flat > 0 THEN down / (up + down + flat) ELSE 0 END, 6) + 0.0 AS Negative
FROM h"""


@query("txt5_polarity_in_context", _context_sql(RULES))
def txt5_context(spark, sf):
    p = V.polarity_in_context(table(spark, sf, DOC), "text", RULES, keep=["doc_id"])
    return p.select("doc_id", *[(F.round(c, 6) + 0.0).alias(c) for c in SCORES])


_PAIRS_SQL = f"""
WITH t AS (SELECT doc_id, {words_sql('lower(text)')} AS w FROM documents),
e AS (SELECT doc_id, unnest(w) AS a, generate_subscripts(w, 1) AS i FROM t),
s AS (SELECT a AS token, COUNT(*) AS n FROM e WHERE a NOT IN {STOP_SQL} GROUP BY 1),
p AS (SELECT x.a, y.a AS b, COUNT(*) AS n FROM e x JOIN e y ON x.doc_id = y.doc_id AND y.i = x.i + 1
      WHERE x.a NOT IN {STOP_SQL} AND y.a NOT IN {STOP_SQL} GROUP BY 1, 2),
m AS (SELECT *, CAST(SUM(n) OVER (PARTITION BY a) AS DOUBLE) AS l,
             CAST(SUM(n) OVER (PARTITION BY b) AS DOUBLE) AS r, CAST(SUM(n) OVER () AS DOUBLE) AS t FROM p),
g AS (SELECT a, b, n, l, r, t, 2 * (n * ln(n * t / (l * r))
        + CASE WHEN l > n THEN (l - n) * ln((l - n) * t / (l * (t - r))) ELSE 0 END
        + CASE WHEN r > n THEN (r - n) * ln((r - n) * t / ((t - l) * r)) ELSE 0 END
        + CASE WHEN t - l - r + n > 0 THEN (t - l - r + n) * ln((t - l - r + n) * t / ((t - l) * (t - r)))
               ELSE 0 END) AS ratio FROM m),
f AS (SELECT a, b, CAST(n AS BIGINT) AS n, ratio FROM g
      WHERE n >= 2 AND ratio >= {C.THRESHOLD} AND n * t > l * r)
"""


@query("txt6_two_word_terms", _PAIRS_SQL + "SELECT a, b, n, ROUND(ratio, 3) AS ratio FROM f")
def txt6_pairs(spark, sf):
    found = C.collocations(C.pair_counts(table(spark, sf, DOC), "text", T.stop_table(spark)))
    return found.select("a", "b", "n", F.round("ratio", 3).alias("ratio"))


@query("txt6_cloud_weights", _PAIRS_SQL + """
, i AS (SELECT token, SUM(n) AS n FROM (SELECT a AS token, n FROM f UNION ALL SELECT b, n FROM f) GROUP BY 1),
c AS (SELECT s.token, CAST(s.n - coalesce(i.n, 0) AS BIGINT) AS n FROM s LEFT JOIN i ON s.token = i.token
      UNION ALL SELECT a || ' ' || b, n FROM f),
k AS (SELECT CAST(row_number() OVER (ORDER BY n DESC, token) AS INT) AS rank, token, n FROM c WHERE n > 0)
SELECT rank, token, n, ROUND(n / MAX(n) OVER (), 6) AS weight FROM k WHERE rank <= 200""")
def txt6_cloud(spark, sf):
    docs, stop = table(spark, sf, DOC), T.stop_table(spark)
    singles = T.counted_terms(T.tokens(docs, "text"), stop)
    w = C.cloud_weights(singles, C.pair_counts(docs, "text", stop))
    return w.select(F.col("rank").cast("int").alias("rank"), "token", "n", F.round("weight", 6).alias("weight"))
