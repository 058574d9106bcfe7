"""P3 with word tags in context (TXT1, TXT2): the hidden Markov tagger over
the documents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import tagger as G
from ..operators import text as T
from ..operators.aggregates import per_group
from .catalog import query, table
from .review_text import STOP_SQL, TOP, _q, family_sql

DOC = "documents"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_q(x) if isinstance(x, str) else str(int(x)) for x in r) + ")"
                     for r in rows)


def _symbol_sql(tok: str) -> str:
    number = {s: i for i, s in enumerate(G.default_tagger().symbols)}
    words = " ".join(f"WHEN {_q(w)} THEN {number[w]}" for w in G.FUNCTION_WORDS)
    suffixes = " ".join(f"WHEN ends_with({tok}, {_q(s)}) AND length({tok}) > {len(s) + 1} "
                        f"THEN {number['-' + s]}" for s, _ in G.SUFFIXES)
    return (f"COALESCE(CASE {tok} {words} END, CASE WHEN {tok} IN ('.', '!', '?', chr(10)) THEN 0 "
            f"WHEN regexp_full_match({tok}, '[0-9]+') THEN {number[G.DIGITS]} {suffixes} "
            f"ELSE {number[G.OPEN]} END)")


def _viterbi_sql() -> str:
    """Cheapest tags by recursion over the places of a sentence: ``tagged``
    (doc_id, p, token, m, tag)."""
    model = G.default_tagger()
    step, show = model.costs()
    allowed = _values((m, j, show[m, j]) for m, tags in enumerate(model.symbols.values())
                      for j in tags)
    steps = _values((i, j, step[i, j]) for i in range(len(G.TAGS)) for j in range(len(G.TAGS)))
    return f"""
WITH RECURSIVE al(m, tag, cost) AS (VALUES {allowed}),
st(a, b, cost) AS (VALUES {steps}),
names(tag, name) AS (VALUES {_values(enumerate(G.TAGS))}),
tk AS (SELECT doc_id, unnest(generate_series(0, len(t) - 1)) AS p, unnest(t) AS token
       FROM (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+|[.!?\\n]') AS t
             FROM documents)),
sy AS (SELECT *, {_symbol_sql('token')} AS m FROM tk),
se AS (SELECT *, coalesce(sum(CASE WHEN m = 0 THEN 1 ELSE 0 END) OVER (
         PARTITION BY doc_id ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s
       FROM sy),
ix AS (SELECT *, row_number() OVER (PARTITION BY doc_id, s ORDER BY p) - 1 AS i FROM se),
v(doc_id, s, i, tag, score, prev) AS (
  SELECT doc_id, s, i, al.tag, CAST(st.cost + al.cost AS BIGINT), 0
  FROM ix JOIN al ON al.m = ix.m JOIN st ON st.a = 0 AND st.b = al.tag WHERE i = 0
  UNION ALL
  SELECT ix.doc_id, ix.s, ix.i, al.tag,
         CAST(min((v.score + st.cost) * 64 + v.tag) // 64 + min(al.cost) AS BIGINT),
         CAST(min((v.score + st.cost) * 64 + v.tag) % 64 AS INT)
  FROM v JOIN ix ON ix.doc_id = v.doc_id AND ix.s = v.s AND ix.i = v.i + 1
  JOIN al ON al.m = ix.m JOIN st ON st.a = v.tag AND st.b = al.tag
  GROUP BY ix.doc_id, ix.s, ix.i, al.tag),
ends AS (SELECT doc_id, s, max(i) AS i FROM ix GROUP BY ALL),
b(doc_id, s, i, tag) AS (
  SELECT v.doc_id, v.s, v.i, CAST(min(v.score * 64 + v.tag) % 64 AS INT)
  FROM v JOIN ends USING (doc_id, s, i) GROUP BY ALL
  UNION ALL
  SELECT v.doc_id, v.s, v.i - 1, v.prev FROM b JOIN v
    ON v.doc_id = b.doc_id AND v.s = b.s AND v.i = b.i AND v.tag = b.tag WHERE b.i > 0),
tagged AS (SELECT ix.doc_id, ix.p, ix.token, names.name AS tag
           FROM ix JOIN b USING (doc_id, s, i) JOIN names ON names.tag = b.tag WHERE ix.m <> 0)
"""


@query("txt1_tag_in_context", _viterbi_sql() + """
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY p) - 1 AS BIGINT) AS pos, token, tag
FROM tagged""")
def txt1_context(spark, sf):
    tagged = G.tag_words(table(spark, sf, DOC), "text", keep=["doc_id"])
    return tagged.withColumn("pos", F.col("pos").cast("long"))


@query("txt2_top_by_tag_in_context", _viterbi_sql() + f"""
, fc AS (SELECT {family_sql('tag')} AS family, token, CAST(COUNT(*) AS BIGINT) AS n FROM tagged
         WHERE token NOT IN {STOP_SQL} GROUP BY ALL),
ft AS (SELECT family, CAST(ROW_NUMBER() OVER (PARTITION BY family ORDER BY n DESC, token) AS INT) AS rank,
              token, n FROM fc WHERE family IS NOT NULL)
SELECT * FROM ft WHERE rank <= {TOP}""")
def txt2_context(spark, sf):
    """Most frequent words of each family, by the tags they have in context."""
    counts = T.drop_stopwords(G.tag_counts(table(spark, sf, DOC), "text"), T.stop_table(spark))
    fam = (counts.groupBy(T.family_expr("tag").alias("family"), "token")
           .agg(F.sum("n").alias("n")).withColumn("family", per_group(F.col("family"))))
    top = T.top_terms(fam.where("family IS NOT NULL"), by=["family"], k=TOP)
    return top.select("family", F.col("rank").cast("int").alias("rank"), "token", "n")


@query("txt1_tagger_expectations", f"""
WITH tk AS (SELECT unnest(regexp_extract_all(lower(text), '[\\p{{L}}\\p{{N}}_]+|[.!?\\n]')) AS token
            FROM documents),
sy AS (SELECT {_symbol_sql('token')} AS symbol, COUNT(*) AS n FROM tk GROUP BY ALL)
SELECT CAST(symbol AS INT) AS symbol, CAST(n AS DOUBLE) AS shown FROM sy""")
def txt1_expectations(spark, sf):
    """Expected tags of every symbol under a model learned in two rounds: over
    all tags they add up to the symbol's occurrences, whatever the model."""
    docs = table(spark, sf, DOC)
    symbols = G.symbol_table(docs, "text", G.default_tagger())
    model = G.fit(docs, "text", rounds=2, symbols=symbols)
    counts = G.expected_counts(symbols, model)
    return (counts.where("kind = 1").groupBy(F.col("i").alias("symbol"))
            .agg(F.round(F.sum("value"), 3).alias("shown")))
