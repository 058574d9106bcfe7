"""Registered queries of the corpus operators: one per operator, over the
whole intended table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, host_quality, language_id, line_dedup, mixing, ngram_join, packing, pii,
               spelling, topk, url_filter, word_runs)
from .common import WS_CLASS, read
from .token_count import count_tokens

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def _query(name: str, oracle: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn
    return deco


@_query("op1_byte_bpe")
def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = bpe.decode(bpe.encode(read(spark, sf_dir, "documents")))
    return decoded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                          F.sha2("decoded", 256).alias("decoded_sha256"))


@_query("op2_token_counts")
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read(spark, sf_dir, "documents"))


@_query("op3_line_dedup", """
WITH d AS (
  SELECT doc_id, text, source, string_split(text, chr(10)) AS l FROM documents),
e AS (
  SELECT doc_id, source, unnest(l) AS line, generate_subscripts(l, 1) AS i FROM d),
s AS (SELECT *, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS s FROM e),
b AS (
  SELECT s, min(doc_id) AS keeper FROM s WHERE s <> '' GROUP BY s
  HAVING count(DISTINCT source) >= 10),
m AS (
  SELECT s.doc_id, s.i, s.line, s.s <> '' AS visible,
         b.s IS NOT NULL AND b.keeper <> s.doc_id AS gone
  FROM s LEFT JOIN b ON s.s = b.s),
g AS (
  SELECT doc_id, sum(visible::INT) AS n_lines, sum(gone::INT) AS n_removed,
         string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT gone) AS text
  FROM m GROUP BY doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(g.text, '') END AS text,
       CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
""")
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "text", "n_lines", "n_removed")


@_query("op4_topk_search", """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c AS (SELECT vec_id, unnest(v) AS x, generate_subscripts(v, 1) AS d FROM v),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, sum(q.x * c.x) AS score
  FROM c AS q JOIN c ON q.d = c.d AND q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
  GROUP BY 1, 2),
r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM s)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, CAST(score AS BIGINT) AS score
FROM r WHERE n <= 5
""")
def op4_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(read(spark, sf_dir, "embeddings"), lambda i: F.pmod(i, F.lit(50)) == 0)


@_query("op5_url_filter")
def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(read(spark, sf_dir, "pages"))


@_query("op6_host_quality", """
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t FROM documents),
m AS (
  SELECT doc_id, source, t,
         regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(t, chr(10)),
                     lambda s: regexp_matches(s, '[^\\x20\\x09-\\x0D]')) AS l
  FROM d),
p AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, w FROM m WHERE len(w) >= 3),
g AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g FROM p),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM g),
k AS (SELECT DISTINCT doc_id, unnest([i, i + 1, i + 2]) AS i FROM r WHERE n > 1),
c AS (SELECT doc_id, count(*) AS n FROM k GROUP BY doc_id),
b AS (
  SELECT m.doc_id, m.source, len(w) AS n_words, len(l) AS n_lines,
         length(array_to_string(w, '')) AS word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
         len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM m LEFT JOIN c ON m.doc_id = c.doc_id),
x AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM b),
f AS (
  SELECT *, base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
            OR word_chars < 2 * n_words OR word_chars > 15 * n_words AS failed FROM x),
h AS (SELECT source, count(*) AS n, sum(failed::INT) AS f FROM f WHERE source IS NOT NULL GROUP BY 1),
o AS (
  SELECT sum(f) / sum(n) AS q, sum(n) AS n, count(*) AS h,
         least(greatest(sum(f) / sum(n), 1 / (sum(n) + 2)), 1 - 1 / (sum(n) + 2)) AS mean FROM h),
v AS (
  SELECT any_value(mean) AS mean,
         sum(h.n * pow(h.f / h.n - q, 2)) / any_value(o.n)
           - any_value(mean) * (1 - any_value(mean)) * (any_value(o.h) - 1) / any_value(o.n) AS z
  FROM h, o),
a AS (
  SELECT mean, CASE WHEN z > 0 THEN least(1000, greatest(1, mean * (1 - mean) / z - 1))
                    ELSE 1000 END AS s FROM v),
e AS (SELECT source, (f + mean * s) / (n + s) AS host_rate FROM h, a)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(host_rate, 0) <= 0.5 AS kept
FROM f LEFT JOIN e ON f.source = e.source
""")
def op6_host_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_quality.host_rules(read(spark, sf_dir, "documents")).drop("host_rate")


@_query("op7_language_id")
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    learned = language_id.train(docs.where(language_id.fold(F.col("doc_id")) != 0))
    asked = docs.select("doc_id", "text",
                        (language_id.fold(F.col("doc_id")) == 0).alias("held_out"))
    return (language_id.identify(asked, learned)
            .select("doc_id", "held_out", "lang_pred", "score", "rejected"))


@_query("op8_best_fit_packing")
def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(read(spark, sf_dir, "documents"))
    digests = cut.select("row", "doc_id", "piece", "start", "length",
                         F.crc32("ids").alias("ids_crc32"))
    return packing.pack(digests).drop("row")


@_query("op9_pii")
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(read(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.KINDS),
                        F.sha2(pii.span_text(F.col("base")), 256).alias("base_sha256"),
                        pii.span_text(F.col("spans")).alias("spans"))


@_query("op10_ngram_jaccard")
def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents"))


def _periodic(df: DataFrame) -> DataFrame:
    """A tenth of the texts made periodic from some word on, as the contract of
    op11 asks: (doc_id, text)."""
    words = F.filter(F.split(F.coalesce("text", F.lit("")), WS_CLASS), lambda w: w != "")
    h = F.crc32(F.col("doc_id").cast("string"))
    w = df.select("doc_id", "text", words.alias("w"), h.alias("h"), F.floor(h / 10).alias("g"))
    w = w.withColumn("n", F.size("w"))
    w = w.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    w = w.withColumn("p", (1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))).cast("int"))
    rest = F.col("n") - F.col("a")
    tail = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")),
                                    F.ceil(rest / F.col("p")).cast("int")))
    made = F.concat_ws(" ", F.slice("w", F.lit(1), F.col("a")), F.slice(tail, F.lit(1), rest))
    return w.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), made)
                    .otherwise(F.col("text")).alias("text"))


@_query("op11_word_runs")
def op11_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = word_runs.find_runs(_periodic(read(spark, sf_dir, "documents")))
    best = word_runs.strongest("runs")
    lines = F.array_join(F.transform("runs", lambda r: F.concat(
        F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))), "")
    found = found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("b"),
                         F.sha2(lines, 256).alias("runs_sha256"),
                         F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return found.select("doc_id", "n_runs", "b.start", "b.length", "b.period",
                        F.floor(1000 * F.col("b.length") / F.col("b.period")).alias("exponent_milli"),
                        "runs_sha256", "collapsed_sha256")


@_query("op12_mix_sources", """
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source,
         len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size,
         md5(concat('mix0:', coalesce(CAST(doc_id AS VARCHAR), 'null'))) AS k
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1),
i AS (
  SELECT *, [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS w
  FROM s),
-- capped sources have the smallest caps per weight: try every number of them
c AS (
  SELECT *, 2.0 * source_size / w AS reach,
         1.5 * sum(source_size) OVER () - coalesce(sum(2 * source_size) OVER b, 0) AS rest,
         sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS weight
  FROM i WINDOW b AS (ORDER BY 2.0 * source_size / w, source
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
  SELECT CAST(rest AS DOUBLE) / weight AS level FROM c
  WHERE reach >= CAST(rest AS DOUBLE) / weight ORDER BY reach, source LIMIT 1),
t AS (
  SELECT source, source_size,
         CASE WHEN level * w > 2.0 * source_size THEN CAST(2 * source_size AS DOUBLE) ELSE level * w END AS target
  FROM i, l),
q AS (SELECT *, CAST(floor(target + 0.5) AS BIGINT) AS words FROM t),
p AS (
  SELECT d.doc_id, d.size, q.source_size, q.target, q.words,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY k, d.size, r
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
  FROM d JOIN q ON d.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
       CAST(least(greatest(words - a, 0), size) + least(greatest(words - source_size - a, 0), size)
            AS BIGINT) AS taken
FROM p
""")
def op12_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, pieces = mixing.mix(read(spark, sf_dir, "documents").select(
        "doc_id", "source", mixing.word_count("text").alias("size")))
    taken = pieces.groupBy("_row").agg(F.sum("length").alias("taken"))
    return (docs.join(taken, "_row", "left")
            .select("doc_id", "size", "source_size", "target",
                    F.coalesce("taken", F.lit(0)).cast("long").alias("taken")))


@_query("op13_spelling_variants", """
WITH RECURSIVE t(step, i, c) AS (
  SELECT 0, i, i FROM range(256) AS x(i)
  UNION ALL
  SELECT step + 1, i, CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END
  FROM t WHERE step < 8),
k AS (SELECT list(CAST(c AS BIGINT) ORDER BY i) AS crc FROM t WHERE step = 8),
r AS (
  SELECT doc_id, translate(x, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x,
         count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')) AS x FROM documents)
  GROUP BY 1, 2),
b AS (
  SELECT x, n, flatten(list_transform(string_split(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || x, ''),
           lambda s: CASE WHEN unicode(s) < 128 THEN [unicode(s)]
                          ELSE [192 + unicode(s) // 64, 128 + unicode(s) % 64] END)) AS bytes
  FROM r),
h AS (
  SELECT x, n, xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
           list_transform(bytes, lambda y: CAST(y AS BIGINT))),
           lambda a, y: xor(a >> 8, crc[xor(a & 255, y) + 1]))) AS h
  FROM b, k),
w AS (
  SELECT CASE WHEN h % 97 = 0 THEN x[:h % length(x)] || x[h % length(x) + 2:] ELSE x END AS word, n
  FROM h),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM w WHERE length(word) >= 5 GROUP BY 1 HAVING sum(n) >= 3),
e AS (
  SELECT word, n, i, word[:i - 1] || word[i + 1:] AS cut
  FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM v)),
p AS (
  SELECT a.word, b.word AS near, b.n AS near_n
  FROM e AS a JOIN e AS b ON a.cut = b.cut AND a.i = b.i AND a.word <> b.word
  UNION
  SELECT e.word, v.word, v.n FROM e JOIN v ON e.cut = v.word
  UNION
  SELECT v.word, e.word, e.n FROM e JOIN v ON e.cut = v.word),
m AS (
  SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n
  FROM p GROUP BY 1),
f AS (
  SELECT v.word, v.n, CAST(coalesce(n_near, 0) AS BIGINT) AS n_near,
         CASE WHEN near_n >= 2 * v.n THEN near END AS form,
         CASE WHEN near_n >= 2 * v.n THEN near_n END AS form_n
  FROM v LEFT JOIN m ON v.word = m.word),
g(word, root, more) AS (
  SELECT word, coalesce(form, word), form IS NOT NULL FROM f
  UNION ALL
  SELECT g.word, coalesce(f.form, f.word), f.form IS NOT NULL FROM g JOIN f ON g.root = f.word WHERE more)
SELECT f.word, f.form, g.root, f.n, f.n_near, f.form_n
FROM f JOIN g ON f.word = g.word WHERE NOT g.more
""")
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = spelling.count_words(read(spark, sf_dir, "documents"), drop_every=97)
    return spelling.group_variants(words.where("n >= 3"))
