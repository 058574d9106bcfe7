"""P4 label scoring over feature vectors: class index, per-class split,
softmax training and scoring, evaluation, ranking (SRC4, SINK2, AGG13-14,
ML1-3, NUM5, NUM9, PRF7, ARR2-5, SRT7)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import argmax, is_correct
from ..functions.numeric import batches, rescale
from ..functions.strings import title
from ..operators import aggregates as agg
from ..operators import profile
from ..operators import scoring as SC
from ..session import scratch_path, stored
from ..sources import images
from ..sources.io import read_labelled_lines, write_labels
from .catalog import query, table

EMB = "embeddings"
VALIDATION = 0.2
BATCH = 32
SCORE_LEN = 4      # classes of the score vector of the ranking operators
SOFTMAX_LEN = 10   # logits over the ten classes (one per label)

LABEL_NAME = "concat('class_', CAST(label AS VARCHAR))"


def vectors(spark, sf) -> DataFrame:
    e = table(spark, sf, EMB)
    return e.withColumn("label_name", F.concat(F.lit("class_"), F.col("label").cast("string")))


def class_index(spark, sf) -> DataFrame:
    return agg.class_index(vectors(spark, sf), "label_name")


def scores(df: DataFrame, k: int) -> F.Column:
    """A k-class score vector from the whole feature vector: score ``c`` is
    the sum of the elements whose (0-based) position is ``c`` modulo ``k``."""
    e = F.col("embedding").cast("array<double>")

    def in_class(c):
        return lambda x, i: i % k == c

    return F.array(*[F.aggregate(F.filter(e, in_class(c)), F.lit(0.0), lambda a, x: a + x)
                     for c in range(k)])


def with_scores(df: DataFrame, k: int) -> DataFrame:
    """The score vector as a column of its own, so that the expressions
    reading it several times (argmax, softmax) do not recompute it."""
    return df.withColumn("s", scores(df, k))


def scores_sql(k: int) -> str:
    """DuckDB mirror of ``scores`` (list positions are 1-based there)."""
    e = "CAST(embedding AS DOUBLE[])"
    parts = [f"list_reduce(list_prepend(0.0::DOUBLE, list_filter({e}, lambda x, i: (i - 1) % {k} = {c})), "
             f"lambda a, x: a + x)" for c in range(k)]
    return "list_value(" + ", ".join(parts) + ")"


def softmax(arr: F.Column) -> F.Column:
    m = F.array_max(arr)
    ex = F.transform(arr, lambda x: F.exp(x - m))
    total = F.aggregate(ex, F.lit(0.0), lambda a, x: a + x)
    return F.transform(ex, lambda x: x / total)


_CLASS_SQL = f"""
WITH ci AS (SELECT label_name, CAST(dense_rank() OVER (ORDER BY label_name) - 1 AS INT)
                   AS class_index
            FROM (SELECT DISTINCT {LABEL_NAME} AS label_name FROM embeddings))
"""

_SOFTMAX_SQL = f"""
WITH lg AS (SELECT vec_id, label, {scores_sql(SOFTMAX_LEN)} AS x FROM embeddings),
ex AS (SELECT vec_id, label, list_transform(x, lambda v: exp(v - list_max(x))) AS e FROM lg),
sm AS (SELECT vec_id, label, list_transform(e, lambda v: v / list_sum(e)) AS p FROM ex)
"""


@query("agg13_class_index", _CLASS_SQL + "SELECT * FROM ci")
def agg13(spark, sf):
    return class_index(spark, sf)


@query("str13_title", """
SELECT DISTINCT c_mktsegment,
       concat(upper(substring(c_mktsegment, 1, 1)), lower(substring(c_mktsegment, 2))) AS title
FROM customer""")
def str13(spark, sf):
    c = table(spark, sf, "customer").select("c_mktsegment").distinct()
    return c.select("c_mktsegment", title("c_mktsegment").alias("title"))


@query("ml1_split_per_class", f"""
SELECT vec_id, label, rn <= floor(n * {VALIDATION}) AS is_validation FROM (
  SELECT vec_id, label, ROW_NUMBER() OVER (PARTITION BY label ORDER BY vec_id) AS rn,
         COUNT(*) OVER (PARTITION BY label) AS n FROM embeddings)""")
def ml1(spark, sf):
    e = table(spark, sf, EMB).select("vec_id", "label")
    return SC.split_per_class(e, "label", VALIDATION, "vec_id").select("vec_id", "label",
                                                                       "is_validation")


@query("num5_rescale", """
SELECT vec_id, CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS pos,
       ROUND(unnest(list_transform(CAST(embedding AS DOUBLE[]), lambda x: x * (1.0 / 255))), 9) AS value
FROM embeddings""")
def num5(spark, sf):
    """Every element rescaled by 1/255 (D:36), one row per element."""
    r = rescale(F.col("embedding").cast("array<double>"), 1.0 / 255)
    return table(spark, sf, EMB).select("vec_id", F.posexplode(r).alias("pos", "x")).select(
        "vec_id", "pos", F.round("x", 9).alias("value"))


@query("arr2_argmax", f"""
SELECT vec_id, CAST(list_position({scores_sql(SCORE_LEN)}, list_max({scores_sql(SCORE_LEN)})) - 1
                    AS INT) AS pred FROM embeddings""")
def arr2(spark, sf):
    e = with_scores(table(spark, sf, EMB), SCORE_LEN)
    return e.select("vec_id", argmax("s").alias("pred"))


@query("srt7_rank_classes", f"""
SELECT vec_id, CAST(rank AS INT) AS rank, CAST(cls AS INT) AS class FROM (
  SELECT vec_id, unnest(generate_series(0, {SCORE_LEN - 1})) AS rank,
         unnest(list_transform(list_sort(list_transform({scores_sql(SCORE_LEN)},
                lambda x, i: {{'n': -x, 'i': i - 1}})), lambda s: s.i)) AS cls
  FROM embeddings)""")
def srt7(spark, sf):
    e = with_scores(table(spark, sf, EMB), SCORE_LEN)
    r = SC.rank_classes(e, "s", keep=["vec_id"])
    return r.select("vec_id", F.col("rank").cast("int").alias("rank"),
                    F.col("class").cast("int").alias("class"))


@query("arr3_label_of", _CLASS_SQL + f"""
SELECT e.vec_id, e.pred, ci.label_name FROM (
  SELECT vec_id, CAST(list_position({scores_sql(SCORE_LEN)}, list_max({scores_sql(SCORE_LEN)}))
                      - 1 AS INT) AS pred FROM embeddings) e
LEFT JOIN ci ON e.pred = ci.class_index""")
def arr3(spark, sf):
    e = with_scores(table(spark, sf, EMB), SCORE_LEN)
    p = e.select("vec_id", argmax("s").alias("pred"))
    return SC.label_of(p, "pred", class_index(spark, sf), "label_name") \
        .select("vec_id", "pred", "label_name")


@query("arr4_get_field", f"""
SELECT vec_id, CAST(p.i AS INT) AS best_index, ROUND(p.v, 9) AS best_score FROM (
  SELECT vec_id, list_sort(list_transform({scores_sql(SCORE_LEN)},
         lambda x, i: {{'n': -x, 'i': i - 1, 'v': x}}))[1] AS p FROM embeddings)""")
def arr4(spark, sf):
    """Fields of the best (score, index) pair of every vector."""
    e = with_scores(table(spark, sf, EMB), SCORE_LEN)
    pairs = F.array_sort(F.transform("s", lambda x, i: F.struct((-x).alias("n"), i.alias("i"),
                                                              x.alias("v"))))
    best = F.element_at(pairs, 1)
    return e.select("vec_id", best.getField("i").cast("int").alias("best_index"),
                    F.round(best.getField("v"), 9).alias("best_score"))


@query("arr5_is_correct", f"""
SELECT vec_id, label, CAST(list_position({scores_sql(SOFTMAX_LEN)}, list_max({scores_sql(SOFTMAX_LEN)}))
                           - 1 AS INT) AS pred,
       CAST(list_position({scores_sql(SOFTMAX_LEN)}, list_max({scores_sql(SOFTMAX_LEN)})) - 1
            AS INT) = label AS correct
FROM embeddings""")
def arr5(spark, sf):
    e = with_scores(table(spark, sf, EMB), SOFTMAX_LEN)
    p = e.select("vec_id", "label", argmax("s").alias("pred"))
    return p.withColumn("correct", is_correct("pred", "label"))


@query("agg14_evaluate", _SOFTMAX_SQL + """
SELECT ROUND(AVG(-ln(greatest(p[label + 1], 1e-7))), 6) AS loss,
       ROUND(AVG(CAST(list_position(p, list_max(p)) - 1 = label AS INT)) * 100, 6) AS accuracy
FROM sm""")
def agg14(spark, sf):
    e = with_scores(table(spark, sf, EMB), SOFTMAX_LEN)
    sm = e.select("label", softmax(F.col("s")).alias("p"))
    out = agg.evaluate(sm, "p", "label")
    return out.select(F.round("loss", 6).alias("loss"), F.round("accuracy", 6).alias("accuracy"))


@query("prf7_batch_shape", f"""
SELECT CAST(COUNT(*) AS BIGINT) AS batch_rows, CAST(MAX(len(embedding)) AS INT) AS array_len
FROM (SELECT * FROM embeddings ORDER BY vec_id LIMIT {BATCH})""")
def prf7(spark, sf):
    return profile.batch_shape(table(spark, sf, EMB), "vec_id", BATCH, "embedding")


@query("num9_batches", f"""
SELECT is_validation, CAST(COUNT(*) AS BIGINT) AS n, CAST(ceil(COUNT(*) / {BATCH}) AS BIGINT) AS batches
FROM (SELECT rn <= floor(n * {VALIDATION}) AS is_validation FROM (
  SELECT ROW_NUMBER() OVER (PARTITION BY label ORDER BY vec_id) AS rn,
         COUNT(*) OVER (PARTITION BY label) AS n FROM embeddings)) GROUP BY is_validation""")
def num9(spark, sf):
    s = ml1(spark, sf).groupBy("is_validation").agg(F.count(F.lit(1)).cast("bigint").alias("n"))
    return s.withColumn("batches", batches("n", BATCH))


def split_vectors(spark, sf) -> DataFrame:
    e = vectors(spark, sf)
    marks = ml1(spark, sf).select("vec_id", "is_validation")
    return SC.to_vector(e.join(marks, "vec_id"), "embedding")


def trained(spark, sf):
    """(model, validation rows scored): one fit for training history, scores
    and evaluation."""
    data = split_vectors(spark, sf)
    model = SC.train_softmax(data.filter(~F.col("is_validation")))
    scored = SC.score(model, data.filter(F.col("is_validation")), class_index(spark, sf))
    return model, scored


_SPLIT_SQL = f"""
WITH sp AS (SELECT vec_id, label, rn <= floor(n * {VALIDATION}) AS is_validation FROM (
  SELECT vec_id, label, ROW_NUMBER() OVER (PARTITION BY label ORDER BY vec_id) AS rn,
         COUNT(*) OVER (PARTITION BY label) AS n FROM embeddings)),
tr AS (SELECT label, COUNT(*) AS n FROM sp WHERE NOT is_validation GROUP BY label),
en AS (SELECT -SUM(n / t * ln(n / t)) AS h, SUM(n) AS n FROM tr, (SELECT SUM(n) AS t FROM tr))
"""


@query("ml2_train_softmax", _SPLIT_SQL + """
SELECT CAST(n AS BIGINT) AS n_train, ROUND(h, 4) AS first_loss, TRUE AS never_rises,
       TRUE AS ends_below_start FROM en""")
def ml2(spark, sf):
    """Softmax classifier trained on the training rows.  What is certain of
    its loss history: it starts at the entropy of the labels (all weights
    zero, intercepts at the label frequencies) and never rises."""
    model, _ = trained(spark, sf)
    hist = list(model.summary.objectiveHistory)
    n = ml1(spark, sf).filter(~F.col("is_validation")).count()
    return spark.createDataFrame(
        [(n, round(hist[0], 4), all(b <= a + 1e-9 for a, b in zip(hist, hist[1:])),
          hist[-1] < hist[0])],
        "n_train bigint, first_loss double, never_rises boolean, ends_below_start boolean")


@query("ml3_score", _SPLIT_SQL + """
SELECT vec_id, label, TRUE AS class_in_range, TRUE AS label_fits, TRUE AS sums_to_one
FROM sp WHERE is_validation""")
def ml3(spark, sf):
    """Exactly the validation rows scored: predicted class within the class
    range, its label from the class index, probabilities that sum to 1."""
    _, scored = trained(spark, sf)
    total = F.aggregate("probs", F.lit(0.0), lambda a, x: a + x)
    classes = class_index(spark, sf).count()
    return scored.select(
        "vec_id", "label", F.col("pred").between(0, classes - 1).alias("class_in_range"),
        F.col("pred_label").isNotNull().alias("label_fits"),
        (F.abs(total - 1) < 1e-6).alias("sums_to_one"))


@query("p4_label_run", _SPLIT_SQL + f"""
SELECT {LABEL_NAME} AS label_name, COUNT(*) FILTER (WHERE NOT is_validation) AS n_train,
       COUNT(*) FILTER (WHERE is_validation) AS n_scored, TRUE AS accuracy_in_range,
       TRUE AS loss_positive
FROM sp GROUP BY label""")
def p4(spark, sf):
    """The label run as one result: split, train once, score and evaluate the
    validation rows; per class the rows trained on and scored, with the
    accuracy and loss of the model's own validation scores (AGG14)."""
    _, scored = trained(spark, sf)
    scored = stored(scored.select("vec_id", "label", "probs"), "scored")
    ev = agg.evaluate(scored, "probs", "label").first()
    split = ml1(spark, sf).groupBy("label").agg(
        F.count_if(~F.col("is_validation")).alias("n_train"))
    hits = scored.groupBy("label").agg(F.count(F.lit(1)).alias("n_scored"))
    return split.join(hits, "label", "left").select(
        F.concat(F.lit("class_"), F.col("label").cast("string")).alias("label_name"), "n_train",
        F.coalesce("n_scored", F.lit(0)).cast("bigint").alias("n_scored"),
        F.lit(0 <= ev["accuracy"] <= 100).alias("accuracy_in_range"),
        F.lit(ev["loss"] > 0).alias("loss_positive"))


@query("sink2_write_labels", f"SELECT DISTINCT {LABEL_NAME} AS value FROM embeddings")
def sink2(spark, sf):
    path = scratch_path(spark, "labels_txt")
    write_labels(vectors(spark, sf), "label_name", path)
    return spark.read.text(path)


@query("src4_read_labelled_dir", f"""
SELECT {LABEL_NAME} AS label, concat(CAST(vec_id AS VARCHAR), ':', array_to_string(list_transform(
         embedding, lambda x: CAST(floor(CAST(x AS DOUBLE) * 1000000) AS BIGINT)), ',')) AS record
FROM embeddings""")
def src4(spark, sf):
    """Vectors written as lines of text files under one folder per label,
    then read back: every record with the label of its folder."""
    path = scratch_path(spark, "labelled")
    micro = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.floor(x * 1000000))
    v = vectors(spark, sf).select(
        "label_name", F.concat_ws(":", F.col("vec_id").cast("string"),
                                  F.array_join(micro.cast("array<string>"), ",")).alias("value"))
    v.write.mode("overwrite").partitionBy("label_name").text(path)
    return read_labelled_lines(spark, path).select("label", F.col("value").alias("record"))


@query("src4_read_labelled_images", f"""
WITH v AS (SELECT {LABEL_NAME} AS label, list_transform(embedding, lambda x:
             greatest(0, least(255, CAST(floor((CAST(x AS DOUBLE) + 1) * 127) AS BIGINT)))) AS b
           FROM embeddings),
k AS (SELECT label, b, list_transform(range(0, 192), lambda k: CASE k % 3
             WHEN 0 THEN b[64 - (56 - 8 * (k // 24) + (k // 6) % 4)]
             WHEN 1 THEN 255 - b[57 - 8 * (k // 24) + (k // 6) % 4]
             ELSE b[57 - 8 * (k // 24) + (k // 6) % 4] END) AS c FROM v)
SELECT label, 16 AS height, 4 AS width, 192 AS n_pixels, array_to_string(c, ',') AS colours FROM k""")
def src4_images(spark, sf):
    """Every vector as a bitmap file of 16 rows of 4 pixels (blue an element,
    green its complement, red the element at the other end) in a folder per
    label; the files decoded, resized to 8 by 8 and scaled."""
    path = scratch_path(spark, "images")
    element = F.transform(F.col("embedding").cast("array<double>"), lambda x: F.greatest(
        F.least(F.floor((x + 1) * 127), F.lit(255)), F.lit(0)).cast("int"))
    v = vectors(spark, sf).select("label_name", element.alias("b"))
    pixel = F.transform("b", lambda x, i: F.concat(*[F.lpad(F.hex(c), 2, "0") for c in (
        x, 255 - x, F.get("b", F.size("b") - 1 - i))]))
    files = v.withColumn("file", images.bitmap(F.unhex(F.array_join(pixel, "")), 16, 4))
    images.write_labelled_files(files, "file", "label_name", path)
    read = images.read_labelled_images(spark, path, 8, 8)
    whole = F.transform("pixels", lambda x: F.round(x * 255).cast("int").cast("string"))
    return read.select("label", "height", "width", F.size("pixels").alias("n_pixels"),
                       F.array_join(whole, ",").alias("colours"))
