"""P4 trained by mini-batches, and checks of trained models whose values plain
SQL knows (ML2, ML3)."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F
from pyspark.ml.functions import vector_to_array

from ..operators import scoring as SC
from ..operators import training as N
from .catalog import query, table
from .labels import _SPLIT_SQL, class_index, ml1, split_vectors

EMB = "embeddings"
EPOCHS = 3


def fixed_weights(classes: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Weights by rule, for scores that can be checked value by value."""
    c, d = np.arange(classes)[:, None], np.arange(n)[None, :]
    return ((c * 7 + d * 3) % 11 - 5) / 2.0, (np.arange(classes) % 3) / 10.0


def split_rows(spark, sf):
    marks = ml1(spark, sf).select("vec_id", "is_validation")
    return table(spark, sf, EMB).select("vec_id", "embedding", "label").join(marks, "vec_id")


@query("ml2_adam_history", _SPLIT_SQL + f"""
, c AS (SELECT COUNT(DISTINCT label) AS k FROM embeddings),
v AS (SELECT COUNT(*) AS m FROM sp WHERE is_validation)
SELECT CAST(e AS INT) AS epoch, CAST(en.n AS BIGINT) AS n_train, CAST(m AS BIGINT) AS n_validation,
       CASE WHEN e = 0 THEN ROUND(ln(k), 6) END AS start_loss
FROM range({EPOCHS + 1}) AS x(e), en, c, v""")
def ml2_adam(spark, sf):
    """History of a run: rows met per epoch, and the validation loss before any
    step, which is the logarithm of the number of classes."""
    classes = class_index(spark, sf).count()
    model = N.fit_softmax(split_rows(spark, sf), classes, "embedding", "label", "vec_id",
                          epochs=EPOCHS, n_batches=4, learning_rate=0.02)
    start = model.history[0]["val_loss"]
    return spark.createDataFrame(
        [(h["epoch"], h["n_train"], h["n_validation"], round(start, 6) if h["epoch"] == 0 else None)
         for h in model.history],
        "epoch int, n_train bigint, n_validation bigint, start_loss double")


@query("ml2_first_gradient", _SPLIT_SQL + """
, c AS (SELECT COUNT(DISTINCT label) AS k FROM embeddings),
x AS (SELECT e.label, generate_subscripts(e.embedding, 1) - 1 AS feature, unnest(e.embedding) AS v
      FROM embeddings e JOIN sp ON e.vec_id = sp.vec_id WHERE NOT is_validation)
SELECT CAST(l.class AS INT) AS class, CAST(feature AS INT) AS feature,
       ROUND(SUM(CAST(v AS DOUBLE) * (1.0 / k - CASE WHEN label = l.class THEN 1 ELSE 0 END)), 6) + 0.0 AS gradient
FROM x, c, (SELECT DISTINCT label AS class FROM embeddings) l GROUP BY ALL""")
def ml2_first_gradient(spark, sf):
    """Gradient of the loss over all training rows at weights zero."""
    classes = class_index(spark, sf).count()
    data = N.prepared(split_rows(spark, sf), "embedding", "label", "vec_id", "is_validation", 1, 0)
    n = data.agg(F.max(F.size("x"))).first()[0] or 0
    _, _, _, g, _ = N.sums(data.where("batch = 0"), np.zeros((classes, n)), np.zeros(classes))
    rows = [(int(c), int(d), round(float(v), 6) + 0.0) for (c, d), v in np.ndenumerate(g)]
    return spark.createDataFrame(rows, "class int, feature int, gradient double")


@query("ml2_class_mass", _SPLIT_SQL + """
SELECT CAST(tr.label AS INT) AS class, ROUND(tr.n / en.n, 3) AS mass FROM tr, en""")
def ml2_class_mass(spark, sf):
    """Share of every class in the probabilities the fitted classifier gives
    its training rows: at the optimum, with intercepts, its share of rows."""
    rows = split_vectors(spark, sf).filter(~F.col("is_validation"))
    scored = SC.train_softmax(rows).transform(rows)
    return (scored.select(F.posexplode(vector_to_array("probability")).alias("class", "p"))
            .groupBy("class").agg(F.round(F.avg("p"), 3).alias("mass")))


@query("ml3_score_fixed", """
WITH c AS (SELECT COUNT(DISTINCT label) AS k FROM embeddings),
w AS (SELECT vec_id, label, list_transform(range(k), lambda c: list_sum(list_transform(embedding,
        lambda x, i: CAST(x AS DOUBLE) * (((c * 7 + (i - 1) * 3) % 11 - 5) / 2.0))) + (c % 3) / 10.0) AS z
      FROM embeddings, c),
p AS (SELECT vec_id, label, list_transform(z, lambda v: exp(v) / list_sum(list_transform(z, lambda u: exp(u)))) AS p
      FROM w)
SELECT vec_id, CAST(list_position(p, list_max(p)) - 1 AS INT) AS pred, ROUND(list_max(p), 6) AS best,
       ROUND(p[label + 1], 6) AS of_label FROM p""")
def ml3_fixed(spark, sf):
    """Every vector scored with weights given by a rule."""
    classes = class_index(spark, sf).count()
    e = table(spark, sf, EMB)
    n = e.agg(F.max(F.size("embedding"))).first()[0] or 0
    p = e.select("vec_id", "label", N.probabilities("embedding", *fixed_weights(classes, n)).alias("p"))
    best = F.array_max("p")
    return p.select("vec_id", (F.array_position("p", best) - 1).cast("int").alias("pred"),
                    F.round(best, 6).alias("best"),
                    F.round(F.get("p", F.col("label")), 6).alias("of_label"))
