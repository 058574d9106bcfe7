"""Label scoring (AGG13-14, ML1-3, ARR2-5, SRT7).

Images and a pretrained network are replaced by the feature vectors of the
``embeddings`` table; the classifier is ``pyspark.ml``'s multinomial
logistic regression (a softmax layer over fixed features, as in the
analysis), trained with distributed L-BFGS.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.arrays import argmax, ranked_indices


def split_per_class(df: DataFrame, label: str, fraction: float, key: str,
                    out: str = "is_validation") -> DataFrame:
    """Mark the first ``floor(fraction * n_class)`` rows of every class (by
    ``key``) as validation rows (ML1).

    The class sizes come from a grouped count; the position of a row in its
    class from ``number_rows``, which splits big classes into key ranges."""
    from .windows import number_rows
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_cn"))
    numbered = number_rows(df, [label], key, out="_pos")
    return (numbered.join(sizes, on=label, how="inner")
            .withColumn(out, F.col("_pos") <= F.floor(F.col("_cn") * F.lit(fraction)))
            .drop("_pos", "_cn"))


def to_vector(df: DataFrame, arr: str, out: str = "features") -> DataFrame:
    from pyspark.ml.functions import array_to_vector
    return df.withColumn(out, array_to_vector(F.col(arr).cast("array<double>")))


def train_softmax(train: DataFrame, features: str = "features", label: str = "label",
                  max_iter: int = 100, reg: float = 0.0):
    """Multinomial logistic regression (ML2); the model keeps its loss
    history in ``model.summary.objectiveHistory``."""
    from pyspark.ml.classification import LogisticRegression
    lr = LogisticRegression(featuresCol=features, labelCol=label, family="multinomial",
                            maxIter=max_iter, regParam=reg)
    return lr.fit(train.withColumn(label, F.col(label).cast("double")))


def score(model, df: DataFrame, index: DataFrame | None = None,
          index_label: str = "label_name") -> DataFrame:
    """Class probabilities, predicted class index and, with a class index
    table, the predicted label name (ML3, ARR2, ARR3)."""
    from pyspark.ml.functions import vector_to_array
    out = model.transform(df).withColumn("probs", vector_to_array("probability"))
    out = out.withColumn("pred", argmax("probs"))
    if index is not None:
        idx = index.select(F.col("class_index").alias("pred"),
                           F.col(index_label).alias("pred_label"))
        out = out.join(idx, on="pred", how="left")
    return out


def rank_classes(df: DataFrame, probs: str, keep=()) -> DataFrame:
    """Class indices ordered by score, one row per (row, rank) (SRT7)."""
    return df.select(*keep, F.posexplode(ranked_indices(probs)).alias("rank", "class"))


def label_of(df: DataFrame, idx: str, index: DataFrame, label: str) -> DataFrame:
    """Index → label name through the (small, bounded by the class count)
    class index table (ARR3)."""
    return df.join(index.withColumnRenamed("class_index", idx), on=idx, how="left")
