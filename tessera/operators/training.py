"""Softmax layer trained by mini-batches (ML2, ML3): Adam, dropout on the
features, and the loss of training and validation rows after every epoch.

The rows are written once, in a folder per batch, so a step reads its batch
only.  A step is one pass: tasks add up the gradient of their rows, and one
aggregate by position adds up the tasks, so what reaches the driver has the
size of the weights and no row ever does.  Batches and dropout follow from
hashes of the row's key, so a run repeats itself.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


@dataclass
class Softmax:
    """``weights[class, feature]``, ``bias[class]`` and a row of ``history`` per
    epoch: ``epoch``, ``loss`` and ``accuracy`` over the training rows as they
    were met (null for epoch 0, before any step), ``val_loss``,
    ``val_accuracy``, ``n_train``, ``n_validation``."""
    weights: np.ndarray
    bias: np.ndarray
    history: list = field(default_factory=list)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def dropout(keys: np.ndarray, n: int, step: int, rate: float, seed: int) -> np.ndarray:
    """Factors of the features of rows in a step: 0 for a share ``rate`` of
    them, chosen by hash, and 1 / (1 - rate) for the rest."""
    if rate <= 0:
        return np.ones((len(keys), n))
    row = mixed(keys.astype(np.int64).view(np.uint64) + np.uint64((seed * 1_000_003 + step) & (2 ** 63 - 1)))
    cell = mixed(row[:, None] + np.arange(1, n + 1, dtype=np.uint64)[None, :]
                 * np.uint64(0x9E3779B97F4A7C15))
    kept = (cell >> np.uint64(11)).astype(np.float64) / 2.0 ** 53 >= rate
    return kept / (1.0 - rate)


def gradient(x: np.ndarray, y: np.ndarray, weights: np.ndarray, bias: np.ndarray):
    """Sums over rows: loss, hits, and the gradient of the loss by weights and
    bias."""
    z = x @ weights.T + bias
    z -= z.max(1, keepdims=True)
    p = np.exp(z)
    p /= p.sum(1, keepdims=True)
    at = np.arange(len(y))
    loss = -np.log(np.maximum(p[at, y], 1e-300)).sum()
    hits = float((p.argmax(1) == y).sum())
    p[at, y] -= 1.0
    return loss, hits, p.T @ x, p.sum(0)


def sums(rows: DataFrame, weights: np.ndarray, bias: np.ndarray, step: int = 0, rate: float = 0.0,
         seed: int = 0) -> tuple[int, float, float, np.ndarray, np.ndarray]:
    """Rows, loss, hits and gradients over all rows of (``k``, ``x``, ``y``)."""
    classes, n = weights.shape

    def run(batches):
        total = np.zeros(3 + classes * n + classes)
        for b in batches:
            if not b.num_rows:
                continue
            keys, y = b.column(0).to_numpy(), b.column(2).to_numpy().astype(np.int64)
            x = b.column(1).flatten().to_numpy(zero_copy_only=False).reshape(-1, n)
            loss, hits, gw, gb = gradient(x * dropout(keys, n, step, rate, seed), y, weights, bias)
            total += np.concatenate([[len(y), loss, hits], gw.ravel(), gb])
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(total)), pa.int32()), pa.array(total)], names=["at", "v"])

    out = np.zeros(3 + classes * n + classes)
    parts = rows.select("k", "x", "y").mapInArrow(run, "at int, v double")
    for r in parts.groupBy("at").agg(F.sum("v").alias("v")).collect():
        out[r["at"]] = r["v"]
    return int(out[0]), float(out[1]), float(out[2]), out[3:3 + classes * n].reshape(classes, n), out[3 + classes * n:]


def prepared(df: DataFrame, features: str, label: str, key: str, validation: str, n_batches: int,
             seed: int) -> DataFrame:
    """The usable rows (key, features, label; none null, no null feature),
    written in a folder per batch; validation rows are batch -1."""
    x = F.col(f"`{features}`").cast("array<double>")
    rows = df.select(F.col(f"`{key}`").cast("long").alias("k"), x.alias("x"),
                     F.col(f"`{label}`").cast("int").alias("y"),
                     F.coalesce(F.col(f"`{validation}`"), F.lit(False)).alias("held"))
    rows = rows.where("k IS NOT NULL AND x IS NOT NULL AND y IS NOT NULL") \
        .where(~F.exists("x", lambda v: v.isNull()))
    batch = F.when(F.col("held"), F.lit(-1)).otherwise(F.pmod(F.xxhash64("k", F.lit(seed)), F.lit(n_batches)))
    path = scratch_path(df.sparkSession, "batches")
    rows = rows.select("k", "x", "y", batch.cast("int").alias("batch"))
    rows.write.partitionBy("batch").parquet(path)
    return df.sparkSession.read.schema(rows.schema).parquet(path)


def fit_softmax(df: DataFrame, classes: int, features: str = "features", label: str = "label",
                key: str = "id", validation: str = "is_validation", epochs: int = 10,
                n_batches: int = 8, rate: float = 0.4, learning_rate: float = 1e-3,
                seed: int = 0) -> Softmax:
    """Train on the rows that are not for validation, starting from zero.

    Every epoch meets the batches in another order (by ``seed``); the steps are
    Adam's (0.9, 0.999, 1e-7).  Labels are 0 to ``classes`` - 1; rows with a
    null key, label or feature are left out.  Batches without rows are skipped;
    without any row the weights stay zero."""
    data = prepared(df, features, label, key, validation, n_batches, seed)
    n = data.agg(F.max(F.size("x"))).first()[0] or 0
    held = data.where("batch = -1")
    model = Softmax(np.zeros((classes, n)), np.zeros(classes))
    first, second = np.zeros(classes * n + classes), np.zeros(classes * n + classes)

    def measured(epoch, seen, loss, hits):
        m, vl, vh, _, _ = sums(held, model.weights, model.bias)
        model.history.append({
            "epoch": epoch, "n_train": seen, "n_validation": m,
            "loss": loss / seen if epoch and seen else None,
            "accuracy": hits / seen if epoch and seen else None,
            "val_loss": vl / m if m else None, "val_accuracy": vh / m if m else None})
    measured(0, data.where("batch >= 0").count(), 0.0, 0.0)
    step, orders = 0, np.random.default_rng(seed)
    for epoch in range(1, epochs + 1):
        seen, loss, hits = 0, 0.0, 0.0
        for b in orders.permutation(n_batches):
            rows = data.where(F.col("batch") == int(b))
            m, one, hit, gw, gb = sums(rows, model.weights, model.bias, step + 1, rate, seed)
            if not m:
                continue
            step += 1
            seen, loss, hits = seen + m, loss + one, hits + hit
            g = np.concatenate([gw.ravel(), gb]) / m
            first = 0.9 * first + 0.1 * g
            second = 0.999 * second + 0.001 * g * g
            move = learning_rate * (first / (1 - 0.9 ** step)) / (
                np.sqrt(second / (1 - 0.999 ** step)) + 1e-7)
            model.weights = model.weights - move[:classes * n].reshape(classes, n)
            model.bias = model.bias - move[classes * n:]
        measured(epoch, seen, loss, hits)
    return model


def probabilities(x, weights, bias) -> Column:
    """Class probabilities of a feature array under fixed weights: array
    functions only."""
    x = (F.col(x) if isinstance(x, str) else x).cast("array<double>")
    rows = F.array(*[F.struct(F.array(*[F.lit(float(v)) for v in w]).alias("w"),
                              F.lit(float(b)).alias("b")) for w, b in zip(weights, bias)])
    z = F.transform(rows, lambda r: F.aggregate(
        F.zip_with(x, r["w"], lambda a, c: a * c), F.lit(0.0), lambda s, v: s + v) + r["b"])
    up = F.transform(z, lambda v: F.exp(v))
    return F.transform(up, lambda v: v / F.aggregate(up, F.lit(0.0), lambda s, e: s + e))
