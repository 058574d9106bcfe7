"""Mini-batch training equals the same run in NumPy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import training as N


def plain(keys, x, y, batch, held, classes, epochs, n_batches, rate, lr, seed):
    """Adam over the batches in one process; losses per epoch."""
    w, b = np.zeros((classes, x.shape[1])), np.zeros(classes)
    mw, vw, mb, vb = np.zeros_like(w), np.zeros_like(w), np.zeros_like(b), np.zeros_like(b)

    def probs(x):
        e = np.exp(x @ w.T + b)
        return e / e.sum(1, keepdims=True)

    def loss(x, y):
        return -np.log(probs(x)[np.arange(len(y)), y])
    out, t, order = [(None, loss(x[held], y[held]).mean())], 0, np.random.default_rng(seed)
    for _ in range(epochs):
        losses = []
        for k in order.permutation(n_batches):
            rows = ~held & (batch == k)
            if not rows.any():
                continue
            t += 1
            xs = x[rows] * N.dropout(keys[rows], x.shape[1], t, rate, seed)
            losses.append(loss(xs, y[rows]))
            d = probs(xs) - np.eye(classes)[y[rows]]
            for value, g, m, v in ((w, d.T @ xs / len(xs), mw, vw), (b, d.mean(0), mb, vb)):
                m *= 0.9
                m += 0.1 * g
                v *= 0.999
                v += 0.001 * g ** 2
                value -= lr * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-7)
        out.append((np.concatenate(losses).mean(), loss(x[held], y[held]).mean()))
    return w, b, out


@pytest.mark.parametrize("rate", [0.0, 0.4])
def test_losses_equal_numpy(spark, rate):
    rng = np.random.default_rng(1)
    n, classes = 240, 3
    y = rng.integers(0, classes, n)
    x = rng.normal(size=(n, 5)) + y[:, None]
    held = np.arange(n) % 5 == 0
    rows = [(int(i) - 100, x[i].tolist(), int(y[i]), bool(held[i])) for i in range(n)]
    schema = "id long, features array<double>, label int, is_validation boolean"
    df = spark.createDataFrame(rows + [(None, [1.0] * 5, 1, False), (9000, None, 1, False),
                                       (9001, [1.0, None, 1.0, 1.0, 1.0], 1, True),
                                       (9002, [1.0] * 5, None, False)], schema).repartition(3)
    batch = {r.id: r.b for r in df.select("id", F.pmod(F.xxhash64("id", F.lit(7)), F.lit(4)).alias("b"))
             .collect()}
    keys = np.array([r[0] for r in rows])
    b = np.array([batch[k] for k in keys])
    model = N.fit_softmax(df, classes, epochs=3, n_batches=4, rate=rate, learning_rate=0.05, seed=7)
    w, bias, exp = plain(keys, x, y, b, held, classes, 3, 4, rate, 0.05, 7)
    assert np.allclose(model.weights, w, atol=1e-9) and np.allclose(model.bias, bias, atol=1e-9)
    for h, (loss, val) in zip(model.history, exp, strict=True):
        assert h["val_loss"] == pytest.approx(val, abs=1e-9)
        assert h["loss"] == (loss if loss is None else pytest.approx(loss, abs=1e-9))
    assert model.history[-1]["val_loss"] < model.history[0]["val_loss"]
    p = spark.createDataFrame([(x[0].tolist(),)], "x array<double>").select(
        N.probabilities("x", model.weights, model.bias).alias("p")).first().p
    e = np.exp(w @ x[0] + bias)
    assert np.allclose(p, e / e.sum())


def test_no_rows(spark):
    df = spark.createDataFrame([], "id long, features array<double>, label int, is_validation boolean")
    model = N.fit_softmax(df, 2, epochs=1, n_batches=2)
    assert model.weights.shape == (2, 0) and model.history[-1]["val_loss"] is None


def test_dropout_keeps_the_mean():
    m = N.dropout(np.arange(2000), 50, 3, 0.4, 1)
    assert abs(m.mean() - 1) < 0.01 and set(np.unique(m)) == {0.0, 1 / 0.6}
    assert not np.array_equal(m, N.dropout(np.arange(2000), 50, 4, 0.4, 1))
