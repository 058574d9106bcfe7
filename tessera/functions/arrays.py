"""Array column functions (ARR*, SRT7)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import _c


def argmax(c) -> Column:
    """0-based index of the largest element; the first one on ties (ARR2)."""
    c = _c(c)
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


def ranked_indices(c) -> Column:
    """Element indices ordered by value descending, ties by index (SRT7)."""
    c = _c(c)
    pairs = F.transform(c, lambda x, i: F.struct((-x).alias("n"), i.alias("i")))
    return F.transform(F.array_sort(pairs), lambda s: s["i"])


def is_correct(pred, truth) -> Column:
    """Prediction equals the true class (ARR5)."""
    return _c(pred) == _c(truth)
