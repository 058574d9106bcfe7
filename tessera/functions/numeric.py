"""Numeric column functions (PRJ3, NUM*)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import _c


def percent(num, den) -> Column:
    """``num / den * 100`` with text operands accepted and ÷0 → null (PRJ3)."""
    return F.try_divide(_c(num).try_cast("double"), _c(den).try_cast("double")) * 100


def to_number(c) -> Column:
    """Numeric coercion, unparsable → null (NUM2)."""
    return _c(c).try_cast("double")


def to_int_trunc(c) -> Column:
    """Text/float → int by truncation toward zero (NUM1)."""
    return to_number(c).try_cast("int")


def cast_int(c, strict: bool = False) -> Column:
    """Text → int (NUM3); ``strict`` raises on bad input as a server cast does."""
    return _c(c).cast("int") if strict else _c(c).try_cast("int")


def deposit(total, mode: str = "floor") -> Column:
    """A third of the total: floored in invoices, exact on the quote screen (NUM4)."""
    t = _c(total)
    if mode == "floor":
        return F.floor(t / 3).cast("decimal(12,2)")
    return t / 3


def rescale(arr, factor: float) -> Column:
    """Multiply every array element by ``factor`` (NUM5)."""
    return F.transform(_c(arr), lambda x: x * F.lit(factor))


def bin_index(c, width: int = 200, nbins: int = 10) -> Column:
    """Left-closed bin number of width ``width``; outside [0, width*nbins) → null (NUM6)."""
    c = _c(c)
    return F.when((c >= 0) & (c < width * nbins), F.floor(c / width).cast("int"))


def bin_label(idx, width: int = 200) -> Column:
    """Label of a word-count bin; the first bin starts at 0, the others at lo+1."""
    i = _c(idx)
    lo = F.when(i == 0, F.lit(0)).otherwise(i * width + 1)
    return F.concat(lo.cast("string"), F.lit("-"), ((i + 1) * width).cast("string"))


def sentiment_label(c) -> Column:
    """>3 Positive, <3 Negative, =3 Neutral (NUM7)."""
    c = _c(c)
    return F.when(c > 3, "Positive").when(c < 3, "Negative").when(c == 3, "Neutral")


def parse_or_default(c, dtype: str, default) -> Column:
    """Blank → default, else typed parse; unparsable → null (NUM8)."""
    t = F.nullif(F.trim(_c(c)), F.lit(""))
    return F.when(t.isNull(), F.lit(default).cast(dtype)).otherwise(t.try_cast(dtype))


def parse_error(c, dtype: str) -> Column:
    """True where a non-blank input does not parse as ``dtype`` (NUM8)."""
    t = F.nullif(F.trim(_c(c)), F.lit(""))
    return t.isNotNull() & t.try_cast(dtype).isNull()


def batches(n, size: int) -> Column:
    """Number of batches of ``size`` covering ``n`` rows (NUM9)."""
    return F.ceil(_c(n) / F.lit(size)).cast("bigint")
