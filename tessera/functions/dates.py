"""Date column functions (DT*)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import _c


def to_date(c, fmt: str | None = None) -> Column:
    """Timestamp or text → date (DT1, DT2)."""
    return F.to_date(_c(c), fmt) if fmt else F.to_date(_c(c))


def rental_days(start, end) -> Column:
    """Inclusive day span ``(end - start).days + 1`` (DT4)."""
    return F.datediff(_c(end), _c(start)) + 1


def month_end(c) -> Column:
    """Last day of the month of a date (DT5)."""
    return F.last_day(_c(c))


def review_date(c, as_of) -> Column:
    """Relative date text → date (DT3).

    ``n week(s)`` and ``n day(s)`` count back from ``as_of`` (weeks win over
    days), ``yesterday`` / ``today`` are exact words, anything else is read as
    ``5 March 2019``; text that fits none of these gives null.
    """
    c = _c(c)
    if isinstance(as_of, (str, _dt.date)):
        as_of = F.lit(str(as_of)).cast("date")
    n = F.regexp_extract(c, r"\d+", 0).try_cast("int")
    return (F.when(c.rlike(r"\bweeks?\b"), F.date_sub(as_of, n * 7))
            .when(c.rlike(r"\bdays?\b"), F.date_sub(as_of, n))
            .when(c == "yesterday", F.date_sub(as_of, 1))
            .when(c == "today", as_of)
            .otherwise(F.try_to_date(c, "d MMMM yyyy")))
