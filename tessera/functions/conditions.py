"""Validation predicates of the billing rules (CND*)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import _c


def valid_card(c) -> Column:
    """Card number without blanks is exactly 16 digits (CND2); null is not."""
    return F.coalesce(F.replace(_c(c), F.lit(" "), F.lit("")).rlike(r"^[0-9]{16}$"), F.lit(False))


def expiry_status(c, as_of, allow_slash: bool = True) -> Column:
    """MMYY expiry check (CND3): ``bad_format`` (null too) / ``bad_month`` /
    ``expired`` / ``ok``.

    The year is compared as two digits with the two-digit year of ``as_of``;
    the card is still valid in its own expiry month.
    """
    if isinstance(as_of, str):
        as_of = _dt.date.fromisoformat(as_of)
    e = F.trim(_c(c))
    if allow_slash:
        e = F.replace(e, F.lit("/"), F.lit(""))
    month = F.substring(e, 1, 2).try_cast("int")
    year = F.substring(e, 3, 2).try_cast("int")
    cy, cm = as_of.year % 100, as_of.month
    return (F.when(~F.coalesce(e.rlike(r"^[0-9]{4}$"), F.lit(False)), "bad_format")
            .when((month < 1) | (month > 12), "bad_month")
            .when((year < cy) | ((year == cy) & (month < cm)), "expired")
            .otherwise("ok"))


def valid_cvv(c) -> Column:
    """Three digits with value ≥ 100 (CND4); null is not."""
    return F.coalesce(F.trim(_c(c)).rlike(r"^[1-9][0-9]{2}$"), F.lit(False))
