"""Order-insensitive comparison of query results from Spark and DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math


import os

STRICT = os.environ.get("COMPARE_STRICT") == "1"


def norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return v if STRICT else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return float(v) if STRICT else round(float(v), 6)
    if isinstance(v, dt.datetime):
        return v.isoformat(sep=" ")
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, norm(x)) for k, x in v.items()))
    if isinstance(v, bool):
        return int(v)
    return v


def rows_of(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted((tuple(repr(norm(r[i])) for i in order) for r in rows))
