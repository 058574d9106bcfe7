"""Projections, filters, sorts, limits and set operations (PRJ*, FLT*, SRT*, SET*)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import _c


# -- projections ------------------------------------------------------------

def with_ratio(df: DataFrame, num, den, out: str) -> DataFrame:
    """Derived percent column ``num / den * 100`` (PRJ2, PRJ3)."""
    from ..functions.numeric import percent
    return df.withColumn(out, percent(num, den))


def drop_columns(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns (PRJ4)."""
    return df.drop(*cols)


def set_column(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Add or overwrite a column from an expression (PRJ6).

    The SQL script altered the stored table; a DataFrame is immutable, so the
    result is a new DataFrame with the column set."""
    return df.withColumn(name, expr)


def update_where(df: DataFrame, name: str, expr: Column, cond: Column) -> DataFrame:
    """Set ``name`` to ``expr`` on rows meeting ``cond`` only (PRJ7)."""
    return df.withColumn(name, F.when(cond, expr).otherwise(F.col(name)))


# -- filters ----------------------------------------------------------------

def where_not_null(df: DataFrame, c) -> DataFrame:
    """FLT1."""
    return df.filter(_c(c).isNotNull())


def where_null(df: DataFrame, c) -> DataFrame:
    """FLT2."""
    return df.filter(_c(c).isNull())


def where_contains_ci(df: DataFrame, c, text: str) -> DataFrame:
    """Case-insensitive substring match, as ``LIKE '%x%'`` under a
    case-insensitive collation (FLT3); ``_`` and ``%`` in ``text`` stand for
    themselves."""
    return df.filter(F.contains(F.lower(_c(c)), F.lower(F.lit(text))))


def drop_incomplete(df: DataFrame, subset: Iterable[str] | None = None) -> DataFrame:
    """Drop rows with a null in any (or the given) column (FLT7, FLT8)."""
    return df.dropna(how="any", subset=list(subset) if subset else None)


def with_tag_prefix(df: DataFrame, c, prefix: str) -> DataFrame:
    """Rows whose tag starts with ``prefix`` (FLT9)."""
    return df.filter(_c(c).startswith(prefix))


def lookup(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Fetch the record of each requested id; misses are kept and flagged (FLT10).

    ``ids`` holds the requested keys.  A left join keeps every request; the
    join is left to AQE (broadcast when a side turns out small)."""
    right = df.withColumn("_found", F.lit(True))
    return (ids.join(right, on=key, how="left")
            .withColumn("found", F.coalesce(F.col("_found"), F.lit(False)))
            .drop("_found"))


# -- sorts and limits -------------------------------------------------------

def order_by(df: DataFrame, *cols, ascending=True) -> DataFrame:
    """Sort (SRT1-3); ascending puts nulls first, as the server does."""
    return df.orderBy(*cols, ascending=ascending)


def first_rows(df: DataFrame, keys, n: int = 5) -> DataFrame:
    """First ``n`` rows in key order (PRF1): a distributed top-k, not a collect."""
    return df.orderBy(*[_c(k).asc() for k in keys]).limit(n)


def last_rows(df: DataFrame, keys, n: int = 5) -> DataFrame:
    """Last ``n`` rows in key order (PRF2)."""
    return df.orderBy(*[_c(k).desc() for k in keys]).limit(n)


def top_k(df: DataFrame, by, k: int, tiebreak=()) -> DataFrame:
    """Top ``k`` rows by ``by`` descending, ties by ``tiebreak`` ascending (SRT4)."""
    return df.orderBy(_c(by).desc(), *[_c(t).asc() for t in tiebreak]).limit(k)


def with_rank(df: DataFrame, order: list, name: str = "rank") -> DataFrame:
    """Position of each row in a total order (1, 2, ...).

    A window without partition keys runs in one task, so this is applied
    only to results already cut to k rows (top-k outputs)."""
    from pyspark.sql import Window
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))


# -- set operations ---------------------------------------------------------

def union_by_name(*dfs: DataFrame) -> DataFrame:
    """Union by column name, missing columns null (SET1)."""
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d, allowMissingColumns=True)
    return out


def drop_duplicates(df: DataFrame, subset=None) -> DataFrame:
    """Remove fully duplicate rows (SET2); a hash aggregate with map-side combine."""
    return df.dropDuplicates(subset) if subset else df.dropDuplicates()


def distinct(df: DataFrame, *cols: str) -> DataFrame:
    """SET3."""
    return df.select(*cols).distinct()
