"""Stored partitioned tables changed in place (PRJ6, PRJ7, SINK3): an update
rewrites the partitions that hold a changed row and no other file."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_stored(df: DataFrame, path: str, by: Sequence[str]) -> None:
    """``df`` as Parquet files in one folder per value of ``by``.  Rows are
    rebalanced on ``by`` first, so a value has few files, and a value with
    many rows is split over several tasks."""
    df.hint("rebalance", *by).write.mode("overwrite").partitionBy(*by).parquet(path)


def read_stored(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """The table under its declared schema: folder values keep the declared
    type (``01`` stays a string)."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return spark.read.schema(schema).parquet(path).select(*[f"`{f.name}`" for f in schema])


def update_stored(spark: SparkSession, path: str, schema: T.StructType | str, by: Sequence[str],
                  changes: Mapping[str, Column], where: Column, using: DataFrame | None = None,
                  on: Sequence[str] = ()) -> list[tuple]:
    """``UPDATE table SET … [FROM using] WHERE …`` on the files under ``path``;
    returns the values of ``by`` whose folders were rewritten.

    A first scan (only the columns of the condition) finds the folders that
    hold a row meeting ``where``; only these are read whole and written anew,
    by Spark's committer with dynamic partition overwrite: new files are
    staged and take the place of the folders when the job commits, so lost
    tasks are repeated on unchanged data and a failed job before that leaves
    the table as it was.  Folder values are listed on the driver, as the scan
    itself does.

    ``using`` is joined on the columns ``on``, which have to be unique in it;
    its other columns may stand in ``where`` and ``changes``, and must not
    share a name with the table's.  It may be derived from the table.  Rows on
    which ``where`` is null are not changed, new values are cast to the declared
    type, and ``where`` has to give the same answer each time.  Columns of
    ``by`` cannot be changed: their rows would move.  Null folder values are
    values like others (Spark stores empty strings as null there).  A table
    without a row to change is not touched."""
    schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    unknown = [c for c in (*changes, *by) if c not in schema.names]
    if unknown or set(changes) & set(by):
        raise ValueError(f"not in the table: {unknown}; partition columns to change: "
                         f"{sorted(set(changes) & set(by))}")
    rows = read_stored(spark, path, schema)
    if using is not None:
        clash = (set(using.columns) & set(schema.names)) - set(on)
        if clash or not on:
            raise ValueError(f"join columns {list(on)}; names on both sides: {sorted(clash)}")
        twice = using.dropna(subset=list(on)).groupBy(*on).count().where("count > 1")
        if not twice.isEmpty():
            raise ValueError(f"{list(on)} are not unique in the rows to update from")
        rows = rows.join(using, list(on), "left")
    touched = [tuple(r) for r in rows.where(where).select(*by).distinct().collect()]
    if not touched:
        return []
    inside = _any([_all([F.col(f"`{c}`").eqNullSafe(F.lit(v)) for c, v in zip(by, values)])
                   for values in touched])
    changed = rows.where(inside).select(*[
        (F.when(where, changes[f.name].cast(f.dataType)).otherwise(F.col(f"`{f.name}`"))
         if f.name in changes else F.col(f"`{f.name}`")).alias(f.name) for f in schema])
    (changed.hint("rebalance", *by).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path))
    spark.catalog.refreshByPath(path)
    return sorted(touched, key=lambda t: [(v is not None, v) for v in t])


def _all(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def _any(conds: list[Column]) -> Column:
    """A balanced tree, which stays shallow for thousands of folders."""
    if len(conds) == 1:
        return conds[0]
    half = len(conds) // 2
    return _any(conds[:half]) | _any(conds[half:])
