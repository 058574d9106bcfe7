"""Joins (JN*) and the lookup-table helpers used by them.

Join strategy is left to Catalyst and AQE for every side, lookup tables
included: a side is broadcast only when its size is under
``spark.sql.autoBroadcastJoinThreshold`` (a checked size); skewed partitions
of a sort-merge join are split otherwise.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def fixed_table(spark: SparkSession, rows, schema: str) -> DataFrame:
    """A driver-supplied lookup table (stop words, lexicons, bin labels) as a
    local relation.  It carries no hint: the planner knows the size of such a
    relation, so a join with one under the session's threshold is planned as a
    broadcast at once, and the other side is not shuffled."""
    rows, schema = list(rows), StructType.fromDDL(schema)
    arrow = to_arrow_schema(schema)
    columns = [pa.array([r[i] for r in rows], f.type) for i, f in enumerate(arrow)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=arrow), schema)


def join_daily(a: DataFrame, b: DataFrame, keys=("location", "date")) -> DataFrame:
    """Inner equi-join of two daily tables on (location, date) (JN1)."""
    return a.join(b, on=list(keys), how="inner")


def fill_candidates(df: DataFrame, group: str, id_col: str, col: str) -> DataFrame:
    """For every row whose ``col`` is null: how many other rows of its group
    could fill it, how many of those hold a value, and the value chosen
    (the one of the smallest id) (JN2).

    The script lists every (row, partner) pair of a self-join; a group of n
    rows with k nulls gives k*(n-1) pairs.  Here one grouped aggregate and
    one join on the group key give the same facts per null row, with no pair
    ever built.
    """
    per_group = df.groupBy(group).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count(col).alias("_nn"),
        F.min_by(F.col(col), F.when(F.col(col).isNotNull(), F.col(id_col))).alias("_fill"))
    nulls = df.filter(F.col(col).isNull()).select(group, id_col, col)
    out = nulls.join(per_group, on=group, how="inner")
    return out.select(
        group, id_col, col,
        (F.col("_n") - 1).cast("bigint").alias("n_partners"),
        F.col("_nn").cast("bigint").alias("n_partners_with_value"),
        F.col("_fill").alias("fill_value"),
        F.coalesce(F.col(col), F.col("_fill")).alias("filled"))


def fill_from_group(df: DataFrame, group: str, id_col: str, col: str) -> DataFrame:
    """Fill nulls of ``col`` from another row of the same group: the non-null
    value of the smallest id (JN3).

    Written as an aggregate joined back on the group key (partial aggregation
    collapses a hot group before the shuffle) instead of a window that would
    hold a whole group in one task."""
    fills = df.filter(F.col(col).isNotNull()).groupBy(group).agg(
        F.min_by(F.col(col), F.col(id_col)).alias("_fill"))
    return (df.join(fills, on=group, how="left")
            .withColumn(col, F.coalesce(F.col(col), F.col("_fill")))
            .drop("_fill").select(*df.columns))


def merge_on(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Merge two aggregates on one key (JN4)."""
    return a.join(b, on=key, how="inner")


def attach(left: DataFrame, right: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Foreign-key lookup, e.g. rental → car (JN5).  AQE picks the strategy."""
    return left.join(right, on=key, how=how)


def describe_tag(df: DataFrame, tags: DataFrame, key: str = "tag") -> DataFrame:
    """Map code → description, unmapped → null (JN6)."""
    return df.join(tags, on=key, how="left")


def side_by_side(ranked: DataFrame, list_col: str, rank_col: str, value_col: str,
                 names, n: int | None = None) -> DataFrame:
    """Positional column-wise concat of ranked lists (JN7): one output row per
    rank, one column per list, null where a list is shorter.  A pivot by
    conditional aggregation; no join per list."""
    src = ranked if n is None else ranked.filter(F.col(rank_col) <= n)
    aggs = [F.max(F.when(F.col(list_col) == nm, F.col(value_col))).alias(nm) for nm in names]
    return src.groupBy(rank_col).agg(*aggs)
