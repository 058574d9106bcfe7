"""Window operators written so that one hot partition key cannot pin a third
of the data on one task (WIN1, WIN2, SET4, FLT5).

* ``running_total`` pre-aggregates to one row per (partition, order) value,
  runs the window on that compact table and joins the running value back;
  an input that is compact already is windowed directly.
* ``number_rows`` deals the rows out by range and numbers them per piece; a
  group is never processed by one task as a whole, yet the numbers are exact.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.strings import _c
from ..session import stored


def _null_safe_on(left: DataFrame, right: DataFrame, cols, prefix: str) -> Column:
    cond = None
    for c in cols:
        e = left[c].eqNullSafe(right[prefix + c])
        cond = e if cond is None else cond & e
    return cond


def running_total(df: DataFrame, part, order, value, out: str,
                  cast: str | None = "int", one_row_per_key: bool = False) -> DataFrame:
    """``sum(value) over (partition by part order by order)`` with the default
    RANGE frame: rows with equal order values share the running value, nulls
    are skipped, leading nulls give null (WIN1).

    Rows are reduced to one per (partition, order) value, the window runs over
    that compact table, and the running values are joined back, so a hot
    partition costs no more than it has distinct order values.
    ``one_row_per_key`` states that ``df`` is such a compact table already
    (e.g. a join of daily tables); the window then runs on it directly."""
    part = [part] if isinstance(part, str) else list(part)
    order = [order] if isinstance(order, str) else list(order)
    v = _c(value)
    if cast:
        v = v.try_cast(cast)
    v = v.cast("bigint") if cast in ("int", "integer", "bigint") else v
    window = Window.partitionBy(*part).orderBy(*order)
    if one_row_per_key:
        return df.withColumn(out, F.sum(v).over(window))
    keys = list(dict.fromkeys(part + order))
    compact = df.groupBy(*keys).agg(F.sum(v).alias("_s"))
    w = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = compact.select(*[F.col(k).alias("_k_" + k) for k in keys],
                             F.sum("_s").over(w).alias(out))
    joined = df.join(running, _null_safe_on(df, running, keys, "_k_"), "left")
    return joined.drop(*["_k_" + k for k in keys])


def running_total_by_range(df: DataFrame, part, order, value, out: str) -> DataFrame:
    """``sum(value) over (partition by part order by order)`` (RANGE frame,
    nulls skipped, leading nulls give null), for partitions with any number of
    different order values (WIN1).

    Rows are reduced to one per (partition, order) value, which keeps ties
    whole, and dealt out by one range exchange on them, so a hot partition lies
    in many pieces.  Each piece is summed up on its own; what a partition has
    before a piece is a running sum over one row per piece.  Null partition and
    order values are values like others, nulls in ``order`` come first."""
    part = [part] if isinstance(part, str) else list(part)
    order = [order] if isinstance(order, str) else list(order)
    keys = list(dict.fromkeys(part + order))
    compact = df.groupBy(*keys).agg(F.sum(_c(value)).alias("_s"))
    pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(compact.repartitionByRange(pieces, *[F.col(k).asc_nulls_first() for k in part + order])
                   .withColumn("_pid", F.spark_partition_id()), "running_total")
    ends = dealt.groupBy(*part, "_pid").agg(F.sum("_s").alias("_p"))
    before = Window.partitionBy(*part).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ends.select(*[F.col(k).alias("_o_" + k) for k in part], F.col("_pid").alias("_o_pid"),
                          F.sum("_p").over(before).alias("_off"))
    inside = (Window.partitionBy("_pid", *part).orderBy(*[F.col(k).asc_nulls_first() for k in order])
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = dealt.withColumn("_in", F.sum("_s").over(inside))
    same = (local["_pid"] == offsets["_o_pid"]) & _null_safe_on(local, offsets, part, "_o_")
    total = F.when(F.col("_off").isNull(), F.col("_in")).when(F.col("_in").isNull(), F.col("_off")) \
        .otherwise(F.col("_off") + F.col("_in"))
    running = local.join(offsets, same).select(*[F.col(k).alias("_k_" + k) for k in keys], total.alias(out))
    joined = df.join(running, _null_safe_on(df, running, keys, "_k_"), "left")
    return joined.drop(*["_k_" + k for k in keys])


def number_rows(df: DataFrame, keys, order: str, out: str = "row_num") -> DataFrame:
    """``row_number() over (partition by keys order by order)`` (WIN2); nulls
    in ``keys`` form one group and null ``order`` values come first, as in SQL.

    One range exchange on (keys, order) deals the rows out in order, so a
    group that holds a third of all rows is spread over many pieces.  Rows are
    numbered per (piece, group); only the group at the start of a piece can go
    on from earlier pieces, and its offset is the sum of the lengths it has at
    their ends: one row per piece, whatever the number of groups."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    names = df.columns
    pieces = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = stored(df.repartitionByRange(pieces, *[F.col(k).asc_nulls_first() for k in [*keys, order]])
                   .withColumn("_pid", F.spark_partition_id()), "row_numbers")
    local = dealt.withColumn(
        "_rn", F.row_number().over(Window.partitionBy("_pid", *keys).orderBy(order)))
    key = F.struct(*[F.col(k) for k in keys])
    ends = local.groupBy("_pid").agg(F.min(key).alias("_first"),
                                     F.max(F.struct(key.alias("k"), F.col("_rn").alias("n"))).alias("e"))
    events = (ends.select("_pid", F.col("e.k").alias("_k"), F.col("e.n").cast("long").alias("n"),
                          F.lit(False).alias("asks"))
              .unionByName(ends.select("_pid", F.col("_first").alias("_k"), F.lit(0).cast("long").alias("n"),
                                       F.lit(True).alias("asks"))))
    before = Window.partitionBy("_k").orderBy("_pid").rangeBetween(Window.unboundedPreceding, -1)
    offsets = (events.withColumn("_off", F.coalesce(F.sum("n").over(before), F.lit(0)))
               .where("asks").select("_pid", "_k", "_off"))
    joined = local.join(offsets, "_pid")
    number = F.col("_rn") + F.when(key.eqNullSafe(F.col("_k")), F.col("_off")).otherwise(F.lit(0))
    return joined.select(*[F.col(f"`{c}`") for c in names if c != out], number.cast("int").alias(out))


def duplicates(df: DataFrame, keys, order: str, out: str = "row_num") -> DataFrame:
    """Rows that repeat an earlier row's keys, with their number (FLT5)."""
    return number_rows(df, keys, order, out).filter(F.col(out) > 1)


def dedupe_by_key(df: DataFrame, keys, order: str) -> DataFrame:
    """Keep the first row of each key group by ``order`` (SET4).

    One aggregate with map-side combine: ``min_by`` keeps the whole row of
    the smallest ``order`` value, so a hot group collapses before the shuffle.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*[F.col(c) for c in rest])
    kept = df.groupBy(*keys).agg(F.min_by(row, F.col(order)).alias("_row"))
    return kept.select(*keys, *[F.col("_row")[c].alias(c) for c in rest]).select(*df.columns)
