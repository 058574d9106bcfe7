"""Inspection and profiling (PRF*)."""

from __future__ import annotations

import math

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NUMERIC = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType,
           T.DoubleType, T.DecimalType)
INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
SKETCH_K = 4096            # size of the quantile sketches; decides the work, not the result


def row_count(df: DataFrame, out: str = "n") -> DataFrame:
    """PRF5."""
    return df.agg(F.count(F.lit(1)).cast("bigint").alias(out))


def distinct_count(df: DataFrame, c: str, out: str = "n_distinct",
                   count_null: bool = True) -> DataFrame:
    """Distinct values of a column; null counts as one value when present,
    as ``Series.unique()`` does (PRF6)."""
    n = F.count_distinct(c)
    if count_null:
        n = n + F.max(F.col(c).isNull().cast("int"))
    return df.agg(n.cast("bigint").alias(out))


def batch_shape(df: DataFrame, order: str, n: int, arr: str) -> DataFrame:
    """Rows in the first batch of ``n`` and the length of its arrays (PRF7)."""
    first = df.orderBy(order).limit(n)
    return first.agg(F.count(F.lit(1)).cast("bigint").alias("batch_rows"),
                     F.max(F.size(arr)).cast("int").alias("array_len"))


def schema_summary(df: DataFrame) -> DataFrame:
    """``info()``: column name, type and non-null count, one pass (PRF4)."""
    counts = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns])
    parts = ", ".join(f"'{f.name}', '{f.dataType.simpleString()}', CAST(`{f.name}` AS BIGINT)"
                      for f in df.schema.fields)
    return counts.selectExpr(f"stack({len(df.columns)}, {parts}) AS (column, type, non_null)")


def exact_quantiles(df: DataFrame, c: str, probs, buckets: int = 4096) -> list:
    """Exact quantiles of one column with linear interpolation (pandas'
    default); see ``exact_quantiles_of``."""
    return exact_quantiles_of(df, [c], probs, buckets)[c]


def exact_quantiles_of(df: DataFrame, cols, probs, buckets: int = 4096,
                       k: int = SKETCH_K) -> dict[str, list]:
    """Exact quantiles of several numeric columns, null and NaN left out: two
    scans of ``df``, whatever the range of the values.

    The first scan builds one mergeable KLL sketch per column (``k`` numbers a
    level, so its size hardly grows with the rows), with counts and extremes;
    the sketch brackets every wanted rank by a little more than its error.
    The second counts what lies below, between and above the brackets, and
    counts the values inside them by value, merged in the tasks; about
    ``4 * error`` of the rows are inside, 0.5 % a rank at the default ``k``.
    The ranks are then selected from that table of counts, cutting it into
    ``buckets`` until one value is left; at most ``buckets`` rows an open
    range reach the driver.  A rank that its bracket misses (the sketch's
    bound holds with 99 %; tables of a few hundred rows may miss one) costs
    another scan, between the brackets that are exact by then.  Infinities are ranked by their number; integers stay
    integers, exact beyond 2^53."""
    names = {n: "long" if isinstance(df.schema[n].dataType, INTEGRAL) else "double" for n in cols}
    if not names:
        return {}
    probs = list(probs)
    stats = _bracketed(df, names, probs, k)
    found: dict = {}
    todo: dict = {}                # column: its brackets and ranks still to find
    for c, st in stats.items():
        n = st["n"]
        ranks = sorted({r for p in probs for r in (math.floor(p * (n - 1)), math.ceil(p * (n - 1)))}
                       if n else [])
        found.update({(c, r): -math.inf for r in ranks if r < st["low"]})
        found.update({(c, r): math.inf for r in ranks if r >= n - st["high"]})
        inside = [r for r in ranks if st["low"] <= r < n - st["high"]]
        if inside:
            todo[c] = (_merged(zip(st["los"], st["his"])), inside)
    while todo:
        zones = _zone_counts(df, names, {c: b for c, (b, _) in todo.items()})
        zones = zones.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            totals = {(r["c"], r["z"]): r["n"] for r in
                      zones.groupBy("c", "z").agg(F.sum("n").alias("n")).collect()}
            ranges, missed = _ranges(todo, totals, stats)
            for kind, v in (("long", "i"), ("double", "d")):
                found.update(_select(
                    zones.where("z % 2 = 1").select("c", F.col(v).alias("v"), "n"),
                    [r for r in ranges if names[r[0]] == kind], buckets, kind == "long"))
        finally:
            zones.unpersist()
        todo = missed
    out = {}
    for c, st in stats.items():
        out[c] = []
        for p in probs:
            if not st["n"]:
                out[c].append(None)
                continue
            pos = p * (st["n"] - 1)
            i, j = math.floor(pos), math.ceil(pos)
            a, b = float(found[c, i]), float(found[c, j])
            out[c].append(a if a == b else a + (b - a) * (pos - i))
    return out


def _numbers(c: str, kind: str) -> Column:
    v = F.col(f"`{c}`").cast(kind)
    return v if kind == "long" else F.when(~F.isnan(v), v)


def _bracketed(df: DataFrame, names: dict, probs, k: int) -> dict[str, dict]:
    """Per column: rows, infinities, extremes, and for every wanted quantile
    two values of the column's sketch that enclose it."""
    error = 2 * 2.296 / k ** 0.9021              # twice the sketch's rank error
    los = F.array(*[F.lit(max(0.0, p - error)) for p in probs])
    his = F.array(*[F.lit(min(1.0, p + error)) for p in probs])
    aggs, picks = [], []
    for j, (c, kind) in enumerate(names.items()):
        v = _numbers(c, kind)
        sketch, pick = ((F.kll_sketch_agg_bigint, F.kll_sketch_get_quantile_bigint) if kind == "long"
                        else (F.kll_sketch_agg_double, F.kll_sketch_get_quantile_double))
        d = v.cast("double")
        finite = F.when(F.abs(d) != F.lit(math.inf), v)
        aggs += [F.count(v).alias(f"n{j}"), F.count_if(d == F.lit(-math.inf)).alias(f"low{j}"),
                 F.count_if(d == F.lit(math.inf)).alias(f"high{j}"),
                 F.min(finite).alias(f"min{j}"), F.max(finite).alias(f"max{j}"),
                 sketch(v, F.lit(k)).alias(f"s{j}")]
        some = F.col(f"n{j}") > 0
        picks.append(F.struct(
            *[F.col(f"{x}{j}").alias(x) for x in ("n", "low", "high", "min", "max")],
            F.when(some, pick(F.col(f"s{j}"), los)).alias("los"),
            F.when(some, pick(F.col(f"s{j}"), his)).alias("his")).alias(f"c{j}"))
    row = df.agg(*aggs).select(*picks).first()
    out = {c: row[j].asDict() for j, c in enumerate(names)}
    for st in out.values():
        if st["min"] is not None:                # finite brackets
            for ends in ("los", "his"):
                st[ends] = [min(max(x, st["min"]), st["max"]) for x in st[ends]]
    return out


def _merged(brackets) -> list[tuple]:
    """Disjoint brackets in order."""
    out: list[tuple] = []
    for lo, hi in sorted(brackets):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], hi))
        else:
            out.append((lo, hi))
    return out


def _zone_counts(df: DataFrame, names: dict, brackets: dict) -> DataFrame:
    """(c, z, i or d, n): rows per column and zone.  Zone ``2m + 1`` is bracket
    ``m`` and keeps its values; the even zones between brackets are one row
    each."""
    parts, zones, kinds = [], [], []
    for j, (c, found) in enumerate(brackets.items()):
        integral = names[c] == "long"
        v, null = _numbers(c, names[c]), F.lit(None)
        parts.append(F.struct(F.lit(c).alias("c"), (v if integral else null.cast("long")).alias("i"),
                              (null.cast("double") if integral else v).alias("d")))
        x = F.col("i") if integral else F.col("d")
        zone = F.lit(2 * len(found))
        for m, (lo, hi) in reversed(list(enumerate(found))):
            zone = F.when(x < F.lit(lo), 2 * m).when(x <= F.lit(hi), 2 * m + 1).otherwise(zone)
        zones.append(F.when(F.col("c") == c, zone))
    rows = (df.select(F.explode(F.array(*parts)).alias("r")).select("r.*")
            .where(F.coalesce(F.col("i").cast("double"), F.col("d")).isNotNull())
            .withColumn("z", F.coalesce(*zones)))
    inside = F.col("z") % 2 == 1
    return (rows.groupBy("c", "z", F.when(inside, F.col("i")).alias("i"), F.when(inside, F.col("d")).alias("d"))
            .agg(F.count(F.lit(1)).alias("n")))


def _ranges(todo: dict, totals: dict, stats: dict) -> tuple[list, dict]:
    """Open ranges (column, rows before, lo, hi, ranks) of the ranks inside
    brackets; and, by column, the zones and ranks that brackets missed."""
    ranges, missed = [], {}
    for c, (brackets, ranks) in todo.items():
        seen = 0
        for z in range(2 * len(brackets) + 1):
            n = totals.get((c, z), 0)
            here = [r for r in ranks if seen <= r < seen + n]
            if here and z % 2:
                ranges.append((c, seen, *brackets[z // 2], here))
            elif here:
                lo = brackets[z // 2 - 1][1] if z else stats[c]["min"]
                hi = brackets[z // 2][0] if z < 2 * len(brackets) else stats[c]["max"]
                old, left = missed.get(c, ([], []))
                missed[c] = (_merged([*old, (lo, hi)]), left + here)
            seen += n
    return ranges, missed


def _bucket(lo, hi, buckets: int, integral: bool) -> Column:
    """Bucket of ``v`` in [lo, hi]: never falling in ``v``, and different at
    both ends."""
    v = F.col("v")
    if integral:
        wide = hi - lo >= 1 << 62                       # v - lo could overflow
        at = (v.cast("decimal(20,0)") if wide else v) - F.lit(lo)
        step = -(-(hi - lo + 1) // buckets)
        return F.least(F.floor(at / F.lit(step)), F.lit(buckets - 1)).cast("long")
    width = hi / buckets - lo / buckets                 # no overflow at the extremes
    if width == 0 or math.floor(hi / width - lo / width) < 1 or math.isinf(hi / width - lo / width):
        return (v > F.lit(lo)).cast("long")
    return F.greatest(F.least(F.floor(v / F.lit(width) - F.lit(lo / width)), F.lit(buckets - 1)),
                      F.lit(0)).cast("long")


def _select(v: DataFrame, ranges: list, buckets: int, integral: bool) -> dict:
    """(column, rank): value, from counted values (c, v, n).  A pass cuts every
    open range into buckets and keeps those that hold a rank, with their
    smallest and largest value, until a range holds one value; a range that
    arithmetic cannot cut is cut behind its smallest value."""
    found: dict = {}
    while ranges:
        for c, _, lo, hi, ranks in ranges:
            if lo == hi:
                found.update({(c, r): lo for r in ranks})
        ranges = [r for r in ranges if r[2] != r[3]]
        if not ranges:
            break
        conds = [(F.col("c") == c) & F.col("v").between(lo, hi) for c, _, lo, hi, _ in ranges]
        group = F.coalesce(*[F.when(cond, F.lit(i)) for i, cond in enumerate(conds)])
        bucket = F.coalesce(*[F.when(F.col("g") == i, _bucket(lo, hi, buckets, integral))
                              for i, (_, _, lo, hi, _) in enumerate(ranges)])
        rows = (v.withColumn("g", group).filter(F.col("g").isNotNull())
                .groupBy("g", bucket.alias("b"))
                .agg(F.sum("n").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
                .collect())
        after = []
        for i, (c, seen, _, _, ranks) in enumerate(ranges):
            left = list(ranks)
            for r in sorted((x for x in rows if x["g"] == i), key=lambda x: x["b"]):
                here = [k for k in left if k < seen + r["n"]]
                if here:
                    after.append((c, seen, r["lo"], r["hi"], here))
                    left = left[len(here):]
                seen += r["n"]
        ranges = after
    return found


def profile(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """``describe(include='all')``: one row per column with count, distinct,
    most frequent value and its frequency (text columns) and mean, sample
    standard deviation, min, quartiles and max (numeric columns) (PRF3).

    Counts, moments and extremes come from one aggregation pass.  Text
    columns are unpivoted to (column, value) and counted once; that table
    gives both the distinct count (its rows per column) and the most
    frequent value (``min(struct(-count, value))``), all partial aggregates,
    so a dominant value never lands in one task.  Quartiles come from
    ``exact_quantiles_of``.
    """
    spark = spark or df.sparkSession
    fields = df.schema.fields
    num = [f.name for f in fields if isinstance(f.dataType, NUMERIC)]
    txt = [f.name for f in fields if f.name not in num]
    aggs = []
    for f in fields:
        c = F.col(f"`{f.name}`")
        aggs.append(F.count(c).alias(f"{f.name}__count"))
        if f.name in num:
            d = c.cast("double")
            aggs += [F.avg(d).alias(f"{f.name}__mean"), F.stddev_samp(d).alias(f"{f.name}__std"),
                     F.min(d).alias(f"{f.name}__min"), F.max(d).alias(f"{f.name}__max")]
    one = df.agg(*aggs)
    rows = []
    for f in fields:
        n = f.name
        if n in num:
            rows.append(f"'{n}', `{n}__count`, `{n}__mean`, `{n}__std`, `{n}__min`, `{n}__max`")
        else:
            rows.append(f"'{n}', `{n}__count`, CAST(NULL AS DOUBLE), "
                        f"CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE), CAST(NULL AS DOUBLE)")
    base = one.selectExpr(
        f"stack({len(fields)}, {', '.join(rows)}) AS (column, count, mean, std, min, max)")
    if txt:
        stack = ", ".join(f"'{n}', CAST(`{n}` AS STRING)" for n in txt)
        long = df.selectExpr(f"stack({len(txt)}, {stack}) AS (column, value)") \
            .filter(F.col("value").isNotNull())
        freq = long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("cnt"))
        top = freq.groupBy("column").agg(
            F.count(F.lit(1)).alias("unique"),
            F.min(F.struct((-F.col("cnt")).alias("k"), F.col("value").alias("v"))).alias("t"))
        top = top.select("column", "unique", F.col("t.v").alias("top"),
                         (-F.col("t.k")).alias("freq"))
    else:
        top = spark.createDataFrame([], "column string, unique bigint, top string, freq bigint")
    qrows = []
    if num:
        quartiles = exact_quantiles_of(df, num, [0.25, 0.5, 0.75])
        qrows = [(n, *quartiles[n]) for n in num]
    quart = spark.createDataFrame(qrows, "column string, q1 double, q2 double, q3 double")
    out = base.join(top, "column", "left").join(quart, "column", "left")
    return out.select(
        "column", F.col("count").cast("bigint").alias("count"),
        F.col("unique").cast("bigint").alias("unique"), "top",
        F.col("freq").cast("bigint").alias("freq"), "mean", "std", "min", "q1", "q2", "q3", "max")
