"""Aggregations (AGG*).  Every grouped aggregate is a hash aggregate with a
map-side partial step, so a hot key is combined before it is shuffled."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import percent
from ..functions.strings import _c


def peak_ratio(df: DataFrame, keys, num: str, den: str,
               max_name: str, ratio_name: str) -> DataFrame:
    """Group max of a column and of ``num/den*100`` (AGG1)."""
    return df.groupBy(*keys).agg(F.max(num).alias(max_name),
                                 F.max(percent(num, den)).alias(ratio_name))


def peak_count(df: DataFrame, key: str, c: str, out: str) -> DataFrame:
    """Group max over a text column read as int (AGG2)."""
    return df.groupBy(key).agg(F.max(_c(c).try_cast("int")).alias(out))


def global_totals(df: DataFrame, cases: str, deaths: str) -> DataFrame:
    """Global sums and the ratio of sums, always one row (AGG3)."""
    s_c = F.sum(cases)
    s_d = F.sum(_c(deaths).try_cast("int").cast("bigint"))
    return df.agg(s_c.alias("total_cases"), s_d.alias("total_deaths"),
                  (F.try_divide(s_d.cast("double"), s_c) * 100).alias("DeathPercentage"))


def value_counts_sql(df: DataFrame, c: str, out: str = "n") -> DataFrame:
    """Group count of non-null values; a null group is kept with count 0 (AGG4)."""
    return df.groupBy(c).agg(F.count(c).alias(out))


def value_counts(df: DataFrame, c: str, out: str = "count") -> DataFrame:
    """Frequency of each non-null value (AGG5)."""
    return df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count(F.lit(1)).alias(out))


def class_share(df: DataFrame, c: str, out: str = "Percentage") -> DataFrame:
    """Share of each class in percent of all rows, null class included in
    the total (AGG6).

    One grouped aggregate gives the class counts; the total is a window sum
    over those counts — one row per class, so the window's single partition
    is bounded by the number of classes, not by the data.  (A join with a
    separately aggregated total would compute the whole input twice.)"""
    counts = df.groupBy(c).agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n").over(Window.partitionBy())
    return (counts.select(c, (F.col("_n") / total * 100).alias(out))
            .filter(F.col(c).isNotNull()))


def mean_rounded(df: DataFrame, c: str, places: int = 2, out: str = "avg") -> DataFrame:
    """Global mean rounded half-to-even, as pandas rounds (AGG7)."""
    return df.agg(F.bround(F.avg(c), places).alias(out))


def group_mean(df: DataFrame, key: str, c: str, out: str | None = None) -> DataFrame:
    """Group mean over non-null keys (AGG8)."""
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.avg(c).alias(out or c))


def mean_scores(df: DataFrame, cols) -> DataFrame:
    """Mean of several score columns (AGG9)."""
    return df.agg(*[F.avg(c).alias(c) for c in cols])


def corr_matrix(df: DataFrame, cols) -> DataFrame:
    """Pearson correlation of every column pair, unpivoted (AGG10).

    One aggregation pass computes all pairs; the 1-row result is unpivoted
    with ``stack``."""
    pairs = [(a, b) for a in cols for b in cols]
    row = df.agg(*[(F.lit(1.0) if a == b else F.corr(a, b)).alias(f"{a}__{b}") for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a, b in pairs)
    return row.selectExpr(f"stack({len(pairs)}, {stack}) AS (col_a, col_b, r)")


def term_freq(tokens: DataFrame, token: str = "token", by=(), out: str = "n") -> DataFrame:
    """Token frequency over a corpus (AGG11): partial counts per task, then
    one shuffle of (token, partial count) pairs."""
    return tokens.groupBy(*by, token).agg(F.count(F.lit(1)).alias(out))


def monthly_counts(df: DataFrame, date: str, c: str, out: str = "n") -> DataFrame:
    """Count of non-null ``c`` per calendar month, months without data kept
    as 0 (AGG12).

    The calendar is generated from the min/max date (one tiny aggregate) with
    ``sequence``; the monthly counts are a normal grouped aggregate."""
    counts = df.filter(F.col(date).isNotNull()).groupBy(
        F.last_day(date).alias("month_end")).agg(F.count(c).alias("_n"))
    span = df.agg(F.min(date).alias("lo"), F.max(date).alias("hi"))
    months = span.filter(F.col("lo").isNotNull()).select(F.explode(F.sequence(
        F.trunc("lo", "MM"), F.col("hi"), F.expr("INTERVAL 1 MONTH"))).alias("m")) \
        .select(F.last_day("m").alias("month_end"))
    return (months.join(counts, on="month_end", how="left")
            .select("month_end", F.coalesce("_n", F.lit(0)).cast("bigint").alias(out)))


def class_index(df: DataFrame, label: str, out: str = "class_index") -> DataFrame:
    """Distinct classes with their index in sorted label order (AGG13).

    The distinct step shrinks the data to the class list before the global
    ordering window, so that window sees one row per class."""
    classes = df.select(label).distinct().filter(F.col(label).isNotNull())
    return classes.withColumn(out, (F.dense_rank().over(Window.orderBy(label)) - 1).cast("int"))


def evaluate(scores: DataFrame, probs: str, label: str, eps: float = 1e-7) -> DataFrame:
    """Mean categorical cross-entropy and accuracy in percent (AGG14)."""
    p_true = F.element_at(F.col(probs), F.col(label) + 1)
    pred = F.array_position(F.col(probs), F.array_max(F.col(probs))) - 1
    return scores.agg(
        F.avg(-F.ln(F.greatest(p_true.cast("double"), F.lit(eps)))).alias("loss"),
        (F.avg((pred == F.col(label)).cast("int")) * 100).alias("accuracy"))


def per_group(expr, count_col: str = "n"):
    """``expr`` over the grouping keys of an aggregate, evaluated once per group.

    A filter on an expression of grouping keys alone is pushed by Catalyst
    below the aggregate (and below projections, inlining the expression),
    so an expensive expression would run once per input row again.  Tying
    it to the group's count (always > 0) keeps it above the aggregate."""
    return F.when(F.col(count_col) > 0, expr)


def top_k_per_group(df: DataFrame, group, order, k: int, rank: str = "rank",
                    split_on: str | None = None, splits: int = 64) -> DataFrame:
    """Top ``k`` rows of every group by ``order`` (a list of sort Columns).

    With ``split_on`` the group is first cut into ``splits`` hash pieces of
    that column, the top k of every piece are kept, and the final ranking runs
    over at most ``splits*k`` candidates per group: exact (the global top k
    is inside the union of the pieces' top k), and no task holds a whole
    group.
    """
    group = [group] if isinstance(group, str) else list(group)
    src = df
    if split_on is not None:
        piece = F.pmod(F.xxhash64(F.col(split_on)), F.lit(splits))
        w1 = Window.partitionBy(*group, piece).orderBy(*order)
        src = src.withColumn("_r1", F.row_number().over(w1)).filter(F.col("_r1") <= k).drop("_r1")
    w = Window.partitionBy(*group).orderBy(*order)
    return src.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= k)
