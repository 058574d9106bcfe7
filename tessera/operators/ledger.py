"""Running ledger: debits against a balance, in order, with rejection (BIL2,
BIL3 for several requests per customer).

A debit settles if the balance still covers it and is rejected otherwise, so
the balance after a request is no prefix sum.  Customers with few requests are
folded in an array inside their row.  A customer with more than ``HOT``
requests goes through halving phases instead, so that no task ever holds all
of them:

    While the balance has not fallen below half of what the phase started
    with, every debit of at most that half settles.  A phase is therefore a
    running sum of the small debits, and ends at the first request that takes
    the balance below the half: a small one by the sum, or a large one the
    balance still covers.  Large debits before that are rejected, and so is,
    for good, whatever exceeds the balance.  Balances are whole cents, so a
    customer needs at most some 40 phases, all customers together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stored

HOT = 1000                 # requests of a customer beyond which phases are used


def cents(c) -> Column:
    """A decimal(12,2) amount as whole cents."""
    c = F.col(c) if isinstance(c, str) else c
    return (c.cast("decimal(14,2)") * 100).cast("long")


def _amount(c) -> Column:
    return (c.cast("decimal(20,0)") / 100).cast("decimal(12,2)")


def _folded(rows: DataFrame) -> DataFrame:
    """Rows that settle, of customers with few requests: the debits of a
    customer are gathered in order, and one fold lists the balance before each
    of them."""
    one = rows.groupBy("_who").agg(
        F.first("_open").alias("_open"),
        F.array_sort(F.collect_list(F.struct("_order", "_row", "_debit"))).alias("_list"))
    balances = F.aggregate("_list", F.array("_open"), lambda a, r: F.concat(a, F.array(
        F.element_at(a, -1) - F.when(r["_debit"] <= F.element_at(a, -1), r["_debit"]).otherwise(0))))
    marked = F.zip_with("_list", F.slice(balances, F.lit(1), F.size("_list")), lambda r, left: F.when(
        r["_debit"] <= left, r["_row"]))
    return one.select(F.explode_outer(marked).alias("_row")).where("_row IS NOT NULL")


def _phase(left: DataFrame, state: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One halving phase of all customers: the running sum of small debits per
    piece, and the request that ends the phase."""
    j = left.join(state, "_who").where("_debit <= _now")
    small = F.col("_debit") * 2 <= F.col("_now")
    j = j.withColumn("_small", F.when(small, F.col("_debit")).otherwise(F.lit(0)))
    sums = j.groupBy("_who", "_piece").agg(F.sum("_small").alias("_sum"))
    earlier = (Window.partitionBy("_who").orderBy("_piece")
               .rowsBetween(Window.unboundedPreceding, -1))
    offsets = sums.select("_who", "_piece", F.coalesce(F.sum("_sum").over(earlier), F.lit(0))
                          .alias("_offset"))
    upto = (Window.partitionBy("_who", "_piece").orderBy("_order", "_row")
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    run = (j.withColumn("_in", F.sum("_small").over(upto)).join(offsets, ["_who", "_piece"])
           .withColumn("_spent", F.col("_offset") + F.col("_in")))
    ends = F.when(small, F.col("_spent") * 2 > F.col("_now")).otherwise(
        F.col("_debit") <= F.col("_now") - F.col("_spent"))
    return run, ends


def _phased(rows: DataFrame) -> DataFrame:
    """Ledger of customers with many requests, in halving phases.  Rows are
    dealt into pieces by one range exchange on (customer, order), so a
    customer's requests lie in many tasks."""
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    left = stored(rows.repartitionByRange(parts, "_who", "_order", "_row")
                  .withColumn("_piece", F.spark_partition_id()), "ledger_rows")
    state = stored(left.groupBy("_who").agg(F.first("_open").alias("_now")), "ledger_state")
    left, settled = left.drop("_open"), []
    while True:
        run, ends = _phase(left, state)
        last = run.where(ends).groupBy("_who").agg(
            F.min(F.struct("_order", "_row", "_spent", "_debit", "_small")).alias("_end"))
        now = F.col("_now") - F.col("_end._spent") - F.when(
            F.col("_end._small") == 0, F.col("_end._debit")).otherwise(0)
        turn = stored(state.join(last, "_who", "left").select(
            "_who", "_now", "_end", F.when(F.col("_end").isNotNull(), now).alias("_next")),
            "ledger_turn")
        at, end = F.struct("_order", "_row"), F.struct("_end._order", "_end._row")
        marked = run.drop("_now").join(turn, "_who")
        upto = F.col("_end").isNull() | (at <= end)
        taken = marked.where(upto & ((F.col("_small") > 0) | (F.col("_debit") == 0) | (at == end)))
        settled.append(stored(taken.select("_row"), "ledger_settled"))
        state = turn.where("_next IS NOT NULL").select("_who", F.col("_next").alias("_now"))
        if state.isEmpty():
            break
        rest = marked.where(~upto & F.col("_next").isNotNull() & (F.col("_debit") <= F.col("_next")))
        left = stored(rest.select("_who", "_order", "_row", "_debit", "_piece"), "ledger_rows")
    out = settled[0]
    for s in settled[1:]:
        out = out.unionByName(s)
    return out


def run_ledger(requests: DataFrame, accounts: DataFrame, key: str, order, amount: str,
               balance: str, applies: Column | None = None, hot: int | None = None):
    """Settle every request against its customer's balance, in order.

    ``requests`` has the customer ``key``, the order columns and the ``amount``;
    ``accounts`` one row per customer with ``key`` and ``balance`` (money as
    decimals).  ``applies`` marks the requests that debit the balance at all;
    the others, requests without an amount or with a negative one, and those of
    unknown customers or of customers without a balance, have a null
    ``settled``.

    Returns two tables: every request with ``settled`` and, one row per
    account, ``accounts`` with ``new_balance`` (null where the balance is).
    Equal order values are taken in the order of the rows' numbers; rows are
    numbered in a stored copy, so both tables agree."""
    hot = HOT if hot is None else hot
    order = [order] if isinstance(order, str) else list(order)
    rows = stored(requests.withColumn("_row", F.monotonically_increasing_id())
                  .withColumn("_applies", applies if applies is not None else F.lit(True)),
                  "ledger_requests")
    open_ = accounts.select(F.col(f"`{key}`").alias("_who"), cents(balance).alias("_open")) \
        .where("_open IS NOT NULL")
    debits = (rows.where("_applies").select(
        F.col(f"`{key}`").alias("_who"), F.struct(*[F.col(f"`{c}`") for c in order]).alias("_order"),
        "_row", cents(amount).alias("_debit"))
        .where("_debit >= 0").join(open_, "_who"))
    counts = debits.groupBy("_who").agg(F.count(F.lit(1)).alias("_n"))
    sized = stored(debits.join(counts, "_who"), "ledger_debits")
    settled = _folded(sized.where(F.col("_n") <= hot))
    many = sized.where(F.col("_n") > hot).drop("_n")
    if not many.isEmpty():
        settled = settled.unionByName(_phased(many))
    marks = stored(sized.select("_row", "_who", "_debit").join(
        settled.withColumn("_ok", F.lit(True)), "_row", "left")
        .select("_row", "_who", "_debit", F.coalesce("_ok", F.lit(False)).alias("_ok")), "ledger_marks")
    done = rows.join(marks.select("_row", F.col("_ok").alias("settled")), "_row", "left") \
        .drop("_row", "_applies")
    spent = marks.where("_ok").groupBy("_who").agg(F.sum("_debit").alias("_spent"))
    old = cents(balance)
    after = (accounts.join(spent, F.col(f"`{key}`") == F.col("_who"), "left")
             .withColumn("new_balance", _amount(old - F.coalesce("_spent", F.lit(0))))
             .drop("_who", "_spent"))
    return done, after
