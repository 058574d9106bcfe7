"""The ledger equals a plain loop, folded or in halving phases."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tessera.operators import ledger as L


def plain(requests, accounts):
    bal, done = dict(accounts), {}
    for i, (who, at, amount, applies) in sorted(enumerate(requests), key=lambda x: (x[1][1], x[0])):
        if not applies or amount is None or amount < 0 or bal.get(who) is None:
            done[i] = None
        elif amount <= bal[who]:
            bal[who] -= amount
            done[i] = True
        else:
            done[i] = False
    return done, bal


@pytest.mark.parametrize("hot", [0, 20, 10_000])
def test_against_a_loop(spark, hot):
    rng = random.Random(hot)
    accounts = {f"c{i}": Decimal(rng.randint(0, 400_000)) / 100 for i in range(12)}
    accounts |= {"big": Decimal("9999999.99"), "nil": Decimal(0), "none": None, "owes": Decimal("-5.00")}
    requests = []
    for i in range(700):
        who = "big" if i % 3 == 0 else rng.choice([*accounts, "nobody", None])
        top = 90_000_000 if who == "big" else 90_000
        amount = Decimal(rng.choice([rng.randint(1, top), rng.randint(1, 3000), 0])) / 100
        requests.append((who, rng.randint(1, 10_000), rng.choice([amount] * 9 + [None]),
                         rng.random() < 0.9))
    requests[5] = ("c1", 3, Decimal("-2.00"), True)
    order = sorted(range(len(requests)), key=lambda i: requests[i][1])
    requests = [(w, k, a, p) for k, (w, _, a, p) in enumerate(requests[i] for i in order)]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(requests)],
                               "i int, who string, at int, amount decimal(12,2), applies boolean")
    acc = spark.createDataFrame([(k, v, "x") for k, v in accounts.items()],
                                "who string, balance decimal(12,2), settled string")
    done, after = L.run_ledger(df.repartition(3), acc, "who", "at", "amount", "balance",
                               F.col("applies"), hot)
    exp, bal = plain(requests, accounts)
    assert {r.i: r.settled for r in done.collect()} == exp
    rows = after.collect()
    assert len(rows) == len(accounts) and {r.who: r.new_balance for r in rows} == bal


def test_two_debits_leave_one_row(spark):
    df = spark.createDataFrame([("a", 1, Decimal(40)), ("a", 2, Decimal(40)), ("a", 3, Decimal(40))],
                               "who string, at int, amount decimal(12,2)")
    acc = spark.createDataFrame([("a", Decimal(100)), ("b", Decimal(7))], "who string, balance decimal(12,2)")
    done, after = L.run_ledger(df, acc, "who", "at", "amount", "balance")
    assert [r.settled for r in done.orderBy("at").collect()] == [True, True, False]
    assert sorted((r.who, int(r.new_balance)) for r in after.collect()) == [("a", 20), ("b", 7)]
    done, after = L.run_ledger(df.limit(0), acc, "who", "at", "amount", "balance")
    assert done.count() == 0 and after.count() == 2
