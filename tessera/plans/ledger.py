"""P5 with several requests per customer: every request is quoted, those paid
from the balance settle or are rejected in order, and each customer comes out
once (BIL2, BIL3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.strings import format_money, parse_money
from ..operators import billing as B
from ..operators.ledger import run_ledger
from ..operators.windows import running_total_by_range
from .billing import _MONEY, _money_sql
from .catalog import query, table

USES = ["rental_requests", "rentals", "cars"]

_LEDGER_SQL = f"""
, q AS (SELECT r.*, CAST((date_diff('day', CAST(r.Startdate AS DATE), CAST(r.Enddate AS DATE)) + 1)
                         * {_MONEY.format(c='c.PricePerDay')} AS DECIMAL(12,2)) AS total
        FROM rental_requests r LEFT JOIN cars c ON r.CarID = c.CarID),
d AS (SELECT q.RequestID, q.CustID, CAST(total * 100 AS BIGINT) AS debit,
             CAST({_MONEY.format(c='a.Balance')} * 100 AS BIGINT) AS opened,
             row_number() OVER (PARTITION BY q.CustID ORDER BY requested_on, RequestID) AS i
      FROM q JOIN rentals a ON q.CustID = a.CustID
      WHERE choice IN (2, 3) AND provider_choice BETWEEN 1 AND 5 AND total IS NOT NULL
        AND {_MONEY.format(c='a.Balance')} IS NOT NULL),
l AS (SELECT * FROM (
  WITH RECURSIVE run(RequestID, CustID, i, settled, bal) AS (
    SELECT RequestID, CustID, i, debit <= opened, opened - CASE WHEN debit <= opened THEN debit ELSE 0 END
    FROM d WHERE i = 1
    UNION ALL
    SELECT d.RequestID, d.CustID, d.i, d.debit <= run.bal,
           run.bal - CASE WHEN d.debit <= run.bal THEN d.debit ELSE 0 END
    FROM run JOIN d ON d.CustID = run.CustID AND d.i = run.i + 1)
  SELECT * FROM run))
"""


def ledger(spark, sf):
    """(requests with ``settled``, customers with ``new_balance``)."""
    quoted = B.quote(table(spark, sf, "rental_requests"), table(spark, sf, "cars"))
    accounts = table(spark, sf, "rentals").withColumn("balance_amount", parse_money("Balance"))
    from_balance = F.col("choice").isin(2, 3) & F.col("provider_choice").between(1, 5)
    return run_ledger(quoted, accounts, "CustID", ["requested_on", "RequestID"], "total",
                      "balance_amount", from_balance)


@query("bil2_ledger", _LEDGER_SQL + """
SELECT q.RequestID, q.CustID, CAST(q.total AS DOUBLE) AS total, l.settled
FROM q LEFT JOIN l ON q.RequestID = l.RequestID""", uses=USES)
def bil2_ledger(spark, sf):
    done, _ = ledger(spark, sf)
    return done.select("RequestID", "CustID", F.col("total").cast("double").alias("total"), "settled")


@query("bil3_ledger_balances", _LEDGER_SQL + f"""
, spent AS (SELECT d.CustID, SUM(d.debit) AS spent FROM d JOIN l ON d.RequestID = l.RequestID
            WHERE l.settled GROUP BY 1)
SELECT a.CustID, a.Balance, {_money_sql(f"{_MONEY.format(c='a.Balance')} - COALESCE(spent, 0) / 100")}
         AS new_balance
FROM rentals a LEFT JOIN spent ON a.CustID = spent.CustID""", uses=USES)
def bil3_ledger(spark, sf):
    _, after = ledger(spark, sf)
    return after.select("CustID", "Balance", format_money("new_balance").alias("new_balance"))


@query("win1_running_total_by_range", """
SELECT RequestID, CustID, choice, SUM(choice) OVER (PARTITION BY CustID ORDER BY requested_on) AS running
FROM rental_requests""", uses=["rental_requests"])
def win1_by_range(spark, sf):
    """Running sum per customer over the days of the requests; one customer has
    a third of them."""
    r = table(spark, sf, "rental_requests")
    out = running_total_by_range(r, "CustID", "requested_on", F.col("choice").cast("long"), "running")
    return out.select("RequestID", "CustID", "choice", "running")
