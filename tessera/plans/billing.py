"""P5 rental billing over tables: quote → route → settle → invoice →
updated customer table (SRC3, SINK1, JN5, FLT10, DT2, DT4, NUM4, NUM8,
STR14-17, CND2-4, BIL1-6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import strings as S
from ..functions.conditions import expiry_status, valid_card, valid_cvv
from ..functions.dates import rental_days, to_date
from ..functions.numeric import parse_error, parse_or_default
from ..operators import billing as B
from ..operators import joins, relational as rel
from ..session import scratch_path
from ..sources.io import (read_keyed_records, write_keyed_mappings, write_keyed_records,
                          write_records)
from .catalog import query, table

CARS, RENTALS, REQ = "cars", "rentals", "payment_requests"
AS_OF = "2024-12-01"
CAR_FIELDS = ["Brand", "Type", "PlateNum", "PricePerDay"]


def quotes(spark, sf) -> DataFrame:
    return B.quote(table(spark, sf, RENTALS), table(spark, sf, CARS))


def settled(spark, sf) -> DataFrame:
    return B.settle(quotes(spark, sf))


def _d(c: str) -> F.Column:
    return F.col(c).cast("double").alias(c)


# --- SQL mirrors ------------------------------------------------------------

_MONEY = "TRY_CAST(trim(replace({c}, 'RM', '')) AS DECIMAL(12,2))"
_Q_SQL = f"""
, q AS (
  SELECT r.*, c.Brand, c.Type, c.PlateNum, c.PricePerDay,
         CAST(date_diff('day', CAST(r.Startdate AS DATE), CAST(r.Enddate AS DATE)) + 1 AS INT) AS days,
         {_MONEY.format(c='c.PricePerDay')} AS price_per_day
  FROM rentals r LEFT JOIN cars c ON r.CarID = c.CarID),
qt AS (SELECT *, CAST(days * price_per_day AS DECIMAL(12,2)) AS total FROM q),
qd AS (SELECT *, floor(total / 3) AS deposit_floor, ROUND(total / 3, 2) AS deposit_exact,
              {_MONEY.format(c='Balance')} AS balance_amount FROM qt),
st AS (SELECT *, CASE WHEN total IS NULL OR balance_amount IS NULL THEN 'NO_QUOTE'
                      WHEN balance_amount >= total THEN 'SETTLED' ELSE 'INSUFFICIENT' END AS status,
              CASE WHEN balance_amount >= total THEN balance_amount - total
                   ELSE balance_amount END AS new_balance
       FROM qd)
"""


def _money_sql(c: str) -> str:
    return f"concat('RM ', CAST(CAST({c} AS DECIMAL(12,2)) AS VARCHAR))"


# Documents typed out here, independently of the operator.
_BAR = "repeat('=', 100)"
_HEAD_SQL = f"""{_BAR},
  concat(repeat(' ', 47), 'SOCAR', repeat(' ', 48)),
  concat(repeat(' ', 43), 'RENTAL INVOICE', repeat(' ', 43)),
  {_BAR},
  concat(repeat(' ', 42), 'CUSTOMER DETAILS', repeat(' ', 42)),
  {_BAR},
  concat('Name                : ', Name),
  concat('Address             : ', Address),
  concat('Phone               : ', Phone),
  concat('IC No               : ', ICNo),
  concat('Startdate           : ', Startdate),
  concat('Enddate             : ', Enddate),
  {_BAR}"""
_RENTAL_SQL = f"""concat(repeat(' ', 43), 'RENTAL DETAILS', repeat(' ', 43)),
  {_BAR},
  concat('Brand               : ', Brand),
  concat('Type                : ', Type),
  concat('Plate Number        : ', PlateNum),
  concat('Price/day           : ', PricePerDay),
  concat('Days rent           : ', CAST(days AS VARCHAR)),
  {_BAR}"""
_INVOICE_SQL = f"""concat_ws(chr(10), {_HEAD_SQL},
  {_RENTAL_SQL},
  concat('Status              :', repeat(' ', 71), invoice_status),
  concat('Grand Total         :', repeat(' ', 68), {_money_sql('total')}),
  concat('Deposit             :', repeat(' ', 68), {_money_sql('deposit_floor')}),
  {_BAR})"""
_QUOTE_SCREEN_SQL = f"""concat_ws(chr(10), {_RENTAL_SQL},
  concat('Grand Total         :', repeat(' ', 70), {_money_sql('total')}),
  concat('Deposit             :', repeat(' ', 71), {_money_sql('deposit_exact')}),
  {_BAR})"""


def _card_sql(expiry: str) -> str:
    """Card checks in order (SQL mirror of ``card_check``)."""
    e = f"trim({expiry})"
    m = f"TRY_CAST(substring({e}, 1, 2) AS INT)"
    y = f"TRY_CAST(substring({e}, 3, 2) AS INT)"
    yy, mm = int(AS_OF[2:4]), int(AS_OF[5:7])
    return f"""CASE WHEN card_no IS NULL OR NOT regexp_full_match(replace(card_no, ' ', ''), '[0-9]{{16}}')
       THEN 'invalid_card'
     WHEN {expiry} IS NULL OR NOT regexp_full_match({e}, '[0-9]{{4}}') THEN 'bad_format'
     WHEN {m} < 1 OR {m} > 12 THEN 'bad_month'
     WHEN {y} < {yy} OR ({y} = {yy} AND {m} < {mm}) THEN 'expired'
     WHEN cvv IS NULL OR NOT regexp_full_match(trim(cvv), '[1-9][0-9]{{2}}') THEN 'invalid_cvv'
     ELSE 'ok' END"""


def _expiry_sql(expiry: str) -> str:
    e = f"trim({expiry})"
    m = f"TRY_CAST(substring({e}, 1, 2) AS INT)"
    y = f"TRY_CAST(substring({e}, 3, 2) AS INT)"
    yy, mm = int(AS_OF[2:4]), int(AS_OF[5:7])
    return f"""CASE WHEN {expiry} IS NULL OR NOT regexp_full_match({e}, '[0-9]{{4}}') THEN 'bad_format'
     WHEN {m} < 1 OR {m} > 12 THEN 'bad_month'
     WHEN {y} < {yy} OR ({y} = {yy} AND {m} < {mm}) THEN 'expired' ELSE 'ok' END"""


BILL = [RENTALS, CARS]

# --- registered queries -----------------------------------------------------


@query("src3_read_keyed_records", "SELECT CarID, Brand, Type, PlateNum, PricePerDay FROM cars",
       uses=[CARS])
def src3(spark, sf):
    """Cars written as ``{id: {...}}`` records (single JSON mapping per
    line), read back by the keyed-record source."""
    path = scratch_path(spark, "cars_keyed")
    write_keyed_records(table(spark, sf, CARS), path, "CarID")
    return read_keyed_records(spark, path, CAR_FIELDS, key="CarID")


@query("src3_read_keyed_mappings", "SELECT CarID, Brand, Type, PlateNum, PricePerDay FROM cars",
       uses=[CARS])
def src3_mappings(spark, sf):
    """The same from pretty-printed files that hold one mapping each."""
    path = scratch_path(spark, "cars_mappings")
    write_keyed_mappings(table(spark, sf, CARS), path, "CarID")
    return read_keyed_records(spark, path, CAR_FIELDS, key="CarID", whole_file=True)


@query("jn5_attach_car", """
SELECT r.CustID, r.CarID, c.Brand, c.PricePerDay FROM rentals r LEFT JOIN cars c
  ON r.CarID = c.CarID""", uses=BILL)
def jn5(spark, sf):
    j = joins.attach(table(spark, sf, RENTALS), table(spark, sf, CARS), "CarID")
    return j.select("CustID", "CarID", "Brand", "PricePerDay")


@query("flt10_lookup", """
SELECT r.CarID, r.CustID, c.Brand, c.CarID IS NOT NULL AS found FROM rentals r
LEFT JOIN cars c ON r.CarID = c.CarID""", uses=BILL)
def flt10(spark, sf):
    ids = table(spark, sf, RENTALS).select("CarID", "CustID")
    out = rel.lookup(table(spark, sf, CARS).select("CarID", "Brand"), ids, "CarID")
    return out.select("CarID", "CustID", "Brand", "found")


@query("dt2_text_to_date", """
SELECT CustID, CAST(Startdate AS DATE) AS start_date, CAST(Enddate AS DATE) AS end_date
FROM rentals""", uses=[RENTALS])
def dt2(spark, sf):
    r = table(spark, sf, RENTALS)
    return r.select("CustID", to_date("Startdate", "yyyy-MM-dd").alias("start_date"),
                    to_date("Enddate", "yyyy-MM-dd").alias("end_date"))


@query("dt4_rental_days", """
SELECT CustID, CAST(date_diff('day', CAST(Startdate AS DATE), CAST(Enddate AS DATE)) + 1 AS INT)
  AS days FROM rentals""", uses=[RENTALS])
def dt4(spark, sf):
    r = table(spark, sf, RENTALS)
    d = rental_days(to_date("Startdate", "yyyy-MM-dd"), to_date("Enddate", "yyyy-MM-dd"))
    return r.select("CustID", d.cast("int").alias("days"))


@query("str15_parse_money", f"""
SELECT CustID, CAST({_MONEY.format(c='Balance')} AS DOUBLE) AS balance FROM rentals""",
       uses=[RENTALS])
def str15(spark, sf):
    return table(spark, sf, RENTALS).select(
        "CustID", S.parse_money("Balance").cast("double").alias("balance"))


@query("str14_format_money", f"""
SELECT CustID, {_money_sql(_MONEY.format(c='Balance'))} AS balance_text FROM rentals""",
       uses=[RENTALS])
def str14(spark, sf):
    return table(spark, sf, RENTALS).select(
        "CustID", S.format_money(S.parse_money("Balance")).alias("balance_text"))


@query("num4_deposit", _Q_SQL + """
SELECT CustID, CAST(total AS DOUBLE) AS total, CAST(deposit_floor AS DOUBLE) AS deposit_floor,
       CAST(deposit_exact AS DOUBLE) AS deposit_exact FROM st""", uses=BILL)
def num4(spark, sf):
    return quotes(spark, sf).select("CustID", _d("total"), _d("deposit_floor"), _d("deposit_exact"))


@query("bil1_quote", _Q_SQL + """
SELECT CustID, CarID, days, CAST(price_per_day AS DOUBLE) AS price_per_day,
       CAST(total AS DOUBLE) AS total, CAST(deposit_floor AS DOUBLE) AS deposit_floor,
       CAST(deposit_exact AS DOUBLE) AS deposit_exact FROM st""", uses=BILL)
def bil1(spark, sf):
    q = quotes(spark, sf)
    return q.select("CustID", "CarID", F.col("days").cast("int").alias("days"), _d("price_per_day"),
                    _d("total"), _d("deposit_floor"), _d("deposit_exact"))


@query("bil2_settle", _Q_SQL + """
SELECT CustID, CAST(balance_amount AS DOUBLE) AS balance_amount, CAST(total AS DOUBLE) AS total,
       status,
       CAST(new_balance AS DOUBLE) AS new_balance FROM st""", uses=BILL)
def bil2(spark, sf):
    s = settled(spark, sf)
    return s.select("CustID", _d("balance_amount"), _d("total"), "status", _d("new_balance"))


_ROUTED_SQL = _Q_SQL + f"""
, rq AS (SELECT p.*, {_card_sql('p.expiry')} AS card_result FROM payment_requests p),
j AS (SELECT rq.*, st.total, st.deposit_floor, st.status, st.balance_amount, st.new_balance
      FROM rq LEFT JOIN st ON rq.CustID = st.CustID),
rt AS (
SELECT CustID, choice, provider_choice,
       CASE choice WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Digital Wallet'
                   WHEN 3 THEN 'Bank Transfer' WHEN 4 THEN 'Cash Payment' WHEN 5 THEN 'Exit'
                   ELSE 'Invalid' END AS method,
       CASE WHEN choice = 1 THEN CASE WHEN card_result = 'ok' THEN 'PAID'
                                      ELSE concat('REJECTED:', card_result) END
            WHEN choice IN (2, 3) AND provider_choice BETWEEN 1 AND 5 THEN status
            WHEN choice IN (2, 3) AND provider_choice = 6 THEN 'MENU'
            WHEN choice IN (2, 3) THEN 'INVALID_PROVIDER'
            WHEN choice = 4 THEN 'UNPAID' WHEN choice = 5 THEN 'EXIT'
            ELSE 'INVALID_CHOICE' END AS outcome,
       CASE WHEN choice = 4 THEN deposit_floor END AS deposit_due,
       CASE WHEN choice IN (2, 3) AND provider_choice BETWEEN 1 AND 5
                 AND status = 'SETTLED' THEN new_balance ELSE balance_amount END AS balance_after
FROM j),
ap AS (SELECT r.CustID, r.Name, r.Address, r.Phone, r.ICNo,
              COALESCE(CASE WHEN rt.choice IN (2, 3) AND rt.provider_choice IN (1, 2, 3, 4, 5)
                                 AND rt.outcome = 'SETTLED' THEN {_money_sql('rt.balance_after')} END,
                       r.Balance) AS Balance,
              r.Startdate, r.Enddate, r.CarID
       FROM rentals r LEFT JOIN rt ON r.CustID = rt.CustID),
iv AS (SELECT CustID, outcome, {_INVOICE_SQL} AS invoice
       FROM (SELECT st.*, rt.outcome,
                    CASE WHEN rt.outcome IN ('PAID', 'SETTLED') THEN 'PAID'
                         WHEN rt.outcome = 'UNPAID' THEN 'UNPAID' END AS invoice_status
             FROM st JOIN rt ON st.CustID = rt.CustID)
       WHERE total IS NOT NULL AND invoice_status IS NOT NULL)
"""
RUN = BILL + [REQ]


def run_tables(spark, sf):
    return table(spark, sf, RENTALS), table(spark, sf, CARS), table(spark, sf, REQ)


def routed(spark, sf) -> DataFrame:
    return B.route_payments(table(spark, sf, REQ), quotes(spark, sf), AS_OF)


@query("bil3_apply_settlement", _ROUTED_SQL + "SELECT * FROM ap", uses=RUN)
def bil3(spark, sf):
    return B.apply_settlement(table(spark, sf, RENTALS), routed(spark, sf))


@query("sink1_write_records", _ROUTED_SQL + "SELECT * FROM ap", uses=RUN)
def sink1(spark, sf):
    """The updated customer table written as JSON lines and read back."""
    path = scratch_path(spark, "updated_customers")
    updated = bil3(spark, sf)
    write_records(updated, path)
    return spark.read.schema(updated.schema).json(path).select(*updated.columns)


@query("cnd2_valid_card", """
SELECT CustID, card_no IS NOT NULL AND regexp_full_match(replace(card_no, ' ', ''), '[0-9]{16}') AS card_ok
FROM payment_requests""", uses=[REQ])
def cnd2(spark, sf):
    return table(spark, sf, REQ).select("CustID", valid_card("card_no").alias("card_ok"))


@query("cnd3_expiry_status", f"""
SELECT CustID, {_expiry_sql('expiry')} AS expiry_plain,
       {_expiry_sql("replace(expiry, '/', '')")} AS expiry_slash_ok
FROM payment_requests""", uses=[REQ])
def cnd3(spark, sf):
    """Both editions: slash rejected (first) and slash removed (second)."""
    return table(spark, sf, REQ).select(
        "CustID", expiry_status("expiry", AS_OF, allow_slash=False).alias("expiry_plain"),
        expiry_status("expiry", AS_OF, allow_slash=True).alias("expiry_slash_ok"))


@query("cnd4_valid_cvv", """
SELECT CustID, cvv IS NOT NULL AND regexp_full_match(trim(cvv), '[1-9][0-9]{2}') AS cvv_ok FROM payment_requests""",
       uses=[REQ])
def cnd4(spark, sf):
    return table(spark, sf, REQ).select("CustID", valid_cvv("cvv").alias("cvv_ok"))


@query("num8_parse_or_default", """
SELECT CustID,
       CASE WHEN nullif(trim(expiry), '') IS NULL THEN 0
            ELSE TRY_CAST(trim(expiry) AS INT) END AS expiry_int,
       nullif(trim(expiry), '') IS NOT NULL AND TRY_CAST(trim(expiry) AS INT) IS NULL
         AS expiry_error
FROM payment_requests""", uses=[REQ])
def num8(spark, sf):
    r = table(spark, sf, REQ)
    return r.select("CustID", parse_or_default("expiry", "int", 0).alias("expiry_int"),
                    parse_error("expiry", "int").alias("expiry_error"))


@query("str16_mask", "SELECT CustID, repeat('*', length(password)) AS masked FROM payment_requests",
       uses=[REQ])
def str16(spark, sf):
    return table(spark, sf, REQ).select("CustID", S.mask("password").alias("masked"))


@query("bil5_card_check", f"SELECT CustID, {_card_sql('expiry')} AS card_result "
       "FROM payment_requests", uses=[REQ])
def bil5(spark, sf):
    return B.card_check(table(spark, sf, REQ), AS_OF).select("CustID", "card_result")


@query("bil4_route_payments", _ROUTED_SQL + """
SELECT CustID, choice, provider_choice, method, outcome,
       CAST(deposit_due AS DOUBLE) AS deposit_due, CAST(balance_after AS DOUBLE) AS balance_after
FROM rt""", uses=RUN)
def bil4(spark, sf):
    return routed(spark, sf).select("CustID", "choice", "provider_choice", "method", "outcome",
                                    _d("deposit_due"), _d("balance_after"))


@query("bil6_invoices", _ROUTED_SQL + "SELECT * FROM iv", uses=RUN)
def bil6(spark, sf):
    return B.invoices(quotes(spark, sf), routed(spark, sf))


@query("str17_invoice_text", _Q_SQL + f"""
SELECT CustID, concat_ws(chr(10), {_HEAD_SQL}) AS customer_screen, {_QUOTE_SCREEN_SQL} AS quote_screen
FROM st WHERE total IS NOT NULL""", uses=BILL)
def str17(spark, sf):
    """Both detail screens of every quoted rental."""
    q = quotes(spark, sf).filter(F.col("total").isNotNull())
    return q.select("CustID", B.customer_screen().alias("customer_screen"),
                    B.quote_screen().alias("quote_screen"))


@query("p5_billing_run", _ROUTED_SQL + """
SELECT rt.CustID, rt.method, rt.outcome, CAST(rt.deposit_due AS DOUBLE) AS deposit_due,
       ap.Balance, iv.invoice
FROM rt JOIN ap ON rt.CustID = ap.CustID LEFT JOIN iv ON rt.CustID = iv.CustID""", uses=RUN)
def p5(spark, sf):
    """The rental run as one result: route, invoice and updated balance of
    every request."""
    done, updated = B.billing_run(*run_tables(spark, sf), AS_OF)
    return done.join(updated.select("CustID", "Balance"), "CustID").select(
        "CustID", "method", "outcome", _d("deposit_due"), "Balance", "invoice")
