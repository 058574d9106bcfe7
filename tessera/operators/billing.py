"""Rental billing re-aimed as batch operators over tables (BIL1-6, CND*).

The console program billed one customer per run through menus and
prompts.  Here every rental, request and invoice is a row: a quote is a
join and a few decimal expressions, payment routing one ``when`` chain over
the request columns, an invoice one ``concat_ws`` of fixed-width lines.
Money is ``decimal(12,2)`` throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.conditions import expiry_status, valid_card, valid_cvv
from ..functions.dates import rental_days
from ..functions.numeric import deposit
from ..functions.strings import center, format_money, parse_money

# Fixed values of the invoice layout -----------------------------------------
INVOICE_WIDTH = 100
LABEL_WIDTH = 20
COMPANY = "SOCAR"
STATUS_GAP = 71          # blanks between "Status :" and the status word
AMOUNT_GAP = 67          # blanks before " RM x.xx" on invoices
QUOTE_TOTAL_GAP = 69     # quote screen, grand total
QUOTE_DEPOSIT_GAP = 70   # quote screen, deposit
# ---------------------------------------------------------------------------


def quote(rentals: DataFrame, cars: DataFrame) -> DataFrame:
    """Days, price per day, total and both deposits per rental (BIL1).

    Rentals whose car is missing keep null amounts (the lookup miss)."""
    r = rentals.join(cars, on="CarID", how="left")
    days = rental_days(F.to_date("Startdate", "yyyy-MM-dd"), F.to_date("Enddate", "yyyy-MM-dd"))
    price = parse_money("PricePerDay")
    total = (days.cast("decimal(12,2)") * price).cast("decimal(12,2)")
    return r.select(
        *rentals.columns, *[c for c in cars.columns if c != "CarID"],
        days.alias("days"), price.alias("price_per_day"), total.alias("total"),
        deposit(total, "floor").alias("deposit_floor"),
        deposit(total, "exact").cast("decimal(12,2)").alias("deposit_exact"))


def settle(quotes: DataFrame) -> DataFrame:
    """Balance check (BIL2): ``balance < total`` → INSUFFICIENT, balance kept;
    otherwise SETTLED with ``balance - total``."""
    bal = parse_money("Balance")
    ok = bal >= F.col("total")
    return quotes.withColumns({
        "balance_amount": bal,
        "status": F.when(F.col("total").isNull() | bal.isNull(), F.lit("NO_QUOTE"))
                   .when(ok, F.lit("SETTLED")).otherwise(F.lit("INSUFFICIENT")),
        "new_balance": F.when(ok, (bal - F.col("total")).cast("decimal(12,2)")).otherwise(bal),
    })


def apply_settlement(rentals: DataFrame, routed: DataFrame) -> DataFrame:
    """Customer table after the run (BIL3): customers whose request was
    settled against their balance get the new balance text, all others — card,
    cash, rejected, insufficient — keep theirs."""
    s = routed.filter(F.col("outcome") == "SETTLED").select(
        "CustID", format_money("balance_after").alias("_nb"))
    return (rentals.join(s, on="CustID", how="left")
            .withColumn("Balance", F.coalesce("_nb", "Balance")).drop("_nb")
            .select(*rentals.columns))


def card_check(requests: DataFrame, as_of, allow_slash: bool = False) -> DataFrame:
    """Card checks in the program's order, first failure reported (BIL5)."""
    exp = expiry_status("expiry", as_of, allow_slash)
    reason = (F.when(~valid_card("card_no"), F.lit("invalid_card"))
              .when(exp != "ok", exp)
              .when(~valid_cvv("cvv"), F.lit("invalid_cvv"))
              .otherwise(F.lit("ok")))
    return requests.withColumn("card_result", reason)


def route_payments(requests: DataFrame, quotes: DataFrame, as_of,
                   allow_slash: bool = False) -> DataFrame:
    """Route every payment request by its menu choices (BIL4).

    1 card → card checks, PAID when they pass; 2 wallet and 3 bank with a
    provider 1-5 → balance settlement, provider 6 → back to the menu;
    4 cash → UNPAID with the floor deposit due; 5 → exit; else invalid."""
    checked = card_check(requests, as_of, allow_slash)
    q = settle(quotes).select("CustID", "total", "deposit_floor", "status", "balance_amount",
                              "new_balance")
    j = checked.join(q, on="CustID", how="left")
    choice, prov = F.col("choice"), F.col("provider_choice")
    via_balance = choice.isin(2, 3)
    method = (F.when(choice == 1, "Credit Card").when(choice == 2, "Digital Wallet")
              .when(choice == 3, "Bank Transfer").when(choice == 4, "Cash Payment")
              .when(choice == 5, "Exit").otherwise("Invalid"))
    outcome = (F.when(choice == 1, F.when(F.col("card_result") == "ok", F.lit("PAID"))
                      .otherwise(F.concat(F.lit("REJECTED:"), F.col("card_result"))))
               .when(via_balance & prov.between(1, 5), F.col("status"))
               .when(via_balance & (prov == 6), F.lit("MENU"))
               .when(via_balance, F.lit("INVALID_PROVIDER"))
               .when(choice == 4, F.lit("UNPAID"))
               .when(choice == 5, F.lit("EXIT"))
               .otherwise(F.lit("INVALID_CHOICE")))
    settled = via_balance & prov.between(1, 5) & (F.col("status") == "SETTLED")
    return j.select(
        "CustID", "choice", "provider_choice", method.alias("method"), outcome.alias("outcome"),
        F.when(choice == 4, F.col("deposit_floor")).alias("deposit_due"),
        F.when(settled, F.col("new_balance")).otherwise(F.col("balance_amount"))
        .alias("balance_after"))


def _line(label: str, value: Column) -> Column:
    return F.concat(F.lit(label.ljust(LABEL_WIDTH) + ": "), F.coalesce(value.cast("string"), F.lit("")))


def _amount(label: str, gap: int, value: Column) -> Column:
    return F.concat(F.lit(label.ljust(LABEL_WIDTH) + ":" + " " * gap + " "),
                    format_money(value))


def _customer_block() -> list[Column]:
    """Heading and customer lines shared by the documents."""
    bar = F.lit("=" * INVOICE_WIDTH)
    return [bar, _title(COMPANY), _title("RENTAL INVOICE"), bar, _title("CUSTOMER DETAILS"), bar,
            _line("Name", F.col("Name")), _line("Address", F.col("Address")),
            _line("Phone", F.col("Phone")), _line("IC No", F.col("ICNo")),
            _line("Startdate", F.col("Startdate")), _line("Enddate", F.col("Enddate")), bar]


def _rental_block() -> list[Column]:
    bar = F.lit("=" * INVOICE_WIDTH)
    return [_title("RENTAL DETAILS"), bar, _line("Brand", F.col("Brand")), _line("Type", F.col("Type")),
            _line("Plate Number", F.col("PlateNum")), _line("Price/day", F.col("PricePerDay")),
            _line("Days rent", F.col("days")), bar]


def _title(text: str) -> Column:
    return F.lit(center(text, INVOICE_WIDTH))


def _document(lines: list[Column]) -> Column:
    """Lines joined to one text; an empty field prints as nothing."""
    return F.array_join(F.array(*lines), "\n", "")


def customer_screen() -> Column:
    """First detail screen: the customer block (STR17)."""
    return _document(_customer_block())


def quote_screen() -> Column:
    """Second detail screen: the rental block with the exact deposit (STR17)."""
    return _document([*_rental_block(), _amount("Grand Total", QUOTE_TOTAL_GAP, F.col("total")),
                      _amount("Deposit", QUOTE_DEPOSIT_GAP, F.col("deposit_exact")),
                      F.lit("=" * INVOICE_WIDTH)])


def invoice_text(status: Column) -> Column:
    """The invoice document of a quoted rental (STR17, BIL6)."""
    return _document([
        *_customer_block(), *_rental_block(),
        F.concat(F.lit("Status".ljust(LABEL_WIDTH) + ":" + " " * STATUS_GAP), status),
        _amount("Grand Total", AMOUNT_GAP, F.col("total")),
        _amount("Deposit", AMOUNT_GAP, F.col("deposit_floor")), F.lit("=" * INVOICE_WIDTH)])


def invoice_status(outcome) -> Column:
    """PAID for a card that passed and a settled balance, UNPAID for cash;
    every other outcome has no invoice."""
    o = F.col(outcome) if isinstance(outcome, str) else outcome
    return F.when(o.isin("PAID", "SETTLED"), F.lit("PAID")).when(o == "UNPAID", F.lit("UNPAID"))


def invoices(quotes: DataFrame, routed: DataFrame) -> DataFrame:
    """One invoice per routed request that leads to one (BIL6)."""
    st = routed.select("CustID", "outcome", invoice_status("outcome").alias("invoice_status")) \
        .filter(F.col("invoice_status").isNotNull())
    return (quotes.filter(F.col("total").isNotNull()).join(st, "CustID")
            .select("CustID", "outcome", invoice_text(F.col("invoice_status")).alias("invoice")))


def billing_run(rentals: DataFrame, cars: DataFrame, requests: DataFrame, as_of,
                allow_slash: bool = False) -> tuple[DataFrame, DataFrame]:
    """The whole rental run (P5): quote, route, settle, invoice.

    Returns one row per request (method, outcome, deposit due, balance after,
    invoice or null) and the updated customer table."""
    q = quote(rentals, cars)
    routed = route_payments(requests, q, as_of, allow_slash)
    papers = invoices(q, routed).select("CustID", "invoice")
    return (routed.join(papers, "CustID", "left"), apply_settlement(rentals, routed))
