"""Rental billing: the golden settlement pair and the routing rules."""

from tessera.operators import billing as B

CARS = [("001", "Perodua", "Axia", "P1", "RM120"), ("002", "Perodua", "Myvi", "P2", "RM160"),
        ("003", "Proton", "X50", "P3", "RM246"), ("005", "Nissan", "Almera", "P5", "RM278"),
        ("006", "Perodua", "Alza", "P6", "RM350")]
RENTALS = [("001", "n1", "RM275", "2024-12-01", "2024-12-02", "001"),
           ("002", "n2", "RM275", "2024-03-01", "2024-03-02", "003"),
           ("003", "n3", "RM800", "2024-01-01", "2024-01-02", "002"),
           ("004", "n4", "RM600", "2024-01-01", "2024-01-03", "001"),
           ("005", "n5", "RM700", "2024-01-01", "2024-01-02", "006"),
           ("006", "n6", "RM400", "2024-01-01", "2024-01-01", "005"),
           ("007", "n7", "RM 10.00", "2024-01-01", "2024-01-01", "999")]
CAR_S = "CarID string, Brand string, Type string, PlateNum string, PricePerDay string"
RENT_S = ("CustID string, Name string, Address string, Phone string, ICNo string, Balance string, "
          "Startdate string, Enddate string, CarID string")
REQ_S = "CustID string, choice int, provider_choice int, card_no string, expiry string, cvv string"
AS_OF = "2024-12-01"
# CustID: days, total, status, balance text after, floor deposit, exact deposit
GOLDEN = {"001": (2, 240, "SETTLED", "RM 35.00", 80, 80.00),
          "002": (2, 492, "INSUFFICIENT", "RM275", 164, 164.00),
          "003": (2, 320, "SETTLED", "RM 480.00", 106, 106.67),
          "004": (3, 360, "SETTLED", "RM 240.00", 120, 120.00),
          "005": (2, 700, "SETTLED", "RM 0.00", 233, 233.33),
          "006": (1, 278, "SETTLED", "RM 122.00", 92, 92.67)}


def frames(spark):
    rentals = [(i, n, f"{i} Example Street", f"555-{i}", f"IC-{i}", *r) for i, n, *r in RENTALS]
    return spark.createDataFrame(rentals, RENT_S), spark.createDataFrame(CARS, CAR_S)


def test_golden_pair(spark):
    rentals, cars = frames(spark)
    q = B.quote(rentals, cars)
    s = {r.CustID: r for r in B.settle(q).collect()}
    wallet = spark.createDataFrame([(r[0], 2, 1, None, None, None) for r in RENTALS], REQ_S)
    routed = B.route_payments(wallet, q, AS_OF)
    after = {r.CustID: r.Balance for r in B.apply_settlement(rentals, routed).collect()}
    for cid, (days, total, status, bal, dfl, dex) in GOLDEN.items():
        r = s[cid]
        assert (r.days, float(r.total), r.status) == (days, total, status)
        assert (float(r.deposit_floor), float(r.deposit_exact)) == (dfl, dex)
        assert after[cid] == bal
    assert s["007"].status == "NO_QUOTE" and after["007"] == "RM 10.00"


def test_routing(spark):
    rentals, cars = frames(spark)
    req = spark.createDataFrame([
        ("001", 1, 1, "4000 0000 0000 0002", "0630", "345"),
        ("002", 1, 1, "4000 0000 0000 0002", "0630", "012"),
        ("003", 2, 3, "", "", ""), ("002", 3, 1, "", "", ""), ("004", 2, 6, "", "", ""),
        ("005", 4, 1, "", "", ""), ("006", 5, 1, "", "", ""), ("001", 9, 1, "", "", "")],
        "CustID string, choice int, provider_choice int, card_no string, expiry string, cvv string")
    out = [(r.CustID, r.choice, r.outcome, r.deposit_due and float(r.deposit_due),
            r.balance_after and float(r.balance_after))
           for r in B.route_payments(req, B.quote(rentals, cars), "2024-12-01").collect()]
    assert sorted(out) == sorted([
        ("001", 1, "PAID", None, 275.0), ("002", 1, "REJECTED:invalid_cvv", None, 275.0),
        ("003", 2, "SETTLED", None, 480.0), ("002", 3, "INSUFFICIENT", None, 275.0),
        ("004", 2, "MENU", None, 600.0), ("005", 4, "UNPAID", 233.0, 700.0),
        ("006", 5, "EXIT", None, 400.0), ("001", 9, "INVALID_CHOICE", None, 275.0)])


def test_missing_card_data_is_rejected(spark):
    rentals, cars = frames(spark)
    good = ("4000 0000 0000 0002", "0630", "345")
    cases = [(None, None, None), (None, *good[1:]), (good[0], None, good[2]), (*good[:2], None),
             ("  ", *good[1:]), (good[0], "", good[2]), (*good[:2], " "), good]
    req = spark.createDataFrame([(f"00{i % 6 + 1}", i, 1, *c) for i, c in enumerate(cases)],
                                "CustID string, n int, provider_choice int, card_no string, "
                                "expiry string, cvv string")
    got = {r.n: r.card_result for r in B.card_check(req, AS_OF).collect()}
    assert [got[i] for i in range(8)] == ["invalid_card", "invalid_card", "bad_format", "invalid_cvv",
                                          "invalid_card", "bad_format", "invalid_cvv", "ok"]


def test_only_settled_requests_are_charged(spark):
    rentals, cars = frames(spark)
    card = ("4000 0000 0000 0002", "0630", "345")
    req = spark.createDataFrame([
        ("001", 3, 5, None, None, None), ("002", 2, 1, None, None, None), ("003", 1, 1, *card),
        ("004", 4, 1, None, None, None), ("005", 2, 7, None, None, None),
        ("006", 6, 1, None, None, None)], REQ_S)
    done, updated = B.billing_run(rentals, cars, req, AS_OF)
    assert {r.CustID: r.Balance for r in updated.collect()} == {
        "001": "RM 35.00", "002": "RM275", "003": "RM800", "004": "RM600", "005": "RM700",
        "006": "RM400", "007": "RM 10.00"}
    got = {r.CustID: (r.outcome, r.invoice) for r in done.collect()}
    assert {c: o for c, (o, _) in got.items()} == {
        "001": "SETTLED", "002": "INSUFFICIENT", "003": "PAID", "004": "UNPAID",
        "005": "INVALID_PROVIDER", "006": "INVALID_CHOICE"}
    assert {c for c, (_, i) in got.items() if i is not None} == {"001", "003", "004"}
    assert got["001"][1].split("\n") == PAID_DOCUMENT
    assert got["004"][1].split("\n") == UNPAID_DOCUMENT


BAR = "=" * 100
PAID_DOCUMENT = [
    BAR,
    "                                               SOCAR                                                ",
    "                                           RENTAL INVOICE                                           ",
    BAR,
    "                                          CUSTOMER DETAILS                                          ",
    BAR,
    "Name                : n1",
    "Address             : 001 Example Street",
    "Phone               : 555-001",
    "IC No               : IC-001",
    "Startdate           : 2024-12-01",
    "Enddate             : 2024-12-02",
    BAR,
    "                                           RENTAL DETAILS                                           ",
    BAR,
    "Brand               : Perodua",
    "Type                : Axia",
    "Plate Number        : P1",
    "Price/day           : RM120",
    "Days rent           : 2",
    BAR,
    "Status              :                                                                       PAID",
    "Grand Total         :                                                                    RM 240.00",
    "Deposit             :                                                                    RM 80.00",
    BAR]
UNPAID_DOCUMENT = [
    *PAID_DOCUMENT[:6],
    "Name                : n4",
    "Address             : 004 Example Street",
    "Phone               : 555-004",
    "IC No               : IC-004",
    "Startdate           : 2024-01-01",
    "Enddate             : 2024-01-03",
    *PAID_DOCUMENT[12:19],
    "Days rent           : 3",
    BAR,
    "Status              :                                                                       UNPAID",
    "Grand Total         :                                                                    RM 360.00",
    "Deposit             :                                                                    RM 120.00",
    BAR]


def test_detail_screens(spark):
    rentals, cars = frames(spark)
    r = B.quote(rentals, cars).where("CustID = '003'").select(
        B.customer_screen().alias("c"), B.quote_screen().alias("q")).first()
    assert r.c.split("\n")[:6] == PAID_DOCUMENT[:6] and r.c.split("\n")[-1] == BAR
    lines = r.q.split("\n")
    assert lines[0] == PAID_DOCUMENT[13] and lines[-1] == BAR
    assert lines[-3] == "Grand Total         :" + " " * 69 + " RM 320.00"
    assert lines[-2] == "Deposit             :" + " " * 70 + " RM 106.67"


def test_no_invoice_without_a_car(spark):
    rentals, cars = frames(spark)
    req = spark.createDataFrame([("007", 4, 1, None, None, None)], REQ_S)
    done, _ = B.billing_run(rentals, cars, req, AS_OF)
    assert [r.invoice for r in done.collect()] == [None]
