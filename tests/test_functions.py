"""Scalar column functions on tiny inline frames, one check per edge case."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions import strings as S
from tessera.functions.arrays import argmax, ranked_indices
from tessera.functions.conditions import expiry_status, valid_card, valid_cvv
from tessera.functions.dates import rental_days, review_date
from tessera.functions.numeric import (bin_index, bin_label, deposit, parse_error,
                                       parse_or_default, percent, sentiment_label, to_int_trunc)


def col(spark, values, f, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"c {dtype}")
    return [r[0] for r in df.select(f(F.col("c"))).collect()]


def test_split_before_after_first(spark):
    vals = ["1 Main ST, Town", "no comma", None, "a,b,c"]
    assert col(spark, vals, S.before_first) == ["1 Main ST", None, None, "a"]
    assert col(spark, vals, S.after_first) == [" Town", None, None, "b,c"]


def test_part_from_right_four_part_rule(spark):
    vals = ["1 A ST, CITY, STATE", "CITY, STATE", "a.b.c.d.e", "x,,y", None]
    assert col(spark, vals, lambda c: S.part_from_right(c, 1)) == [" STATE", " STATE", None, "y", None]
    assert col(spark, vals, lambda c: S.part_from_right(c, 3)) == ["1 A ST", None, None, "x", None]
    # an empty part is null
    assert col(spark, vals, lambda c: S.part_from_right(c, 2))[3] is None


def test_recode_keeps_other_values(spark):
    got = col(spark, ["Y", "N", "Yes", None], lambda c: S.recode(c, {"Y": "Yes", "N": "No"}))
    assert got == ["Yes", "No", "Yes", None]


def test_rating_needs_decimal(spark):
    got = col(spark, ["Rated 4.5 of 5", "Rated 4 of 5", None], lambda c: to_int_trunc(S.rating_value(c)))
    assert got == [4, None, None]


def test_first_contained_list_order(spark):
    got = col(spark, ["Jalan 1, Kuala Lumpur", "Penang Road Miri", "nowhere"],
              lambda c: S.first_contained(c, ["Ipoh", "Kuala Lumpur", "Miri", "Penang"]))
    assert got == ["Kuala Lumpur", "Miri", None]


def test_pad_min_never_cuts(spark):
    got = col(spark, ["ab", "x" * 10], lambda c: F.length(S.pad_min(c, 5)))
    assert got == [5, 10]


def test_words_are_unicode(spark):
    got = col(spark, ["Café, naïve_x 42!"], S.words)
    assert got == [["Café", "naïve_x", "42"]]
    assert col(spark, ["A b, c"], S.word_count) == [3]


def test_money_round_trip(spark):
    assert col(spark, ["RM275", "RM 35.00", "RMx"], S.parse_money) == [
        __import__("decimal").Decimal("275.00"), __import__("decimal").Decimal("35.00"), None]
    assert col(spark, ["35"], lambda c: S.format_money(c.cast("decimal(12,2)"))) == ["RM 35.00"]
    assert col(spark, ["secret"], S.mask) == ["******"]


def test_percent_and_zero_division(spark):
    df = spark.createDataFrame([("5", 10.0), ("1", 0.0), (None, 2.0)], "a string, b double")
    assert [r[0] for r in df.select(percent("a", "b")).collect()] == [50.0, None, None]


def test_sentiment_label(spark):
    assert col(spark, [5, 3, 1, None], sentiment_label, "int") == ["Positive", "Neutral", "Negative", None]


def test_bins(spark):
    got = col(spark, [0, 199, 200, 1999, 2000, -1], lambda c: bin_index(c), "int")
    assert got == [0, 0, 1, 9, None, None]
    assert col(spark, [0, 1, 9], bin_label, "int") == ["0-200", "201-400", "1801-2000"]


def test_parse_or_default(spark):
    assert col(spark, [" ", "12", "1/2"], lambda c: parse_or_default(c, "int", 7)) == [7, 12, None]
    assert col(spark, [" ", "12", "1/2"], lambda c: parse_error(c, "int")) == [False, False, True]


def test_review_date_rules(spark):
    texts = ["2 weeks ago", "1 week 3 days", "3 days ago", "yesterday", "today", "5 March 2019",
             "", "someday"]
    got = col(spark, texts, lambda c: review_date(c, "2024-12-01"))
    assert got == [dt.date(2024, 11, 17), dt.date(2024, 11, 24), dt.date(2024, 11, 28),
                   dt.date(2024, 11, 30), dt.date(2024, 12, 1), dt.date(2019, 3, 5), None, None]


def test_rental_days_inclusive(spark):
    df = spark.createDataFrame([("2024-12-01", "2024-12-02")], "s string, e string")
    assert df.select(rental_days(F.to_date("s"), F.to_date("e"))).first()[0] == 2


def test_deposit_floor_and_exact(spark):
    df = spark.createDataFrame([(320,)], "t int").select(F.col("t").cast("decimal(12,2)").alias("t"))
    r = df.select(deposit("t", "floor").alias("f"), deposit("t", "exact").cast("decimal(12,2)").alias("x")).first()
    assert float(r.f) == 106.0 and float(r.x) == 106.67


def test_card_rules(spark):
    assert col(spark, ["4000 0000 0000 0002", "4000 0000 0000 000", "40000000000000a2"], valid_card) == [True, False, False]
    assert col(spark, ["345", "012", "99", "1000"], valid_cvv) == [True, False, False, False]
    exp = col(spark, ["0125", "1324", "12/30", "0630", "1124", "1224"],
              lambda c: expiry_status(c, "2024-12-01", allow_slash=False))
    assert exp == ["ok", "bad_month", "bad_format", "ok", "expired", "ok"]
    assert col(spark, ["12/30"], lambda c: expiry_status(c, "2024-12-01", allow_slash=True)) == ["ok"]


def test_argmax_and_ranking(spark):
    df = spark.createDataFrame([([0.1, 0.7, 0.7, 0.2],)], "a array<double>")
    r = df.select(argmax("a").alias("m"), ranked_indices("a").alias("r")).first()
    assert r.m == 1 and r.r == [1, 2, 3, 0]
    assert r.r[0] == r.m   # argmax = first of the ranking


def test_title(spark):
    assert col(spark, ["MACHINERY", "o'neil-x"], S.title) == ["Machinery", "O'neil-x"]
