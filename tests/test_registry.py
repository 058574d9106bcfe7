"""Every registered query runs on the small tables; where an oracle exists,
its DuckDB result equals Spark's (names, row count, order-free values)."""

import duckdb
import pytest

import __spark_entry__ as E
from tessera.plans import load_all
from tessera.sources.fixtures import BASE_TABLES
from tools.compare import rows_of

from .conftest import SMALL

QUERIES, ORACLES = load_all()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in BASE_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    return con


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() == 116 and "PercentRollingPeopleVaccinated" in df.columns


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SMALL)
    got = [tuple(r) for r in df.collect()]
    if name not in ORACLES:
        assert len(got) > 0
        return
    cur = duck.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    exp = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert rows_of(df.columns, got) == rows_of(cols, exp)


def test_review_report_branches_equal_registered_queries(spark):
    from tessera.plans.review_text import review_report
    report, cleaned = review_report(spark, SMALL)
    try:
        share = {r.Label: r.Percentage for r in report["label_share"].collect()}
        exp = {r.Label: r.Percentage for r in QUERIES["agg6_class_share"](spark, SMALL).collect()}
        assert share == exp
        got = sorted((r.Label, r["rank"], r.token, r.n) for r in report["unigrams"].collect())
        exp = sorted(tuple(r) for r in QUERIES["txt7_unigrams"](spark, SMALL)
                     .select("Label", "rank", "token", "n").collect())
        assert got == exp
        assert report["polarity_means"].count() == 1
    finally:
        cleaned.unpersist()
