"""Physical-plan properties the library relies on."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.operators import joins, relational as rel
from tessera.sources.io import read_table

from .conftest import SMALL

QUERIES = E.queries()


def plan(df) -> str:
    return df.sparkSession._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_udf_no_cartesian(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF", text)
    assert not re.search(r"CartesianProduct|BroadcastNestedLoopJoin", text)


def test_top_k_per_group_limits_before_the_shuffle(spark):
    text = plan(QUERIES["txt7_unigrams"](spark, SMALL))
    tree = text.split("\n\n")[0]
    # a partial group limit sits below the exchange feeding the final window
    assert re.search(r"Exchange[\s\S]*WindowGroupLimit", tree)


def test_global_top_k_is_take_ordered(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["prf1_first_rows"](spark, SMALL))


def test_scan_prunes_columns_and_pushes_filters(spark):
    orders = read_table(spark, f"{SMALL}/orders.parquet")
    df = rel.where_not_null(orders, "o_custkey").select("o_orderkey", F.col("o_custkey"))
    text = plan(df)
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text
    assert re.search(r"PushedFilters: \[IsNotNull\(o_custkey\)\]", text)


def test_fill_candidates_builds_no_pairs(spark):
    text = plan(QUERIES["jn2_fill_candidates"](spark, SMALL))
    tree = text.split("\n\n")[0]
    # one aggregate per group joined to the null rows: every join is an
    # equi-join whose build side is the per-group table
    assert "Join" in tree and not re.search(r"LeftSemi|Cartesian|NestedLoop", tree)


def test_fixed_tables_carry_no_hint(spark):
    table = joins.fixed_table(spark, [(i,) for i in range(10)], "a int")
    assert "hint" not in table._jdf.queryExecution().logical().toString().lower()


@pytest.mark.parametrize("name", ["set2_drop_duplicates", "num7_sentiment_label", "flt4_split_by_sentiment",
                                  "agg5_value_counts", "agg6_class_share", "agg7_mean_rounded",
                                  "agg8_group_mean", "jn4_merge_on", "srt4_top_k", "str12_word_count",
                                  "num6_bin_200", "agg10_corr_matrix"])
def test_review_texts_stay_out_of_the_shuffle(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    inputs = re.findall(r"\n\(\d+\) Exchange\nInput \[\d+\]: (.*)", text)
    assert inputs and not any("Review#" in x for x in inputs)


def test_running_total_is_one_window_without_a_join_back(spark):
    def tree(name):
        return plan(QUERIES[name](spark, SMALL)).split("\n\n")[0]
    total, join = tree("win1_running_total"), tree("jn1_join_daily")
    assert total.count("Join") == join.count("Join") and total.count("Window") == 1
