"""Operators against brute force, including a group holding a third of the rows."""

import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tessera.operators import aggregates as agg
from tessera.operators import joins, profile, relational as rel, windows


def rows(df, *cols):
    return sorted(tuple(r) for r in df.select(*cols).collect())


def skewed_frame(spark, n=3000, seed=7):
    rnd = random.Random(seed)
    data = []
    for i in range(n):
        hot = i % 3 == 0                        # a third of all rows in one group
        key = "HOT" if hot else f"k{rnd.randint(0, 300)}"
        addr = None if rnd.random() < 0.2 else f"addr{rnd.randint(0, 3)}"
        data.append((i * 7 + 3, key, addr, rnd.choice([1.0, 2.0, 3.0]),
                     None if rnd.random() < 0.1 else str(rnd.randint(0, 50)),
                     rnd.randint(0, 20)))
    return spark.createDataFrame(data, "id long, g string, addr string, price double, v string, d int")


def test_running_total_matches_window(spark):
    df = skewed_frame(spark)
    got = windows.running_total(df, "g", "d", "v", "rt")
    w = Window.partitionBy("g").orderBy("d")     # default RANGE frame: ties share
    exp = df.withColumn("rt", F.sum(F.col("v").try_cast("int").cast("bigint")).over(w))
    assert rows(got, "id", "rt") == rows(exp, "id", "rt")


def test_running_total_last_value_is_group_sum(spark):
    df = skewed_frame(spark)
    got = windows.running_total(df, "g", "d", "v", "rt")
    last = got.groupBy("g").agg(F.max("rt").alias("m"))
    tot = df.groupBy("g").agg(F.sum(F.col("v").try_cast("int")).alias("m"))
    assert rows(last, "g", "m") == rows(tot, "g", "m")


def test_number_rows_matches_row_number(spark):
    df = skewed_frame(spark)
    keys = ["g", "addr", "price"]
    got = windows.number_rows(df, keys, "id")
    exp = df.withColumn("row_num", F.row_number().over(Window.partitionBy(*keys).orderBy("id")))
    assert rows(got, "id", "row_num") == rows(exp, "id", "row_num")


def test_dedupe_plus_duplicates_is_everything(spark):
    df = skewed_frame(spark)
    keys = ["g", "addr", "price"]
    kept = windows.dedupe_by_key(df, keys, "id")
    dups = windows.duplicates(df, keys, "id")
    assert kept.count() + dups.count() == df.count()
    first = df.groupBy(*keys).agg(F.min("id").alias("id"))
    assert rows(kept, "id") == rows(first, "id")
    assert set(kept.columns) == set(df.columns)


def test_fill_from_group_smallest_id(spark):
    df = skewed_frame(spark)
    got = joins.fill_from_group(df, "g", "id", "addr").toPandas()
    pdf = df.toPandas()
    best = pdf.dropna(subset=["addr"]).sort_values("id").groupby("g")["addr"].first()
    exp = pdf["addr"].fillna(pdf["g"].map(best))
    assert dict(zip(got.id, got.addr)) == dict(zip(pdf.id, exp))


def test_fill_candidates_counts_match_pairs(spark):
    df = skewed_frame(spark, n=600)
    got = {r.id: r for r in joins.fill_candidates(df, "g", "id", "addr").collect()}
    pdf = df.toPandas()
    pairs = pdf.merge(pdf, on="g")
    pairs = pairs[(pairs.id_x != pairs.id_y) & pairs.addr_x.isna()]
    cnt = pairs.groupby("id_x").size()
    cnt_v = pairs.dropna(subset=["addr_y"]).groupby("id_x").size()
    for i, n in cnt.items():
        assert got[i].n_partners == n
        assert got[i].n_partners_with_value == cnt_v.get(i, 0)


def test_class_share_sums_to_100(spark):
    df = skewed_frame(spark)
    s = agg.class_share(df, "addr").agg(F.sum("Percentage")).first()[0]
    nulls = df.filter(F.col("addr").isNull()).count() / df.count() * 100
    assert abs(s + nulls - 100) < 1e-9


def test_monthly_counts_fill_gaps(spark):
    df = spark.createDataFrame([("2020-01-05", "a"), ("2020-01-09", None), ("2020-04-01", "b")],
                               "d string, c string").select(F.to_date("d").alias("d"), "c")
    got = {r.month_end.isoformat(): r.n for r in agg.monthly_counts(df, "d", "c").collect()}
    assert got == {"2020-01-31": 1, "2020-02-29": 0, "2020-03-31": 0, "2020-04-30": 1}


def test_corr_matrix(spark):
    rnd = np.random.default_rng(3)
    x = rnd.normal(size=200)
    y = x * 0.3 + rnd.normal(size=200)
    df = spark.createDataFrame(pd.DataFrame({"x": x, "y": y}))
    m = {(r.col_a, r.col_b): r.r for r in agg.corr_matrix(df, ["x", "y"]).collect()}
    assert abs(m[("x", "y")] - np.corrcoef(x, y)[0, 1]) < 1e-12 and m[("x", "x")] == 1.0


def test_top_k_per_group_split_is_exact(spark):
    rnd = random.Random(5)
    data = [(rnd.choice("ab"), f"t{rnd.randint(0, 400)}") for _ in range(5000)]
    tok = spark.createDataFrame(data, "grp string, token string")
    counts = tok.groupBy("grp", "token").agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("n").desc(), F.col("token").asc()]
    got = agg.top_k_per_group(counts, "grp", order, 15, split_on="token", splits=8)
    pdf = counts.toPandas().sort_values(["grp", "n", "token"], ascending=[True, False, True])
    exp = pdf.groupby("grp").head(15)
    assert rows(got, "grp", "token", "n") == sorted(map(tuple, exp[["grp", "token", "n"]].values))


def test_exact_quantiles_with_hot_value(spark):
    rnd = np.random.default_rng(1)
    vals = np.concatenate([rnd.normal(0, 1, 2000), np.full(1500, 5.0), rnd.exponential(3, 2000)])
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    probs = [0, 0.1, 0.25, 0.5, 0.75, 0.9, 1]
    for buckets in (2, 16, 4096):
        got = profile.exact_quantiles(df, "x", probs, buckets=buckets)
        assert np.allclose(got, np.quantile(vals, probs))


def test_exact_quantiles_with_infinities_nan_and_extremes(spark):
    inf = float("inf")
    vals = [float(i) for i in range(100)] + [inf, -inf, -inf, 1e308, -1e308, 5e-324]
    df = spark.createDataFrame([(v,) for v in [*vals, float("nan"), None]], "x double")
    ordered = sorted(vals)
    n = len(vals)
    probs = [i / (n - 1) for i in range(n)]             # every rank
    got = profile.exact_quantiles(df, "x", probs, buckets=8)
    for p, g in zip(probs, got):
        assert g in ordered[max(0, round(p * (n - 1)) - 1):round(p * (n - 1)) + 2] or \
            abs(g - ordered[round(p * (n - 1))]) < 1e-6 * abs(ordered[round(p * (n - 1))])
    only = spark.createDataFrame([(inf,), (inf,), (-inf,)], "x double")
    assert profile.exact_quantiles(only, "x", [0, 0.5, 1]) == [-inf, inf, inf]
    assert profile.exact_quantiles(df.filter("x is null"), "x", [0.5]) == [None]


@pytest.mark.parametrize("k", [8, 64, 4096])
def test_exact_quantiles_with_any_sketch_size(spark, k):
    """The sketch decides the work only: small ones miss ranks, which another
    scan finds."""
    rng = np.random.default_rng(3)
    vals = np.concatenate([rng.normal(size=4000), np.full(3000, 0.25), rng.exponential(1e6, 500)])
    ints = np.concatenate([rng.integers(-50, 50, 7000), rng.integers(-2 ** 60, 2 ** 60, 500)])
    df = spark.createDataFrame(list(zip(vals.tolist(), ints.tolist())), "x double, i bigint")
    probs = [0, 0.01, 0.25, 0.5, 0.75, 0.999, 1]
    got = profile.exact_quantiles_of(df, ["x", "i"], probs, buckets=16, k=k)
    assert np.allclose(got["x"], np.quantile(vals, probs))
    assert np.allclose(got["i"], np.quantile(ints.astype(float), probs), rtol=1e-12)


def test_exact_quantiles_scan_the_table_twice(spark, monkeypatch):
    scans = []
    for name in ("_bracketed", "_zone_counts"):
        def counted(*a, _f=getattr(profile, name), _n=name):
            scans.append(_n)
            return _f(*a)
        monkeypatch.setattr(profile, name, counted)
    df = spark.range(100000).selectExpr("id * 37 % 100003 AS a", "sqrt(id) AS b")
    got = profile.exact_quantiles_of(df, ["a", "b"], [0.25, 0.5, 0.75])
    rows = df.toPandas()
    assert np.allclose(got["a"], rows.a.quantile([0.25, 0.5, 0.75]))
    assert np.allclose(got["b"], rows.b.quantile([0.25, 0.5, 0.75]))
    assert scans == ["_bracketed", "_zone_counts"]


def test_exact_quantiles_of_wide_integers(spark):
    lo, hi = -9 * 10**18, 9 * 10**18
    vals = [lo, hi, 0, 1, 2, hi - 1, hi - 2, lo + 1]
    df = spark.createDataFrame([(v, float(i)) for i, v in enumerate(vals)], "a long, b double")
    probs = [i / 7 for i in range(8)]
    for buckets in (2, 4096):
        got = profile.exact_quantiles_of(df, ["a", "b"], probs, buckets)
        assert got["a"] == [float(v) for v in sorted(vals)]
        assert np.allclose(got["b"], range(8))


def test_profile_like_describe(spark):
    pdf = pd.DataFrame({"num": [1.0, 2.0, 2.0, 10.0, None], "txt": ["a", "b", "b", None, "c"]})
    df = spark.createDataFrame(pdf)
    p = {r.column: r for r in profile.profile(df).collect()}
    d = pdf.describe(include="all")
    assert p["num"]["count"] == 4 and abs(p["num"].mean - d["num"]["mean"]) < 1e-12
    assert abs(p["num"].std - d["num"]["std"]) < 1e-12
    assert (p["num"].q1, p["num"].q2, p["num"].q3) == (d["num"]["25%"], d["num"]["50%"], d["num"]["75%"])
    assert (p["txt"]["count"], p["txt"].unique, p["txt"].top, p["txt"].freq) == (4, 3, "b", 2)


def test_schema_summary(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(profile.schema_summary(df), "column", "type", "non_null") == [
        ("a", "int", 2), ("b", "string", 1)]


def test_side_by_side_pads_short_lists(spark):
    ranked = spark.createDataFrame([("p", 1, "x"), ("p", 2, "y"), ("n", 1, "z")],
                                   "lst string, rank int, tok string")
    got = rows(joins.side_by_side(ranked, "lst", "rank", "tok", ["p", "n"]), "rank", "p", "n")
    assert got == [(1, "x", "z"), (2, "y", None)]


def test_lookup_flags_misses(spark):
    recs = spark.createDataFrame([("1", "a")], "id string, v string")
    ids = spark.createDataFrame([("1",), ("9",)], "id string")
    assert rows(rel.lookup(recs, ids, "id"), "id", "v", "found") == [("1", "a", True), ("9", None, False)]


def test_union_by_name_fills_missing(spark):
    a = spark.createDataFrame([(1, "x")], "k int, a string")
    b = spark.createDataFrame([(2, "y")], "k int, b string")
    u = rel.union_by_name(a, b)
    assert sorted(u.columns) == ["a", "b", "k"] and u.count() == 2


def test_running_total_over_a_compact_table(spark):
    df = skewed_frame(spark).groupBy("g", "d").agg(F.min("id").alias("id"), F.max("v").alias("v"))
    a = windows.running_total(df, "g", "d", "v", "rt", one_row_per_key=True)
    b = windows.running_total(df, "g", "d", "v", "rt")
    assert rows(a, "id", "rt") == rows(b, "id", "rt")


def test_substring_match_is_literal(spark):
    df = spark.createDataFrame([("xa_bx",), ("axb",), ("50%",), ("501",), ("A_B",), (None,)], "s string")
    assert rows(rel.where_contains_ci(df, "s", "a_b"), "s") == [("A_B",), ("xa_bx",)]
    assert rows(rel.where_contains_ci(df, "s", "50%"), "s") == [("50%",)]


def test_order_by_is_ordered_nulls_first(spark):
    df = skewed_frame(spark)
    got = [(r.addr, r.id) for r in rel.order_by(df, "addr", "id").collect()]
    assert got == sorted(got, key=lambda t: (t[0] is not None, t[0] or "", t[1]))
    got = [r.id for r in df.orderBy(F.col("id").desc()).collect()]
    assert got == sorted(got, reverse=True)


def test_number_rows_spreads_a_hot_group(spark):
    df = spark.range(4000).select(F.col("id"), F.lit("only").alias("g"))
    got = windows.number_rows(df, ["g"], "id")
    assert [r.row_num for r in got.orderBy("id").collect()] == list(range(1, 4001))
    assert got.withColumn("p", F.spark_partition_id()).select("p").distinct().count() > 1
    assert windows.number_rows(df.limit(0), ["g"], "id").count() == 0


def test_running_total_by_date_with_nulls_matches_window(spark):
    import datetime as dt
    rnd = random.Random(11)
    data = []
    for i in range(4000):
        g = "HOT" if i % 3 == 0 else (None if i % 50 == 1 else f"g{rnd.randint(0, 5)}")
        day = dt.date(2020, 1, 1) + dt.timedelta(days=rnd.randint(0, 500))
        val = None if rnd.random() < 0.3 else str(rnd.randint(0, 9))
        data.append((i, g, day, val))
    df = spark.createDataFrame(data, "id long, g string, d date, v string")
    # leading nulls: a partition whose first months carry no value
    df = df.union(spark.createDataFrame([(9001, "late", dt.date(2020, 1, 5), None),
                                         (9002, "late", dt.date(2020, 3, 5), "4")],
                                        "id long, g string, d date, v string"))
    got = windows.running_total(df, "g", ["g", "d"], "v", "rt")
    w = Window.partitionBy("g").orderBy("g", "d")
    exp = df.withColumn("rt", F.sum(F.col("v").try_cast("int").cast("bigint")).over(w))
    assert rows(got, "id", "rt") == rows(exp, "id", "rt")


def test_number_rows_bimodal_ids_and_null_order(spark):
    # ids in two far-apart blocks (as the planted copies) and some null ids
    data = [(None if i % 97 == 0 else (i if i % 2 else 10**9 + i), "HOT" if i % 3 else f"k{i % 7}")
            for i in range(3000)]
    df = spark.createDataFrame(data, "id long, g string").withColumn("row", F.monotonically_increasing_id())
    got = windows.number_rows(df, ["g"], "id")
    exp = df.withColumn("row_num", F.row_number().over(Window.partitionBy("g").orderBy("id")))
    # null ids tie with each other: compare the numbers given to non-null rows exactly
    # and the multiset of numbers per group
    g1 = {r.row: r.row_num for r in got.collect() if r.id is not None}
    e1 = {r.row: r.row_num for r in exp.collect() if r.id is not None}
    assert g1 == e1
    assert rows(got, "g", "row_num") == rows(exp, "g", "row_num")


def test_running_total_by_range_splits_a_hot_partition(spark):
    import random

    from tessera.operators.windows import running_total_by_range
    rng = random.Random(5)
    rows = [("hot" if i % 3 else rng.choice(["a", "b", None]), rng.choice([i, i // 7, None]),
             rng.choice([None, rng.randint(-9, 9)])) for i in range(1500)]
    rows += [("lead", i, None if i < 5 else 1) for i in range(9)]
    df = spark.createDataFrame(rows, "p string, o int, v long")
    got = sorted(running_total_by_range(df, "p", "o", "v", "s").collect(), key=repr)
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    exp = df.withColumn("s", F.sum("v").over(Window.partitionBy("p").orderBy("o"))).collect()
    assert got == sorted(exp, key=repr)
    assert running_total_by_range(df.limit(0), "p", "o", "v", "s").collect() == []


def test_lookup_tables_are_planned_as_broadcasts(spark):
    from tessera.operators import text as T
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    plan = T.tag_tokens(docs, "text")._jdf.queryExecution().sparkPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "LocalTableScan" in plan
