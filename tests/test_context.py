"""Polarity rules and two-word terms on small texts."""

import math

import pytest

from tessera.operators import collocations as C
from tessera.operators import text as T
from tessera.operators import valence as V

RULES = V.Rules({"good": 2.0, "bad": -2.5, "fine": 0.1})


def score(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "Compound int, text string")
    rows = V.polarity_in_context(df.withColumnRenamed("Compound", "i"), "text", RULES, ["i"]).collect()
    out = []
    for r in sorted(rows, key=lambda r: r.i):
        c = r.Compound
        out.append((round(c * math.sqrt(15 / (1 - c * c)), 6), r.Positive + r.Neutral + r.Negative))
    return out


def test_every_rule(spark):
    cases = {
        "good": 2.0, "a good b": 2.0, "": 0.0, "nothing else": 0.0,
        "not good": -1.5, "not x y good": -1.5, "not x y z good": 2.0,
        "very good": 2.3, "very x good": 2.225, "very x y good": 2.15, "slightly good": 1.7,
        "barely fine": 0.0, "very bad": -2.8, "not very good": -1.725,
        "GOOD": 2.0, "so GOOD": 3.0, "it is GOOD": 2.7, "good!": 2.3, "bad!!!!!!": -3.7, "!": 0.0,
        "good but bad": 1.0 - 3.75, "but good": 3.0,
    }
    got = score(spark, *cases, None)
    assert [s for s, _ in got[:-1]] == [pytest.approx(v, abs=1e-6) for v in cases.values()]
    assert got[-1] == (0.0, 0.0)
    assert all(t == pytest.approx(1.0) for (_, t), c in zip(got, cases) if any(ch.isalpha() for ch in c))


def test_pairs_leave_the_single_words(spark):
    texts = ["ice cream and ice cream", "cold ice cream", "cold tea", "the ice the cream", None, "", "tea"]
    texts += [f"w{i} v{i}" for i in range(60)]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    stop = T.stop_table(spark)
    pairs = C.pair_counts(df, "text", stop)
    counted = {(r.a, r.b): r.n for r in pairs.collect()}
    assert counted["ice", "cream"] == 3 and ("cream", "and") not in counted and ("the", "ice") not in counted
    found = C.collocations(pairs, threshold=10.0).collect()
    assert [(r.a, r.b, r.n) for r in found] == [("ice", "cream", 3)]
    n, left, right, total = 3, 3, 4, sum(counted.values())
    left, right = (sum(v for k, v in counted.items() if k[i] == w) for i, w in ((0, "ice"), (1, "cream")))
    cells = [(n, left, right), (left - n, left, total - right), (right - n, total - left, right),
             (total - left - right + n, total - left, total - right)]
    exp = 2 * sum(o * math.log(o * total / (r * c)) for o, r, c in cells if o)
    assert found[0].ratio == pytest.approx(exp)
    singles = T.counted_terms(T.tokens(df, "text"), stop)
    terms = {r.token: r.n for r in C.cloud_terms(singles, C.collocations(pairs, threshold=10.0)).collect()}
    assert terms["ice cream"] == 3 and terms["ice"] == 1 and terms["cream"] == 1 and terms["tea"] == 2
    assert C.collocations(C.pair_counts(df.limit(0), "text", stop)).collect() == []


def test_the_texts_are_read_once_for_pairs(spark, tmp_path):
    """What follows the counted pairs reads their stored table, not the texts."""
    path = str(tmp_path / "texts.parquet")
    texts = ["ice cream and ice cream", "cold ice cream", "cold tea"] + [f"w{i} v{i}" for i in range(60)]
    spark.createDataFrame([(t,) for t in texts], "text string").write.parquet(path)
    docs, stop = spark.read.parquet(path), T.stop_table(spark)
    found = C.collocations(C.pair_counts(docs, "text", stop), threshold=10.0)
    assert [(r.a, r.b, r.n) for r in found.collect()] == [("ice", "cream", 3)]
    assert not any("texts.parquet" in f for f in found.inputFiles())
    singles = T.counted_terms(T.tokens(docs, "text"), stop)
    cloud = C.cloud_weights(singles, C.pair_counts(docs, "text", stop), threshold=10.0)
    tree = cloud._jdf.queryExecution().optimizedPlan().toString()
    assert tree.count("explode") == 1 + 1      # the single words, and the pairs' two words
    assert {r.token: (r["rank"], r.weight) for r in cloud.where("rank <= 2").collect()} == \
        {"ice cream": (1, 1.0), "cold": (2, pytest.approx(2 / 3))}
