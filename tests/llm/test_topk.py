"""Top-k search equals brute force: ties, copies, nulls and odd vectors."""

import math
import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import topk
from tessera.llm.queries import op4_topk_search

from ..conftest import SMALL


def brute(rows, is_query, k=5):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            good[i] = [math.floor(256 * x) for x in v]
    out = []
    for q in sorted(i for i in good if is_query(i)):
        s = sorted((-sum(a * b for a, b in zip(good[q], v)), i) for i, v in good.items() if i != q)
        out += [(q, r + 1, i, -n) for r, (n, i) in enumerate(s[:k])]
    return out


def run(spark, rows, **kw):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = topk.top_k(df.withColumn("score", F.lit("clash")), lambda i: i % 10 == 0, **kw)
    return sorted(tuple(r) for r in out.collect())


@pytest.mark.parametrize("small_blocks", [False, True])
def test_against_brute_force(spark, monkeypatch, small_blocks):
    if small_blocks:
        monkeypatch.setattr(topk, "QUERY_BLOCK", 7)
        monkeypatch.setattr(topk, "CANDIDATE_BLOCK", 31)
    rng = random.Random(1)
    rows = [(i, [rng.choice([0.0, 0.5, -0.25, 1.0]) for _ in range(6)]) for i in range(300)]
    rows += [(300 + i, [0.5, 0.5, 0.0, 0.0, 0.5, 0.0]) for i in range(120)]      # copies: ties
    rows += [(501, None), (510, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (520, [math.nan] * 6),
             (530, [math.inf] + [0.0] * 5), (540, []), (550, [0.5, 0.5]), (0, rows[0][1])]
    assert run(spark, rows) == brute(rows, lambda i: i % 10 == 0)


def test_few_candidates_and_empty_table(spark):
    assert run(spark, [(0, [1.0]), (1, [0.5])]) == [(0, 1, 1, 256 * 128)]
    assert run(spark, [(0, [1.0])]) == [] and run(spark, []) == []


def test_rows_are_told_apart_by_vector_not_by_id(spark):
    rows = [(50, [1.0, 0.0]), (50, [0.0, 1.0]), (1, [3.0, 0.0]), (1, [0.0, 2.0]), (2, [1.0, 1.0]),
            (None, [1.0, 1.0]), (None, [9.0, 9.0]), (50, [1.0, 0.0])]
    out = {}
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    for r in topk.top_k(df, lambda i: i % 50 == 0).collect():
        out.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score >> 16))
    assert set(out) == {50}
    first = [(1, None, 9), (2, 1, 3), (3, 2, 1), (4, None, 1), (5, 1, 0)]
    second = [(1, None, 9), (2, 1, 2), (3, 2, 1), (4, None, 1), (5, 1, 0)]
    assert sorted(out[50], key=str) == sorted(first + second, key=str)


def test_too_long_vectors_raise(spark):
    with pytest.raises(Exception, match="too long"):
        run(spark, [(0, [1e300]), (1, [1.0])])


def test_query_on_table(spark):
    rows = spark.read.parquet(f"{SMALL}/embeddings.parquet").select("vec_id", "embedding").collect()
    got = sorted(tuple(r) for r in op4_topk_search(spark, SMALL).collect())
    assert got == brute([tuple(r) for r in rows], lambda i: i % 50 == 0)
