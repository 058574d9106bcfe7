"""Runs equal an exhaustive search over all periods, whatever the chunks."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import word_runs as W
from tessera.llm.queries import op11_word_runs

from ..conftest import SMALL
from .conftest import EDGES

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, shortest=24, copies=3):
    least = {}
    for q in range(1, len(w) // copies + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            s = i
            while i + q < len(w) and w[i] == w[i + q]:
                i += 1
            if i + q - s >= max(shortest, copies * q):
                least[s, i + q] = min(q, least.get((s, i + q), q))
    return sorted((s, e - s, q) for (s, e), q in least.items())


def collapsed(w, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(x for i, x in enumerate(w) if i not in gone)


def words_of(rng, n, k):
    w = []
    while len(w) < n:
        if rng.random() < 0.5:
            unit = [rng.randrange(k) for _ in range(rng.randint(1, 60))]
            w += (unit * rng.randint(1, 12))[:rng.randint(1, 200)]
        else:
            w += [rng.randrange(k) for _ in range(rng.randint(1, 40))]
    return w


@pytest.mark.parametrize("chunk", [1, 7, 100, 4096])
def test_against_exhaustive_search(chunk):
    rng, powers = random.Random(chunk), W.Powers()
    for _ in range(60):
        w = words_of(rng, rng.randint(0, 400), rng.choice([1, 2, 3, 50]))
        for shortest, copies in ((24, 3), (3, 3), (40, 4)):
            c = W.Catchers(powers, shortest, copies)
            for lo in range(0, len(w), chunk):
                c.append(np.array(w[lo:lo + chunk]))
            assert c.finish() == brute(w, shortest, copies)


def test_long_texts_of_few_words():
    powers = W.Powers()
    assert W.runs_of([b"a"] * 100_000, powers) == [(0, 100_000, 1)]
    fib = [b"a", b"ab"]
    while len(fib[-1]) < 1500:
        fib.append(fib[-1] + fib[-2])
    w = list(fib[-1].decode())
    assert W.runs_of(w, powers) == brute(w)
    with pytest.raises(ValueError):
        W.Catchers(powers, 24, 2)


def test_texts(spark, docs_of):
    rng = random.Random(3)
    texts = [*EDGES, "x y " * 50, "a\x1cb " * 30, "\n".join(["one two three four"] * 9) + " end",
             "p q r s t " * 5, *[" ".join(map(str, words_of(rng, 200, 4))) for _ in range(5)]]
    df = docs_of([*texts, texts[-1]]).withColumn("runs", F.lit("clash"))
    df = df.unionByName(df.limit(0)).union(
        df.where("doc_id = 20").withColumn("doc_id", F.lit(None).cast("long")))
    rows = W.find_runs(df).collect()
    assert len(rows) == len(texts) + 2
    for r in rows:
        t = texts[20] if r.doc_id is None else [*texts, texts[-1]][r.doc_id]
        w = WORD.findall(t or "")
        exp = brute(w)
        assert (r.n_words, [tuple(x) for x in r.runs]) == (len(w), exp)
        assert r.collapsed == collapsed(w, exp)
    assert W.find_runs(docs_of([])).collect() == []


def test_query_on_table(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    got = {r.doc_id: r for r in op11_word_runs(spark, SMALL).collect()}
    assert len(got) == len(docs)
    some = 0
    for d in docs:
        w = WORD.findall(d.text or "")
        h, n = zlib.crc32(str(d.doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n > 4000:                       # the plain search is quadratic
            continue
        runs = brute(w)
        r = got[d.doc_id]
        some += bool(runs)
        assert r.n_runs == len(runs)
        text = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert r.runs_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(collapsed(w, runs).encode()).hexdigest()
        if runs:
            s, m, q = min(runs, key=lambda x: (-x[1] / x[2], x[0], x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (s, m, q, 1000 * m // q)
        else:
            assert (r.start, r.length, r.period, r.exponent_milli) == (None,) * 4
    assert some > 5
