"""Measures against plain Python, host verdicts, edges."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tessera.llm import host_quality
from tessera.llm.queries import op6_host_quality

from ..conftest import SMALL
from .conftest import EDGES


def brute(t):
    t = t or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    g = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    many = {x for x in g if g.count(x) > 1} if len(g) < 300 else {
        x for x, n in __import__("collections").Counter(g).items() if n > 1}
    hit = {i + k for i, x in enumerate(g) if x in many for k in range(3)}
    lines = [s for s in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", s)]
    base = len(w) < 50 or 100 * len(hit) > 50 * len(w)
    return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)),
            len(hit), base)


COLS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def test_measures(docs_of):
    rng = random.Random(2)
    texts = EDGES + [" ".join(rng.choice("abcdefg") for _ in range(rng.randint(0, 120)))
                     for _ in range(60)] + ["a b\na b\n\n \na b \n#*$%&|<>"]
    df = docs_of(texts).withColumn("n_words", F.lit("mine")).withColumn("failed", F.lit(1))
    rows = host_quality.host_rules(df).orderBy("doc_id").collect()
    for r, t in zip(rows, texts):
        assert tuple(r[c] for c in COLS) == brute(t), t
        assert not (r.kept and r.base_failed)


def test_query_on_table(spark):
    rows = {r.doc_id: r for r in op6_host_quality(spark, SMALL).collect()}
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    for t in texts:
        assert tuple(rows[t.doc_id][c] for c in COLS) == brute(t.text)


GOOD = " ".join(f"word{i}" for i in range(80))


def test_host_verdicts(docs_of):
    rows = [(i, "junk", "en", "bad") for i in range(60)] + [(100, GOOD, "en", "bad")]
    rows += [(200 + 100 * h + i, f"{GOOD} {i}", "en", f"h{h}") for h in range(20) for i in range(30)]
    rows += [(9000, "junk", "en", "one"), (9001, f"{GOOD} x", "en", None), (9002, None, "en", None)]
    got = {r.doc_id: r for r in host_quality.host_rules(docs_of(rows)).collect()}
    assert not got[100].kept and not got[100].base_failed      # its host is rejected
    assert got[200].kept and got[9001].kept and not got[9002].kept
    assert got[9001].host_rate is None
    assert 0 < got[9000].host_rate < 1                         # one failure of one is shrunk


def test_prior(spark):
    alike = spark.createDataFrame([(100, 10)] * 10, "n long, failed long")
    a, b = host_quality.beta_prior(alike)
    assert a / (a + b) == pytest.approx(0.1) and a + b == pytest.approx(host_quality.MAX_STRENGTH)
    apart = spark.createDataFrame([(100, 0), (100, 100)] * 10, "n long, failed long")
    a, b = host_quality.beta_prior(apart)
    assert a / (a + b) == pytest.approx(0.5) and a + b == pytest.approx(1.0)
    assert host_quality.beta_prior(alike.limit(0)) == (1.0, 1.0)


def test_empty_table_and_repeats(docs_of):
    assert host_quality.host_rules(docs_of([])).count() == 0
    assert host_quality.host_rules(docs_of([(1, GOOD, None, "s")] * 3)).count() == 3
