"""Held-out accuracy, rejection, and the rules of training."""

import pytest
from pyspark.sql import functions as F

from tessera.llm import language_id as L
from tessera.llm.queries import op7_language_id

from .conftest import EDGES

MEDIUM = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = op7_language_id(spark, MEDIUM).join(
        spark.read.parquet(f"{MEDIUM}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == 1000
    held = [r for r in rows if r.held_out]
    assert {r.doc_id for r in held} == {r.doc_id for r in rows if L.held_out(r.doc_id)}
    assert sum(r.lang_pred == r.lang for r in held) / len(held) > 0.96
    assert sum(r.rejected for r in held) / len(held) < 0.03
    assert all(0 <= r.score <= 1 for r in rows)


@pytest.fixture(scope="module")
def learned(spark):
    docs = spark.read.parquet(f"{MEDIUM}/documents.parquet")
    return L.train(docs.where(L.fold(F.col("doc_id")) != 0))


def test_edges(docs_of, learned):
    df = docs_of(EDGES).withColumn("score", F.lit("mine"))
    rows = L.identify(df, learned).orderBy("doc_id").collect()
    assert len(rows) == len(EDGES) and set(learned) == {"de", "en", "es", "fr"}
    for r in rows:
        if r.text is None or not any(c.isalpha() for c in r.text):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
        else:
            assert r.lang_pred in learned and 0 <= r.score <= 1


def test_prediction_reads_only_the_text(docs_of, learned):
    a = L.identify(docs_of([(1, "of the and thing to be", "fr", None)]), learned).first()
    b = L.identify(docs_of([(2, "of the and thing to be", None, "x")]), learned).first()
    assert (a.lang_pred, a.score) == (b.lang_pred, b.score)


def test_narrow_margins_are_rejected(docs_of, learned):
    rows = L.identify(docs_of(["qqq 123", "x"]), learned).collect()
    assert any(r.rejected for r in rows)


def test_training_rules(docs_of):
    copies = [(i, "the same text of a copy", "en", "s") for i in range(500)]
    other = [(1000 + i, f"autre texte {i}", "fr", "s") for i in range(20)]
    skipped = [(2000, None, "xx", "s"), (2001, "", "yy", "s"), (2002, "no label", None, "s")]
    got = L.train(docs_of(copies + other + skipped), excerpts=5, excerpt_chars=10)
    assert list(got) == ["fr", "en"]                  # most texts first; copies count once
    assert len(got["en"]) == 10 and 25 < len(got["fr"]) <= 5 * 10 + 4
    assert L.train(docs_of([])) == {}
    assert L.identify(docs_of(["a text"]), {}).first().lang_pred == "und"
    assert L.identify(docs_of([]), got).count() == 0
