"""Stages of the corpus pipeline, one by one and together."""

import importlib
import os
import shutil
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline as cp

from ..conftest import ROOT, SMALL
from .test_line_dedup import brute as brute_lines
from .test_ngram_join import brute as brute_near
from .test_packing import check_sequences, expected_pieces
from .test_pii import plain


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SMALL}/documents.parquet")


def test_stages():
    assert [n for n, _ in cp.STAGES] == ["language_id", "line_dedup", "ngram_jaccard", "pii",
                                         "best_fit_packing"]
    assert __spark_entry__.queries()["pipeline"] is cp.run and "pipeline" not in __spark_entry__.oracle_sql()


def test_each_stage_on_the_table(spark, docs):
    full = [tuple(r) for r in docs.collect()]
    lang = cp.language_stage(spark, docs, SMALL)
    assert lang.columns == docs.columns and lang.count() >= 0.95 * len(full)

    lines = cp.line_stage(spark, docs, SMALL)
    want = {r[0]: r[1] for r in brute_lines([r[:4] for r in full], 10) if not 0 < r[2] == r[3]}
    assert lines.columns == docs.columns
    assert {r.doc_id: r.text for r in lines.collect()} == want
    assert all(r.n_chars == len(r.text) for r in lines.collect())

    near = cp.near_stage(spark, docs, SMALL)
    want = sorted(i for i, n, c in brute_near([r[:2] for r in full], 5, 80) if i == c)
    assert near.columns == docs.columns and sorted(r.doc_id for r in near.collect()) == want

    clean = {r.doc_id: r.text for r in cp.pii_stage(spark, docs, SMALL).collect()}
    assert len(clean) == len(full)
    for r in full:
        assert not plain(clean[r[0]]) if plain(r[1]) else clean[r[0]] == r[1]

    packed = cp.packing_stage(spark, docs, SMALL).collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == sorted(
        x for r in full for x in expected_pieces(r[0], r[1]))
    check_sequences(packed)


EDGE_ROWS = [(1, None, None, None), (2, "", "en", "s"), (3, "the same text of a copy in a few words", "en", "s"),
             (3, "the same text of a copy in a few words", "en", "s"), (None, "no id at all here", "en", None),
             (5, "the same text of a copy in a few words", None, "t"), (6, "12 34", "xx", "s"),
             (7, "mail a@b.co or +1 555 123 4567 now", "en", "s"), (8, "long " * 9000, "en", "s")]


@pytest.mark.parametrize("rows", [EDGE_ROWS, []])
def test_edges_of_every_stage(spark, docs_of, rows):
    df = docs_of(rows).withColumn("kind", F.lit("clash")).withColumn("n_lines", F.lit(1))
    for name, stage in cp.STAGES:
        out = stage(spark, df, SMALL)
        got = out.collect()
        assert bool(rows) or not got
        if name != "best_fit_packing":
            assert out.columns == list(cp.COLUMNS)
        if name == "ngram_jaccard" and rows:
            assert sorted((r.doc_id or -1) for r in got) == [-1, 1, 2, 3, 6, 7, 8]
        if name == "pii" and rows:
            assert len(got) == len(rows)
            assert {r.doc_id: r.text for r in got}[7] == "mail [EMAIL] or [PHONE] now"


def test_near_copies_without_ids_and_labels(spark, docs_of):
    text = "the same text of a copy in a few words"
    rows = [(None, text, None, "s"), (None, text, None, "t"), (7, text, None, "s"), (7, text + " more", None, "s"),
            (8, "another text that is like none of the others here", None, "s"),
            (8, "a third one under the id of the second but unlike it", None, "s"), (9, "12 34", None, "s"),
            (10, None, None, "s"), (11, text, None, "s"), (11, text, None, "s")]
    got = sorted((r.doc_id, r.text) for r in cp.near_stage(spark, docs_of(rows), SMALL).collect() if r.text)
    assert [i for i, _ in got if i != 7] == [8, 8, 9]
    assert sum(i == 7 for i, _ in got) in (1, 2) and all(i is not None for i, _ in got)
    left = cp.language_stage(spark, docs_of(rows), SMALL).collect()
    assert len(left) == len(rows) - 2 and all(r.text and any(c.isalpha() for c in r.text) for r in left)


def test_run(spark):
    rows = cp.run(spark, SMALL).collect()
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    assert 0.6 * n < len({r.doc_id for r in rows}) < n
    check_sequences(rows)


def test_the_rest_works_without_this_subpackage(tmp_path):
    """A copy without the llm folders and the pipeline still imports."""
    for d in ("tessera", "tests", "tools"):
        shutil.copytree(os.path.join(ROOT, d), tmp_path / d,
                        ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(os.path.join(ROOT, "__spark_entry__.py"), tmp_path)
    code = ("import __spark_entry__ as e; q = e.queries(); "
            "assert q and not any(n.startswith('op') or n == 'pipeline' for n in q); e.oracle_sql()")
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True,
                   env={k: v for k, v in os.environ.items() if k != "PYTHONPATH"})
    assert importlib.util.find_spec("tessera.llm.queries")


def test_near_stage_sends_sets_of_near_texts_only(spark, docs_of, monkeypatch):
    """Texts of few words share n-grams by chance with most others."""
    import random

    from tessera.llm import ngram_join
    rng = random.Random(13)
    texts = [" ".join(rng.choices("abcdefgh", k=120)) for _ in range(200)]
    near = [" ".join([*t.split()[:-1], "z"]) for t in texts[:10]]
    sent, real = {}, ngram_join.saved

    def saved(df, name):
        out = real(df, name)
        sent[name] = out.count()
        return out
    monkeypatch.setattr(ngram_join, "saved", saved)
    out = cp.near_stage(spark, docs_of(texts + near), "")
    assert sorted(r.doc_id for r in out.collect()) == list(range(200))
    assert 20 <= sent["members"] <= 40
