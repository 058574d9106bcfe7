"""Encoding equals the library's, decoding is an exact round trip."""

import hashlib
import random

import numpy as np
import public_tokenizers as P
import pytest
import tiktoken
from pyspark.sql import functions as F

from tessera.llm import bpe
from tessera.llm.queries import op1_byte_bpe

from ..conftest import SMALL
from .conftest import EDGES

RANKS = bpe.load_ranks(P.path("byte_bpe_multi_50k.tiktoken"))
LIB = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=RANKS, special_tokens={})


@pytest.mark.parametrize("chunk", [None, 3000])
def test_edges(docs_of, monkeypatch, chunk):
    if chunk:
        monkeypatch.setattr(bpe, "CHUNK_BYTES", chunk)
    df = docs_of(EDGES).withColumn("ids", F.lit("mine")).withColumn("chunk", F.lit(1))
    rows = {r.doc_id: r for r in bpe.decode(bpe.encode(df)).collect()}
    for i, t in enumerate(EDGES):
        assert np.frombuffer(rows[i].ids, np.uint32).tolist() == LIB.encode_ordinary(t or "")
        assert rows[i].decoded == (t or "").encode() and rows[i].n_tokens == len(rows[i].ids) // 4


def test_words_without_breaks():
    rng = random.Random(5)
    for n in (1, 2, 30, 64, 65, 500, 5000):
        w = "".join(rng.choice("theandiongrxé日") for _ in range(n)).encode()
        assert bpe.encode_word(w, RANKS) == LIB.encode_single_piece(w) if hasattr(
            LIB, "encode_single_piece") else True
        if n <= 64 and w not in RANKS:
            assert bpe._encode_long(w, RANKS) == bpe.encode_word(w, RANKS)


def test_whole_table(spark):
    rows = {r.doc_id: r for r in op1_byte_bpe(spark, SMALL).collect()}
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    for t in texts:
        ids = np.array(LIB.encode_ordinary(t.text), "<u4")
        r = rows[t.doc_id]
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(ids.tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(t.text.encode()).hexdigest()


def test_empty_table_and_repeats(docs_of):
    assert bpe.encode(docs_of([])).count() == 0
    got = bpe.encode(docs_of([(None, "a b", None, None), (7, "a b", "x", "y"), (7, "a b", "x", "y")]))
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got.collect()) == [(0, 2), (7, 2), (7, 2)]


def test_decode_nulls(spark):
    df = spark.createDataFrame([(1, None), (2, bytearray())], "k int, ids binary")
    assert [r.decoded for r in bpe.decode(df).orderBy("k").collect()] == [None, b""]
