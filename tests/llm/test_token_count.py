"""Counts equal the library's, whole tables included."""

import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

from tessera.llm.queries import op2_token_counts
from tessera.llm.token_count import count_tokens, load_ranks, prove

from ..conftest import SMALL
from .conftest import EDGES

SP = sentencepiece.SentencePieceProcessor(
    model_file=public_tokenizers.path("piece_bpe_32k.model"))


def expected(t):
    return len(SP.encode(t or ""))


def test_edges(docs_of):
    rows = count_tokens(docs_of(EDGES)).collect()
    assert [r.n_tokens for r in rows] == [expected(t) for t in EDGES]
    assert [r.n_bytes for r in rows] == [len((t or "").encode()) for t in EDGES]
    assert all(r.over_limit == (r.n_tokens > 4096) and r.n_direct <= r.n_tokens for r in rows)


def test_whole_table(spark):
    got = {r.doc_id: r.n_tokens for r in op2_token_counts(spark, SMALL).collect()}
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert got == {r.doc_id: expected(r.text) for r in texts}


def test_empty_table_repeats_and_clashing_names(docs_of):
    assert count_tokens(docs_of([])).count() == 0
    df = docs_of(["a b", "a b"]).withColumn("n_tokens", F.lit("mine")).withColumn("doc_id", F.lit(1))
    out = count_tokens(df, keep=("doc_id", "lang"))
    assert [tuple(r)[:4] for r in out.collect()] == [(1, "en", 3, 2)] * 2


def test_proof_is_sound():
    s = prove(load_ranks(public_tokenizers.path("piece_bpe_32k.model")))
    assert s.blanks_lead and "\n" in s.cut and len(s.whole) > 30_000


def test_long_parts_merge_like_short_ones():
    import random

    from tessera.llm import token_count as tc
    ranks = load_ranks(public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(3)
    for _ in range(300):
        w = "".join(rng.choice("theandiongr▁é日x") for _ in range(rng.randint(1, 60)))
        assert tc._merge_long(w, ranks) == tc.merge_count(w, ranks)
