"""Packing: exact ids, gapless sequences, few of them."""

import itertools
import random
import zlib
from collections import defaultdict

import numpy as np
import public_tokenizers as P
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import packing
from tessera.llm.queries import op8_best_fit_packing

from ..conftest import SMALL
from .conftest import EDGES

LIB = Tokenizer.from_file(P.path("word_bpe_49k.json"))


def expected_pieces(doc_id, text, capacity=2048):
    ids = LIB.encode(text or "", add_special_tokens=False).ids + [0]
    return [(doc_id, k, lo, len(ids[lo:lo + capacity]),
             zlib.crc32(np.array(ids[lo:lo + capacity], "<u4").tobytes()))
            for k, lo in enumerate(range(0, len(ids), capacity))]


def check_sequences(rows, capacity=2048):
    by = defaultdict(list)
    for r in rows:
        by[r.sequence_id].append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_edges_and_clashing_names(docs_of):
    df = docs_of(EDGES).withColumn("offset", F.lit("mine")).withColumn("row", F.lit(0))
    cut = packing.pieces(df)
    rows = packing.pack(cut.withColumn("crc", F.crc32("ids")).withColumn("offset", F.lit(5))).collect()
    got = sorted((r.doc_id, r.piece, r.start, r.length, r.crc) for r in rows)
    assert got == [x for i, t in enumerate(EDGES) for x in expected_pieces(i, t)]
    check_sequences(rows)


def test_simple_lower_case_up_to_the_latin_blocks():
    normal = LIB.normalizer.normalize_str
    chars = [chr(c) for c in range(ord(packing.LATIN_END)) if not chr(c).isspace()]
    assert all(normal(c) == c.lower() for c in chars)
    assert all(normal(a + b) == (a + b).lower() for a in "aEiOuÅçN" for b in chars)


def test_every_kind_of_word():
    with open(P.path("word_bpe_49k.json"), encoding="utf-8") as f:
        ids = packing.WordIds(f.read())
    rng = random.Random(4)
    chars = "abcXYZ019'.,-_é ÀßİſŁΣσς日本한́ﬁ½😀\t\x1c"
    for _ in range(3000):
        t = "".join(rng.choice(chars) for _ in range(rng.randint(0, 30)))
        assert np.frombuffer(ids(t), np.uint32).tolist() == LIB.encode(t, add_special_tokens=False).ids


def test_whole_table(spark):
    rows = op8_best_fit_packing(spark, SMALL).collect()
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert sorted((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == sorted(
        x for t in texts for x in expected_pieces(t.doc_id, t.text))
    n = check_sequences(rows)
    assert n <= 1.03 * sum(r.length for r in rows) / 2048 + 1


def test_sequences_hold_the_ids(docs_of):
    cut = packing.pieces(docs_of(["a b c", "d e", None, "f " * 3000]))
    placed = packing.pack(cut.drop("ids"))
    seqs = {r.sequence_id: r for r in packing.sequences(placed, cut).collect()}
    ids = {r.row: r.ids for r in cut.collect()}
    for r in placed.collect():
        s = seqs[r.sequence_id]
        assert len(s.ids) == 4 * s.length
        assert s.ids[4 * r.offset:4 * (r.offset + r.length)] == ids[r.row]


def test_hot_length_is_ranked_in_blocks(spark):
    cut = spark.range(3000).select(F.col("id").alias("row"),
                                   F.when(F.col("id") < 2000, 30).otherwise(F.col("id") % 40 + 1)
                                   .cast("long").alias("length"))
    rows = packing.pack(cut, capacity=100).collect()
    assert len({r.row for r in rows}) == 3000
    total = sum(r.length for r in rows)
    assert check_sequences(rows, 100) <= -(-total // 100) + 60


def optimum(lengths, capacity):
    """Fewest bins by exhaustive search, for small cases."""
    best = [len(lengths)]

    def go(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(lengths):
            best[0] = len(bins)
            return
        for j in sorted(set(range(len(bins)))):
            if bins[j] + lengths[i] <= capacity:
                bins[j] += lengths[i]
                go(i + 1, bins)
                bins[j] -= lengths[i]
        go(i + 1, [*bins, lengths[i]])
    go(0, [])
    return best[0]


@pytest.mark.parametrize("seed", range(20))
def test_close_to_the_optimum(seed):
    rng = random.Random(seed)
    lengths = sorted((rng.randint(1, 20) for _ in range(9)), reverse=True)
    hist = {n: lengths.count(n) for n in lengths}
    patterns = packing.complete(hist, 20)
    used = defaultdict(int)
    for times, items in patterns:
        assert sum(items) <= 20
        for n in items:
            used[n] += times
    assert used == hist
    assert sum(t for t, _ in patterns) <= optimum(lengths, 20) + 1


def test_search_goes_across_sequences():
    hist = {768: 1000, 704: 3000, 576: 1000, 384: 1000, 256: 1000}
    patterns = packing.complete(hist)
    used = defaultdict(int)
    for times, items in patterns:
        assert sum(items) <= 2048
        for n in items:
            used[n] += times
    assert used == hist
    assert sum(t for t, _ in patterns) == 2000
    assert sum(t for t, _ in packing.complete(hist, branches=0)) == 2250


@pytest.mark.parametrize("seed", range(100, 140))
def test_the_optimum_of_small_cases(seed):
    rng = random.Random(seed)
    lengths = sorted((rng.randint(3, 12) for _ in range(9)), reverse=True)
    patterns = packing.complete({n: lengths.count(n) for n in lengths}, 20)
    assert sorted(n for t, items in patterns for n in items * t) == lengths[::-1]
    assert sum(t for t, _ in patterns) == optimum(lengths, 20)


@pytest.mark.parametrize("seed", range(200, 240))
def test_bound_and_proof_of_small_cases(seed):
    rng = random.Random(seed)
    lengths = [rng.randint(2, 13) for _ in range(9)]
    hist, fewest = {n: lengths.count(n) for n in lengths}, optimum(sorted(lengths, reverse=True), 20)
    counts = [lengths.count(n) for n in range(21)]
    assert -(-sum(lengths) // 20) <= packing.least_sequences(counts, 20) <= fewest
    patterns, least = packing.search(hist, 20, None, None, None)
    assert sum(t for t, _ in patterns) == least == fewest


def test_bound_counts_pieces_that_cannot_meet():
    counts = [0] * 2049
    for n in range(690, 1101):
        counts[n] = 730
    assert packing.least_sequences(counts) == 730 * 411 // 2 + 730 * 411 % 2
    assert packing.least_sequences([0] * 2049) == 0
    counts = [0] * 2049
    counts[2048], counts[1025], counts[1] = 5, 7, 3
    assert packing.least_sequences(counts) == 12


def subsets(items):
    return {tuple(sorted(c)) for r in range(len(items) + 1) for c in itertools.combinations(items, r)}


@pytest.mark.parametrize("seed", range(30))
def test_dominated_fillings_by_trying_every_trade(seed):
    rng = random.Random(seed)
    room, items = rng.randint(8, 16), sorted(rng.randint(1, 9) for _ in range(8))
    fits = [f for f in subsets(items) if sum(f) <= room]

    def over(f):
        rest = list(items)
        for n in f:
            rest.remove(n)
        return rest

    def trade(f):
        waste = room - sum(f)
        return any(sum(g) < x <= sum(g) + waste or sum(g) == x and len(g) > 1
                   for x in over(f) for g in subsets(f))
    bits = {f: sum({1 << n for n in over(f)}) for f in fits}
    assert all(packing.dominated(list(f), room - sum(f), bits[f]) == trade(f) for f in fits)
    counts = [items.count(n) for n in range(10)]
    below, sums = packing._tables(counts)
    found, whole = packing.fillings(room, 9, counts + [0] * 10, below + [below[-1]] * 10,
                                    sums + [sums[-1]] * 10, room, 10**6, None)
    assert whole and {tuple(sorted(f)) for f in found} == {f for f in fits if not trade(f)}


def test_output_says_what_is_proved(spark):
    cut = spark.range(300).select(F.col("id").alias("row"), (690 + F.col("id") % 411).alias("length"))
    rows = packing.pack(cut).collect()
    assert check_sequences(rows) == 150 and {r.least_sequences for r in rows} == {150}


def test_null_ids_and_repeated_rows(docs_of):
    df = docs_of([(None, "a b", "en", "s"), (None, "a b", "en", "s"), (3, "a b", "en", "s"), (3, "a b", "en", "s")])
    rows = packing.pack(packing.pieces(df).drop("ids")).collect()
    assert sorted(str(r.doc_id) for r in rows) == ["3", "3", "None", "None"]
    assert check_sequences(rows) == 1


def test_empty_table(docs_of):
    cut = packing.pieces(docs_of([]))
    assert cut.count() == 0 and packing.pack(cut).count() == 0
