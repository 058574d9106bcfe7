"""The join's components equal brute force over all pairs."""

import random

import pytest
from pyspark.sql import functions as F

from tessera.llm import ngram_join as nj
from tessera.llm.queries import op10_ngram_jaccard

from ..conftest import SMALL
from .conftest import EDGES

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def grams(t, n):
    import re
    w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(str.maketrans(UP, LOW)))
    if not w:
        return frozenset()
    n = min(n, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1))


def brute(rows, n=4, percent=85):
    sets = [(i, grams(t, n)) for i, t in rows]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    distinct = {}
    for x, (_, s) in enumerate(sets):
        if s:
            root[find(x)] = find(distinct.setdefault(s, x))
    reps = list(distinct.items())
    for i, (s, x) in enumerate(reps):
        for r, y in reps[:i]:
            if 100 * min(len(s), len(r)) >= percent * max(len(s), len(r)):
                both = len(s & r)
                if 100 * both >= percent * (len(s) + len(r) - both):
                    root[find(x)] = find(y)
    least = {}
    for x, (i, _) in enumerate(sets):
        if i is not None:
            least[find(x)] = min(i, least.get(find(x), i))
    return sorted(((i, len(s), least.get(find(x))) for x, (i, s) in enumerate(sets)), key=str)


def run(docs_of, rows, **kw):
    df = docs_of([(i, t, "en", "s") for i, t in rows]).withColumn("n", F.lit("mine"))
    out = nj.near_duplicates(df.withColumn("class", F.lit(1)), **kw)
    return sorted((tuple(r) for r in out.collect()), key=str)


def corpus(seed, n=260):
    """Texts with copies, near copies at every distance, chains and a passage
    that a third of all rows share."""
    rng = random.Random(seed)
    word = [f"w{i}" for i in range(60)]
    passage = [rng.choice(word) for _ in range(30)]
    texts = []
    for _ in range(n):
        kind = rng.random()
        if texts and kind < 0.5:
            w = rng.choice(texts).split()
            for _ in range(rng.randint(0, 3)):
                if w:
                    w[rng.randrange(len(w))] = rng.choice(word)
        elif kind < 0.75:
            w = passage + [rng.choice(word) for _ in range(rng.randint(0, 12))]
        else:
            w = [rng.choice(word) for _ in range(rng.choice([0, 1, 3, 4, 5, 20, 60, 200]))]
        texts.append(" ".join(w))
    return list(enumerate(texts))


@pytest.mark.parametrize("seed,small", [(1, False), (2, True), (3, True)])
def test_against_brute_force(docs_of, monkeypatch, seed, small):
    if small:                                  # long lists cut into parts, groups into many cells
        for name, value in (("LIST", 10), ("BLOCK", 8), ("GRAMS", 400), ("COLUMNS", 16), ("PIECE", 64), ("MARKS", 1 << 10)):
            monkeypatch.setattr(nj, name, value)
    rows = corpus(seed)
    assert run(docs_of, rows) == brute(rows)


def test_five_words_and_lower_similarity(docs_of):
    rows = corpus(4, 150)
    assert run(docs_of, rows, n=5, percent=80) == brute(rows, 5, 80)


def test_edges(docs_of):
    rows = list(enumerate(EDGES + EDGES)) + [(3, "a b c d e"), (3, "A B c d e"), (None, "a b c d E"),
                                             (None, None), (900, "HELLO world"), (901, "ÉÀ x"), (902, "éà x")]
    assert run(docs_of, rows) == brute(rows)
    assert run(docs_of, []) == []


def test_a_large_group_of_near_copies(docs_of):
    rng = random.Random(8)
    base = [f"w{rng.randrange(500)}" for _ in range(150)]
    rows = []
    for i in range(400):
        w = list(base)
        w[rng.randrange(150)] = f"x{i}"
        rows.append((i, " ".join(w)))
    assert {r[2] for r in run(docs_of, rows)} == {0}


def test_chance_n_grams_do_not_chain_the_corpus(docs_of, monkeypatch):
    """Texts of few words share n-grams by chance and would form one group;
    whole sets are sent for the texts that are really near."""
    rng = random.Random(11)
    texts = [" ".join(rng.choices("abcdefghijklmn", k=120)) for _ in range(300)]
    for t in texts[:20]:
        w = t.split()
        w[rng.randrange(120)] = "z"
        texts.append(" ".join(w))
    rows, sent, real = list(enumerate(texts)), {}, nj.saved

    def saved(df, name):
        out = real(df, name)
        sent[name] = out.count()
        return out
    monkeypatch.setattr(nj, "saved", saved)
    assert run(docs_of, rows) == brute(rows)
    assert 40 <= sent["members"] <= 60
    assert run(docs_of, rows, n=5, percent=80) == brute(rows, 5, 80)


@pytest.mark.parametrize("most", [2, 5, 1000])
def test_long_lists_of_one_n_gram(docs_of, monkeypatch, most):
    monkeypatch.setattr(nj, "PAIRS", 2)
    monkeypatch.setattr(nj, "LIST", most)
    rows = corpus(12, 200)
    assert run(docs_of, rows) == brute(rows)


def test_sketches_never_differ_in_more_than_the_sets():
    import numpy as np
    rng = np.random.default_rng(5)
    pool = rng.integers(0, 1 << 63, 4000, dtype=np.uint64) * np.uint64(2)
    for _ in range(200):
        a = np.unique(rng.choice(pool, rng.integers(1, 1500)))
        b = np.unique(np.concatenate([rng.choice(a, rng.integers(1, len(a) + 1)), rng.choice(pool, rng.integers(0, 300))]))
        both = len(np.intersect1d(a, b))
        x, y = nj.sketch(a), nj.sketch(b)
        assert nj.differing(x, y) == nj.differing(y, x) <= len(a) + len(b) - 2 * both
        assert nj.differing(x, x) == 0 and len(x) * 8 >= max(64, len(a) + 1)


def test_sketch_edges_of_many_rows_connect_what_pairs_connect():
    import numpy as np
    rng = np.random.default_rng(7)
    sets = []
    for _ in range(40):
        base = rng.integers(0, 1 << 63, rng.integers(5, 700), dtype=np.uint64)
        for _ in range(rng.integers(1, 6)):
            sets.append(np.unique(np.where(rng.random(len(base)) < 0.03, rng.integers(0, 1 << 63, len(base), dtype=np.uint64), base)))
    n, sketches, ids = np.array([len(s) for s in sets]), [nj.sketch(s) for s in sets], list(range(len(sets)))

    def parts(edges):
        root = list(ids)
        for a, b in edges * len(ids):
            root[a] = root[b] = min(root[a], root[b])
        return root
    pairs = [(i, j) for i in ids for j in ids[:i]
             if nj._alike([i, j], n[[i, j]], [sketches[i], sketches[j]], 85)]
    assert pairs and parts(nj._alike(ids, n, sketches, 85)) == parts(pairs)


def test_components_of_a_graph(spark):
    rng = random.Random(6)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 40)]
    edges += [(rng.randrange(200, 400), rng.randrange(200, 400)) for _ in range(120)]
    root = {x: x for e in edges for x in e}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = nj.components(spark.createDataFrame(edges, "a long, b long"))
    want = {x: find(x) for a, b in edges if a != b for x in (a, b)}
    assert {r.node: r.root for r in got.collect()} == want
    assert nj.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_query_on_table(spark):
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = sorted((tuple(r) for r in op10_ngram_jaccard(spark, SMALL).collect()), key=str)
    assert got == brute([tuple(t) for t in texts])


@pytest.mark.parametrize("most", [0, 60, 1 << 18])
def test_components_in_rounds_and_in_one_task(spark, monkeypatch, most):
    monkeypatch.setattr(nj, "GRAPH", most)
    edges = [(i, i + 1) for i in range(40)] + [(-5, 30), (70, 60), (60, 65), (9, 9)]
    got = nj.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == {**{i: -5 for i in [-5, *range(41)]}, 60: 60, 65: 60, 70: 60}
    assert len(got) == 45


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    import pyarrow as pa
    texts = pa.array(EDGES + ["Ab ab AB", "x" * 700 + " y"])
    whole = nj.Shingler(4)(texts)
    for piece in (1, 7, 64):
        monkeypatch.setattr(nj, "PIECE", piece)
        for a, b in zip(whole, nj.Shingler(4)(texts)):
            assert a.tolist() == b.tolist()
    one = [nj.Shingler(4)(texts.slice(i, 1))[0] for i in range(len(texts))]
    assert all(a.tolist() == b.tolist() for a, b in zip(whole, one))
    assert [len(s) for s in whole] == [len(grams(t, 4)) for t in texts.to_pylist()]


def test_overlaps_and_spanning():
    import numpy as np
    rng = np.random.default_rng(3)
    sets = [np.unique(rng.integers(0, 300, rng.integers(1, 120))).astype(np.uint64) for _ in range(40)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    got = nj.overlaps(sets)
    same = ~np.eye(40, dtype=bool)
    assert (got[same] == np.array(want)[same]).all()
    linked = np.zeros((6, 6), bool)
    for i, j in ((0, 3), (3, 5), (1, 2)):
        linked[i, j] = linked[j, i] = True
    assert sorted(nj.spanning(linked)) == [(2, 1), (3, 0), (5, 0)]
