"""Mixing: targets, exact totals, whole blocks, and the tree's draws."""

from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing as M
from tessera.llm.queries import ORACLES, op12_mix_sources
from tools.compare import rows_of

from ..conftest import SMALL

SCHEMA = "doc_id long, source string, size long, target string"


def targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    """Reshares the excess until no target is above its cap."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, done = share * sum(sizes.values()), {}
    while True:
        rest, left = total - sum(done.values()), sum(w[s] for s in order if s not in done)
        t = {s: done[s] if s in done else rest * w[s] / left for s in order}
        over = [s for s in order if s not in done and t[s] > most * sizes[s]]
        if not over:
            return t
        done.update({s: most * sizes[s] for s in over})
        if len(done) == len(order):
            return done


def check(spark, rows, **kw):
    df = spark.createDataFrame([(i, s, n, "clash") for i, s, n in rows], SCHEMA)
    docs, pieces = M.mix(df, keep=("doc_id", "source"), **kw)
    docs, pieces = docs.collect(), pieces.collect()
    assert Counter((d.doc_id, d.source, d["size"]) for d in docs) == Counter(
        (i, s, max(n or 0, 0)) for i, s, n in rows)
    sizes, got, by = defaultdict(int), defaultdict(int), {d._row: d for d in docs}
    for d in docs:
        sizes[d.source] += d["size"]
    want = targets(sizes) if sizes else {}
    spans, places = defaultdict(list), defaultdict(list)
    for p in pieces:
        d = by[p._row]
        got[d.source] += p.length
        spans[p._row, p["pass"]].append((p.start, p.start + p.length))
        places[p.shard].append(p.place)
        assert 0 <= p.start and p.length > 0 and p.start + p.length <= d["size"]
    for d in docs:
        assert d.source_size == sizes[d.source] and d.target == pytest.approx(want[d.source])
    for s in sizes:
        assert abs(got[s] - want[s]) <= 0.5 + 1e-6
    for cuts in spans.values():                       # pieces of a pass do not overlap
        cuts.sort()
        assert all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    return docs, pieces


def test_totals_are_exact(spark, monkeypatch):
    monkeypatch.setattr(M, "PIECE_ROWS", 40)
    monkeypatch.setattr(M, "FANOUT", 4)
    rng = np.random.default_rng(1)
    rows = [(i, "hot" if i % 3 == 0 else f"s{i % 7}" if i % 11 else None, int(rng.integers(0, 90)))
            for i in range(900)]
    rows += [(900, "long", 30_000), (901, "", 5), (902, "nought", 0), (903, "null", None),
             (904, "minus", -4), (None, "s1", 10), (None, "s1", 10), (3, "hot", 17), (3, "hot", 17)]
    docs, pieces = check(spark, rows, block=64, shard_blocks=8)
    again = check(spark, rows, block=64, shard_blocks=8)

    def plain(docs, pieces):
        ids = {d._row: (d.doc_id, d.source, d["size"]) for d in docs}
        return Counter((ids[p._row], p["pass"], p.start, p.length, p.shard) for p in pieces)
    assert plain(docs, pieces) == plain(*again)
    shards = {p.shard for p in pieces}
    blocks = defaultdict(set)
    names = {d._row: d.source for d in docs}
    for p in pieces:
        blocks[names[p._row], p.block].add(p.shard)
    assert all(len(s) == 1 for s in blocks.values())  # a block lies in one shard
    total = len(blocks)
    assert shards == set(range(-(-total // 8)))
    held = Counter(next(iter(s)) for s in blocks.values())
    assert max(held.values()) <= 8 and min(held.values()) >= 7


def test_small_tables(spark):
    check(spark, [])
    check(spark, [(1, "a", 0), (2, None, 0)])
    check(spark, [(1, "a", 7)])
    check(spark, [(1, "a", 1000), (2, "b", 1), (3, "c", 1)])


def test_tree_draws_without_replacement():
    sources, total = np.array([50, 3, 0, 200, 7]), 260
    mean = np.zeros((8, 5))
    for seed in range(300):
        pdf = pd.DataFrame({"node": 0, "shards": 8, "index": range(5), "all": sources, "first": 0,
                            "blocks": sources})
        out = M.split(pdf, total, 8, 1, seed)
        assert (out.groupby("index")["blocks"].sum().reindex(range(5), fill_value=0) == sources).all()
        assert set(out.groupby("node")["blocks"].sum()) <= {32, 33}
        for _, g in out.sort_values("first").groupby("index"):      # disjoint and gapless
            assert list(g["first"]) == [0, *np.cumsum(g["blocks"])[:-1]]
        mean += out.pivot_table(index="node", columns="index", values="blocks", fill_value=0) \
            .reindex(columns=range(5), fill_value=0).to_numpy()
    assert np.allclose(mean / 300, np.outer(np.full(8, 1 / 8), sources), atol=0.6)


def test_every_block_is_met_once():
    for n in (1, 2, 6, 97, 360):
        assert sorted(r * M.stride(n, 3, 1) % n for r in range(n)) == list(range(n))


def test_texts_of_the_mix(spark):
    rows = [(i, f"s{i % 3}", " ".join(f"w{i}.{j}" for j in range(i % 40))) for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    docs, pieces = M.mix(df.withColumn("size", M.word_count("text")), keep=("doc_id", "text"),
                         block=50, shard_blocks=4)
    words = Counter(w for r in M.mixed_texts(docs, pieces).collect() for w in r.text.split())
    taken = {r._row: r.n for r in pieces.groupBy("_row").agg(F.sum("length").alias("n")).collect()}
    for d in docs.collect():
        mine = [words[w] for w in (d.text or "").split()]
        assert sum(mine) == taken.get(d._row, 0) and all(n <= 2 for n in mine)


def test_query_on_table(spark):
    df = op12_mix_sources(spark, SMALL)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    cur = con.execute(ORACLES["op12_mix_sources"])
    cols = [c[0] for c in cur.description]
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(cols, cur.fetchall())
