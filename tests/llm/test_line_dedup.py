"""Removed lines against plain Python."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm.line_dedup import dedup_lines

from .conftest import EDGES

WS = " \t\n\x0b\x0c\r"


def brute(rows, min_sites):
    sites, keeper = defaultdict(set), {}
    for i, t, _, s in rows:
        for line in (t or "").split("\n"):
            line = line.strip(WS)
            if line:
                sites[line] |= {s} - {None}
                if i is not None:
                    keeper[line] = min(i, keeper.get(line, i))
    out = []
    for i, t, _, s in rows:
        lines = t.split("\n") if t is not None else []
        bad = [x for x in lines if x.strip(WS) and len(sites[x.strip(WS)]) >= min_sites
               and keeper.get(x.strip(WS)) != i]
        kept = "\n".join(x for x in lines if x not in bad) if t is not None else None
        out.append((i, kept, sum(bool(x.strip(WS)) for x in lines), len(bad)))
    return sorted(out, key=str)


def run(df, **kw):
    return sorted((tuple(r) for r in dedup_lines(df, **kw)
                   .select("doc_id", "text", "n_lines", "n_removed").collect()), key=str)


@pytest.mark.parametrize("min_sites", [2, 3, 10])
def test_against_plain_python(docs_of, min_sites):
    rng = random.Random(min_sites)
    pool = [f"shared line {i}" for i in range(25)]
    rows = []
    for i in range(200):
        lines = [rng.choice(pool) if rng.random() < 0.4 else f"own {i} {j}" for j in range(rng.randint(0, 8))]
        lines = [rng.choice(["", " ", "\t"]) + x + rng.choice(["", " ", "\r"]) for x in lines]
        rows.append((i, "\n".join(lines + [""] * rng.randint(0, 2)), "en",
                     rng.choice([None, *(f"s{k}" for k in range(14))])))
    rows += [(500 + i, t, "en", f"s{i % 14}") for i, t in enumerate(EDGES)] + [(None, pool[0], "en", "s1")]
    df = docs_of(rows).withColumn("n_lines", F.lit("mine")).withColumn("k1", F.lit(1)).withColumn("pos", F.lit(2))
    out = dedup_lines(df, min_sites=min_sites)
    assert set(out.columns) == {*df.columns, "n_removed"}
    assert run(df, min_sites=min_sites) == brute(rows, min_sites)


def test_near_threshold_counts_are_exact(docs_of):
    """Sites around a threshold where the sketch only estimates."""
    rows = []
    for n in range(9_400, 10_700, 100):
        rows += [(n * 100_000 + s, f"line {n}", "en", f"site{s}") for s in range(n)]
    got = {}
    for r in dedup_lines(docs_of(rows), min_sites=10_000).collect():
        got.setdefault(r.doc_id // 100_000, []).append(r.n_removed)
    assert {n: sum(x) for n, x in got.items()} == {n: n - 1 if n >= 10_000 else 0 for n in got}


def test_empty_table_and_repeats(docs_of):
    assert dedup_lines(docs_of([])).count() == 0
    rows = [(i % 3, "a\nb", "en", f"s{i}") for i in range(12)]
    assert run(docs_of(rows)) == brute(rows, 10)
