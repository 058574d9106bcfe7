"""Near words, forms and roots equal a comparison of all pairs."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from tessera.llm import spelling as S
from tessera.llm.queries import ORACLES, op13_spelling_variants
from tools.compare import rows_of

from ..conftest import SMALL
from .conftest import EDGES


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts, ratio=2):
    near = {w: [x for x in counts if one_edit(w, x)] for w in counts}
    form = {}
    for w, xs in near.items():
        best = min(xs, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        f = form[w]
        out.append((w, f, root, counts[w], len(near[w]), counts[f] if f is not None else None))
    return sorted(out)


def group(spark, rows):
    out = S.group_variants(spark.createDataFrame(rows, "word string, n long, form string"))
    return sorted(tuple(r) for r in out.collect())


def vocabulary(rng, n, letters):
    words = {"".join(rng.choice(letters) for _ in range(rng.randint(1, 6))) for _ in range(n)}
    return {w: rng.choice([1, 2, 3, 4, 8, 8, 16, 100]) for w in words}


@pytest.mark.parametrize("bound", [None, 40])
def test_against_all_pairs(spark, monkeypatch, bound):
    if bound:                       # several parts per length, a filter or two a round
        monkeypatch.setattr(S, "PART_WORDS", 20)
        monkeypatch.setattr(S, "ROUND_BYTES", 200)
        monkeypatch.setattr(S, "TASK_WORDS", bound)
    counts = vocabulary(random.Random(2), 250, "abcé日😀")
    counts |= {"aaaa": 3, "aaa": 50, "aaaaa": 1}
    rows = [(w, n, "clash") for w, n in counts.items()]
    assert group(spark, rows) == brute(counts)


def test_odd_rows(spark):
    rows = [("word", 3, None), ("word", 4, None), ("ward", 20, None), (None, 5, None), ("", 9, None),
            ("words", None, None), ("worn", 14, None), ("worń", 1, None)]
    assert group(spark, rows) == brute({"word": 7, "ward": 20, "worn": 14, "worń": 1})
    assert group(spark, []) == []
    with pytest.raises(ValueError):
        S.group_variants(spark.createDataFrame([], "word string, n long"), ratio=1)


def test_filters_miss_no_word():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abcdefgh") for _ in range(9)) for _ in range(20000)})
    h = S.mixed(S.terms(S.letters(words)).sum(axis=1, dtype=np.uint64))
    table = S.bloom(h)
    assert len(S.probe(h, {0: table}, 1)) == len(words)
    other = S.mixed(np.arange(200_000, dtype=np.uint64))
    assert len(S.probe(other, {0: table}, 1)) < 2000


def counted(rows, every):
    out = Counter()
    for k, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), w)
            h = zlib.crc32(f"{'' if k is None else k}:{w}".encode())
            if every and h % every == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 5:
                out[w] += 1
    return dict(out)


@pytest.mark.parametrize("every", [0, 3])
def test_words_of_texts(spark, monkeypatch, every):
    monkeypatch.setattr(S, "WORDS_HELD", 50)
    texts = [*EDGES, "ÀÉÎÕÜ×÷ß straße STRASSE naïveté Ångström", "a1b2 cd_ef ghijk'lmnop ퟿�"]
    rng = random.Random(1)
    texts += [" ".join("".join(rng.choice("abcÉé") for _ in range(rng.randint(1, 9)))
                       for _ in range(80)) for _ in range(10)]
    rows = [*enumerate(texts), (None, "nullable keys count nullable"), (3, texts[-1])]
    df = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, word int")
    got = {r.word: r.n for r in S.count_words(df, drop_every=every).collect()}
    assert got == counted(rows, every)
    assert S.count_words(df.limit(0)).collect() == []


def test_query_on_table(spark):
    df = op13_spelling_variants(spark, SMALL)
    got = [tuple(r) for r in df.collect()]
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SMALL}/documents.parquet')")
    cur = con.execute(ORACLES["op13_spelling_variants"])
    cols = [c[0] for c in cur.description]
    assert rows_of(df.columns, got) == rows_of(cols, cur.fetchall())
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    counts = {w: n for w, n in counted([(d.doc_id, d.text) for d in docs], 97).items() if n >= 3}
    assert {r[0]: r[3] for r in got} == counts and any(r[1] for r in got)
