"""The tagger: cheapest paths, expectations and what a round improves."""

import itertools
import math
import re

import numpy as np
import pytest

from tessera.operators import tagger as G

from .conftest import SMALL


def symbol(model, tok):
    if tok in G.FUNCTION_WORDS:
        return tok
    if tok in ".!?\n":
        return G.STOP
    if re.fullmatch("[0-9]+", tok):
        return G.DIGITS
    return next(("-" + s for s, _ in G.SUFFIXES if tok.endswith(s) and len(tok) > len(s) + 1), G.OPEN)


def viterbi(model, toks):
    """Plain search over whole tables; equal costs go to the earlier tag."""
    step, show = model.costs()
    names = list(model.symbols)
    cost, back = {0: 0}, []
    for t in toks:
        m = names.index(symbol(model, t))
        new = {}
        for j in model.symbols[names[m]]:
            c, i = min((cost[i] + step[i, j], i) for i in sorted(cost))
            new[j] = (c + show[m, j], i)
        back.append({j: i for j, (_, i) in new.items()})
        cost = {j: c for j, (c, _) in new.items()}
    if not toks:
        return []
    j = min(sorted(cost), key=lambda j: cost[j])
    path = [j]
    for b in reversed(back[1:]):
        path.append(b[path[-1]])
    return [G.TAGS[j] for j in reversed(path)]


def expect(model, texts):
    out = []
    for t in texts:
        toks = re.findall(r"[^\W]+|[.!?\n]", t.lower()) if t else []
        tags = viterbi(model, toks)
        out.append([(w, g) for w, g in zip(toks, tags) if g != G.STOP])
    return out


def test_neighbours_decide(spark):
    df = spark.createDataFrame([("The run to run. She will run. I have had the can",)], "text string")
    words = [tuple(w) for w in G.tag_texts(df, "text").first().tagged]
    assert words[1] == ("run", "NN") and words[3] == ("run", "VB") and words[6] == ("run", "VB")
    assert words[-1] == ("can", "NN") and words[5] == ("will", "MD")


def test_texts_equal_plain_search(spark):
    model = G.default_tagger()
    texts = ["", "...", "!\n?", "one", "12 of the 3 dogs, running slowly\n\nher her her that that",
             "that " * 600 + "end"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "i int, text string")
    got = {r.i: r.tagged for r in G.tag_texts(df, "text", keep=["i"]).collect()}
    assert got[len(texts)] is None
    for i, exp in enumerate(expect(model, texts)):
        assert [tuple(w) for w in got[i]] == exp
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("text")
    rows = G.tag_texts(docs, "text", keep=["text"]).collect()
    for r in rows:
        toks = [w for w in re.findall(r"[^\W]+|[.!?\n]", r.text.lower())]
        exp = [(w, g) for w, g in zip(toks, viterbi(model, toks)) if g != G.STOP]
        assert [tuple(w) for w in r.tagged] == exp


def test_expectations_equal_enumeration():
    rng = np.random.default_rng(3)
    k, m = 3, 4
    step, show = rng.random((k, k)), rng.random((m, k)) * (rng.random((m, k)) < 0.8) + 0.01
    step /= step.sum(1, keepdims=True)
    show /= show.sum(0, keepdims=True)
    x = np.array([[1, 2, 0], [3, 3, 0], [1, 1, 1]])
    steps, shown, like = G.expected(x, step, show)
    exp_steps, exp_shown, exp_like = np.zeros_like(step), np.zeros_like(show), 0.0
    for s in x:
        paths = {}
        for path in itertools.product(range(k), repeat=len(s)):
            p, at = 1.0, 0
            for tag, sym in zip(path, s):
                p *= step[at, tag] * show[sym, tag]
                at = tag
            paths[path] = p
        total = sum(paths.values())
        exp_like += math.log(total)
        for path, p in paths.items():
            for a, b in zip((0, *path), path):
                exp_steps[a, b] += p / total
            for tag, sym in zip(path, s):
                exp_shown[sym, tag] += p / total
    assert np.allclose(steps, exp_steps) and np.allclose(shown, exp_shown)
    assert like == pytest.approx(exp_like)


def test_rounds_never_lower_the_likelihood(spark, monkeypatch):
    monkeypatch.setattr(G, "SENTENCES", 16)
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("text")
    docs = docs.union(spark.createDataFrame([(None,), ("",)], "text string")).repartition(3)
    model = G.fit(docs, "text", rounds=4)
    assert all(b >= a - 1e-6 for a, b in zip(model.history, model.history[1:]))
    assert model.history[-1] > model.history[0]
    start = G.default_tagger()
    assert ((model.show > 0) == (start.show > 0)).all()
    tagged = G.tag_words(docs, "text", model)
    assert tagged.count() == tagged.where("tag IS NOT NULL").count() > 1000
    empty = G.fit(docs.limit(0), "text", rounds=1)
    assert np.allclose(empty.step, start.step)


def test_blocks_hold_whole_lists_and_stay_small(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(G, "BLOCK", 5)
    lists = [[1, 2], None, [], [3, 4, 5], list(range(9)), [6]]
    batch = pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32()))], names=["s"]).slice(1)
    out, sizes = [], []
    for b, values, first, valid in G.blocks([batch], 0):
        v = values.to_pylist()
        out += [v[a:z] if ok else None for a, z, ok in zip(first, first[1:], valid)]
        sizes.append((b.num_rows, len(v)))
    assert out == lists[1:] and all(n <= 5 or rows == 1 for rows, n in sizes)


def test_a_symbol_costs_no_row_of_its_own(spark, monkeypatch):
    """Texts are tagged together: the steps of a block are those of its longest
    stretch, not the sum over its texts."""
    from tessera.operators.tagger import cheapest, default_tagger, stretches, tag_places
    model = default_tagger()
    x = np.tile([5, len(model.symbols) - 1, len(model.symbols) - 1, 0], 1000)
    begins = np.arange(len(x)) % 4 == 0
    _, starts, longer = stretches(x, begins, tag_places(model.show))
    assert len(longer) == 3 and longer[0] == len(starts) == 2000
    assert (cheapest(x, begins, model).reshape(-1, 4) == cheapest(x[:4], begins[:4], model)).all()


def test_equal_stretches_are_reckoned_once():
    model = G.default_tagger()
    rng = np.random.default_rng(5)
    x = rng.integers(0, len(model.symbols), 4000)
    x[1000:1100] = len(model.symbols) - 1                # a stretch too long for one number
    begins = np.append(True, x[:-1] == 0)
    places = G.tag_places(model.show)
    before, starts, longer = G.stretches(x, begins, places)
    at, row, kept, times = G.distinct_stretches(x, before, starts, longer, len(places) + 1)
    assert times.sum() == len(x) and len(at) < len(x) and len(kept) == len(longer) >= 100
    sums = G.Expectations(model.step, model.show)
    sums.add(x, begins)
    steps, shown, like = np.zeros_like(model.step), np.zeros_like(model.show), 0.0
    for s in np.split(x, np.flatnonzero(begins)[1:]):    # one sentence after the other, dense
        now, ways = np.eye(1, len(G.TAGS))[0], []
        for m in s:
            w = now[:, None] * model.step * model.show[m][None]
            like += math.log(w.sum())
            ways.append((now, w / w.sum()))
            now = w.sum(0) / w.sum()
        after = np.ones(len(G.TAGS))
        for m, (past, w) in zip(s[::-1], ways[::-1]):
            w = w * after[None]
            steps += w
            shown[m] += w.sum(0)
            after = np.divide(w.sum(1), past, out=np.zeros(len(past)), where=past > 0)
    got = sums.totals()
    assert np.allclose(got[0], steps) and np.allclose(got[1], shown) and got[2] == pytest.approx(like)
