"""Text operators: stop words, tagging, polarity, families."""

import math

from pyspark.sql import functions as F

from tessera.operators import text as T


def test_stop_words_keep_not():
    sw = T.stop_words()
    assert "not" not in sw and "the" in sw and "translated" in sw and "show less" in sw


def test_tag_rules(spark):
    df = spark.createDataFrame([(w,) for w in ["the", "running", "walked", "quickly", "nation",
                                               "42", "table", "cat", "ing"]], "token string")
    got = {r.token: r.tag for r in T.with_tag(df).collect()}
    assert got == {"the": "DT", "running": "VBG", "walked": "VBD", "quickly": "RB",
                   "nation": "NN", "42": "CD", "table": "JJ", "cat": "NN", "ing": "NN"}


def test_polarity_by_hand(spark):
    df = spark.createDataFrame([(0, "Good food, not bad"), (1, "")], "id int, t string")
    lex = {"good": 2.0, "bad": -2.0, "not": -1.0}
    r = sorted(T.polarity(df, "t", lex, ["id"]).collect(), key=lambda x: x.id)
    s = 2.0 - 1.0 - 2.0
    pw, nw, uw = 3.0, 2.0 + 3.0, 1.0
    assert math.isclose(r[0].Compound, s / math.sqrt(s * s + 15))
    assert math.isclose(r[0].Positive, pw / (pw + nw + uw))
    assert math.isclose(r[0].Negative, nw / (pw + nw + uw))
    assert (r[1].Compound, r[1].Positive, r[1].Neutral) == (0.0, 0.0, 0.0)


def test_lexicons_of_ten_thousand_entries(spark):
    big = {f"word{i}": ("JJ" if i % 2 else "VB") for i in range(10_000)}
    lex = T.lexicon_table(spark, big)
    df = spark.createDataFrame([(1, "word1 word2 the word9999 running"), (2, None), (3, "")],
                               "id int, t string")
    got = {(r.id, r.pos): (r.token, r.tag) for r in T.tag_tokens(df, "t", lex, ["id"]).collect()}
    assert got == {(1, 0): ("word1", "JJ"), (1, 1): ("word2", "VB"), (1, 2): ("the", "NN"),
                   (1, 3): ("word9999", "JJ"), (1, 4): ("running", "VBG")}
    terms = spark.createDataFrame([("word3",), ("word4",)], "token string")
    out = {r.token: r.description for r in T.describe_terms(terms, T.tag_table(spark), lex).collect()}
    assert out == {"word3": "adjective", "word4": "verb, base form"}
    val = T.valence_table(spark, {w: 1.0 if t == "JJ" else -1.0 for w, t in big.items()})
    pol = {r.id: r for r in T.polarity(df, "t", val, ["id"]).collect()}
    assert math.isclose(pol[1].Compound, 1 / 4) and pol[2].Compound == pol[3].Compound == 0.0


def test_overall_weights(spark):
    df = spark.createDataFrame([("cat cat hat",)], "t string")
    w = T.term_weights(T.counted_terms(T.tokens(df, "t"), T.stop_table(spark)), k=5)
    assert {r.token: r.weight for r in w.collect()} == {"cat": 1.0, "hat": 0.5}


def test_top_by_tag_families(spark):
    df = spark.createDataFrame([("walking walking talked the nation nation nation quickly",)],
                               "t string")
    out = T.top_by_tag(T.tokens(df, "t"), T.stop_table(spark), 5)
    got = {(r.family, r.token): (r.n, r["rank"]) for r in out.collect()}
    assert got == {("Verb", "walking"): (2, 1), ("Verb", "talked"): (1, 2),
                   ("Noun", "nation"): (3, 1), ("Adverb", "quickly"): (1, 1)}


def test_counted_terms_drop_stop_words(spark):
    df = spark.createDataFrame([("The cat and the hat, not the bat",)], "t string")
    got = {r.token: r.n for r in T.counted_terms(T.tokens(df, "t"), T.stop_table(spark)).collect()}
    assert got == {"cat": 1, "hat": 1, "not": 1, "bat": 1}


def test_the_report_counts_terms_once(spark, monkeypatch):
    from tessera.plans import review_text as P

    from .conftest import SMALL
    calls = []
    real = T.tokens
    monkeypatch.setattr(T, "tokens", lambda *a, **k: calls.append(a) or real(*a, **k))
    report, cleaned = P.review_report(spark, SMALL)
    for part in ("unigrams", "term_weights", "families"):
        tree = report[part]._jdf.queryExecution().optimizedPlan().toString()
        assert "regexp_extract_all" not in tree and "InMemoryRelation" not in tree
    assert len(calls) == 1 and "Word_count" in cleaned.columns
    cleaned.unpersist()


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_stop_words_meet_counted_words_only(spark):
    df = spark.createDataFrame([("The cat and the hat, not the bat",)], "t string")
    for times in (None, "w"):
        tok = T.tokens(df.withColumn("w", F.lit(3)), "t", keep=["w"])
        counts = T.counted_terms(tok, T.stop_table(spark), times=times)
        assert {r.token: r.n for r in counts.collect()} == dict.fromkeys(("cat", "hat", "not", "bat"), 3 if times else 1)
        tree = _plan(counts)
        assert tree.index("LeftAnti") < tree.index("Aggregate")     # joined above the aggregate


def test_review_texts_are_cut_once(spark, tmp_path):
    """A text both exports hold is cut once, however its rows are rated; the
    words count as often as ``combined`` has rows."""
    import shutil
    from collections import Counter

    from tessera.plans import review_text as P
    from tessera.plans.reviews import combined, distinct_texts

    from .conftest import SMALL
    sf = shutil.copytree(SMALL, tmp_path / "sf", ignore=lambda d, names: [n for n in names if n == "documents.parquet"])
    # doc_id % 5 = 0: both exports rate alike; 7: no rating; 11: one export's rating does not parse
    texts = [(0, "Cat hat the", "s"), (1, "Cat hat the", "s"), (2, "Cat hat the", "r"), (5, "Cat hat the", "s"),
             (7, "gone", "s"), (11, "bat " * 80, "s"), (12, None, "s"), (13, "", "s"), (14, "mat", None), (1, "Cat hat the", "s")]
    spark.createDataFrame(texts, "doc_id long, text string, source string") \
        .selectExpr("doc_id", "text", "'en' AS lang", "source", "length(text) AS n_chars") \
        .write.parquet(f"{sf}/documents.parquet")
    rows = [(r.Label, w) for r in combined(spark, str(sf)).collect() for w in r.Review.lower().split() if w != "the"]
    got = {r.token: r.n for r in P.overall_counts(spark, str(sf)).collect()}
    assert got == Counter(w for _, w in rows) and got["cat"] > 4 and got["bat"] == 80 and set(got) == {"cat", "hat", "bat"}
    assert {(r.Label, r.token): r.n for r in P.label_counts(spark, str(sf)).collect()} == Counter(rows)
    cut = distinct_texts(spark, str(sf)).collect()
    assert sorted(r.Review.strip()[:3] for r in cut) == ["", "Cat", "bat"]
    assert sum(r.times for r in cut) == combined(spark, str(sf)).count()
