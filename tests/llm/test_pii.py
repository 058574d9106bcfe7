"""Base spans against the plain patterns, added terms, sanitising."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

from pyspark.sql import functions as F

from tessera.llm import pii
from tessera.llm.queries import op9_pii

from ..conftest import SMALL
from .conftest import EDGES

PLAIN = {
    "email": re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    "ip": re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    "card": re.compile(r"[0-9]([\x20-]?[0-9])+"),
    "phone": re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"),
}


def passes(kind, s):
    d = re.sub("[^0-9]", "", s)
    if kind == "ip":
        return all(int(p) <= 255 for p in s.split("."))
    if kind == "card":
        t = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d)))
        return 16 <= len(d) <= 19 and t % 10 == 0
    return kind == "email" or 8 <= len(d) <= 15


def plain(t):
    return [(k, *m.span()) for k, p in PLAIN.items() for m in p.finditer(t or "") if passes(k, m[0])]


SAMPLES = ["mail a.b+c@x-y.co.uk, or @b.c@d.e f@g h@i..j a@b@c.d a@b.c_d@e.f", "1.2.3.4.5.6.7.8 256.1.1.1 "
           "001.02.3.4 1.2.3", "4111 1111 1111 1111 and 4111-1111-1111-1112 4111111111111111",
           "+1 (555) 123-4567. +12 +1.2.3.4.5.6.7.8 +49 30 123456 789012345", "@" * 50,
           "9" * 3000, "+1" + "." * 500, "a" * 3000 + "@x.y", "1." * 2000, "٣٣.1.1.1 ＋1"]


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(9)
    noise = ["".join(rng.choice("a.@1 -+()92") for _ in range(200)) for _ in range(400)]
    for t in SAMPLES + noise + EDGES:
        assert pii.base_spans(t or "") == plain(t)


def test_query_on_table(spark):
    rows = {r.doc_id: r for r in op9_pii(spark, SMALL).collect()}
    texts = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    assert len(rows) == len(texts)
    for t in texts:
        base = plain(t.text)
        text = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        r = rows[t.doc_id]
        assert r.base_sha256 == hashlib.sha256(text.encode()).hexdigest()
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(
            sum(k == x[0] for x in base) for k in pii.KINDS)
        assert r.spans.startswith(text)


def secret_corpus():
    """A name occurs only next to its address; common words everywhere."""
    filler = "and so it goes with many words of a common kind in every line "
    rows = [f"{filler} {w} please ask zanthor at z@example.com about it {filler}"
            for w in ("alpha", "beta", "gamma", "delta", "eta", "iota")]
    rows += [f"{filler}please ask about it at noon" for _ in range(200)]
    return rows


def test_disclosing_terms(docs_of):
    rows = pii.find(docs_of(secret_corpus())).orderBy("doc_id").collect()
    for r in rows[:6]:
        assert [(s.kind, r.text[s.start:s.end]) for s in r.spans] == [
            ("email", "z@example.com"), ("term", "zanthor")]
    assert all(not r.spans for r in rows[6:])


def test_copies_are_one_piece_of_evidence(docs_of):
    df = docs_of(["please ask zanthor at z@example.com about it"] * 50)
    assert all([s.kind for s in r.spans] == ["email"] for r in pii.find(df).collect())


def masked(rows):
    return {r.text[s.start:s.end] for r in rows for s in r.spans if s.kind == "term"}


def test_copies_hide_no_term(docs_of):
    rest = secret_corpus()
    rows = pii.find(docs_of([t for t in rest[:6] for _ in range(200)] + rest[6:] * 20)).collect()
    assert masked(rows) == {"zanthor"}


def test_one_context_in_different_texts(docs_of):
    filler = "and so it goes with many words of a common kind in every line "
    line = "please do ask for zanthor at z@example.com about it and so on "
    rows = pii.find(docs_of([f"{filler}{w} {line}" for w in ("alpha", "beta", "gamma", "delta")]
                            + secret_corpus()[6:] + [line.replace("zanthor at z@example.com", "us")] * 200))
    assert masked(rows.collect()) == {"zanthor"}


def test_disclosing_terms_go_from_every_text(docs_of):
    """Far from the entity, in other texts, in copies and in any case."""
    rest = secret_corpus()
    texts = [f"{t}\n{t.split('please')[0] * 2}Yours, Zanthor" for t in rest[:6]] + rest[6:] * 10
    texts += ["a visit by ZANTHOR without an address", "a visit by ZANTHOR without an address", "no zanthors here"]
    rows = pii.find(docs_of(texts)).orderBy("doc_id").collect()
    found = [[(s.kind, r.text[s.start:s.end]) for s in r.spans] for r in rows]
    assert found[:6] == [[("email", "z@example.com"), ("term", "zanthor"), ("term", "Zanthor")]] * 6
    assert found[6:] == [[]] * 2000 + [[("term", "ZANTHOR")]] * 2 + [[]]
    clean = pii.sanitise(docs_of(texts)).where(F.lower("text").rlike("zanthor\\b"))
    assert clean.count() == 0


def test_what_values_share_is_evidence(docs_of):
    """Every value occurs once; the domain, network, prefix or kind recurs."""
    filler = "and so it goes with many words of a common kind in every line "
    forms = {"domain": "mail {}x@zanth.example", "network": "host 10.77.{}.5", "prefix": "call +49 30 77{}1234",
             "issuer": "card 4111 1111 1111 1111"}
    for name, form in forms.items():
        texts = [f"{filler}{w} please ask zanthor {form.format(i)} about it {filler}"
                 for i, w in enumerate(("alpha", "beta", "gamma", "delta"), 10)]
        texts += [f"{filler}please ask about it at noon, mail host call card" for _ in range(200)]
        assert masked(pii.find(docs_of(texts)).collect()) == {"zanthor"}, name


def test_entities_of_a_span():
    t = "A.b@X-y.Co.uk 10.1.2.3, 4111-1111 1111 1111, +49 (30) 123456"
    assert [pii.entities_of(t, s) for s in pii.base_spans(t)] == [
        ["email:a.b@x-y.co.uk", "email/x-y.co.uk", "email"], ["ip:10.1.2.3", "ip/10.1", "ip"],
        ["card:4111111111111111", "card/411111", "card"], ["phone:4930123456", "phone/4930", "phone"]]


def plain_terms(texts):
    """Disclosing terms by counting every word and every window."""
    near, entity, words, total = defaultdict(list), Counter(), Counter(), 0
    for t in texts:
        spans = plain(t)
        free = [m for m in pii.WORD.finditer(t or "")
                if not any(a < m.end() and m.start() < z for _, a, z in spans)]
        words.update(m[0].lower() for m in free)
        seen = set()
        for s in spans:
            before = [i for i, m in enumerate(free) if m.end() <= s[1]][-5:]
            after = [i for i, m in enumerate(free) if m.start() >= s[2]][:5]
            for e in pii.entities_of(t, s):
                entity[e] += 1
                seen |= {(e, i) for i in before + after}
        for e, i in seen:
            near[e, free[i][0].lower()].append(t)
    total = sum(words.values())
    return {w for (e, w), ts in near.items() if len(set(ts)) >= 3
            and 1 + math.log(len(ts) / words[w]) / -math.log(entity[e] / total) >= 0.9}


def test_terms_of_a_table_by_plain_counts(spark):
    """All terms, and where they stand, in a whole table whose texts are
    followed by a line with an address of one of a few domains."""
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text")
    line = F.format_string("\nkontor%d writes from a%d@dom%d.example", F.col("doc_id") % 7, "doc_id",
                           F.col("doc_id") % 7)
    rows = pii.find(docs.withColumn("text", F.when(F.col("doc_id") % 3 == 0, F.concat("text", line))
                                    .otherwise(F.col("text")))).collect()
    terms = plain_terms([r.text for r in rows])
    assert len(terms) >= 1
    for r in rows:
        spans = plain(r.text)
        want = [(m.start(), m.end()) for m in pii.WORD.finditer(r.text or "") if m[0].lower() in terms
                and not any(a < m.end() and m.start() < z for _, a, z in spans)]
        assert [(s.start, s.end) for s in r.spans if s.kind == "term"] == want


def test_words_in_spans_and_odd_lower_case(docs_of):
    """Words of an address, and words whose lower case is longer, count alike
    near an entity and in the corpus."""
    texts = [t.replace("zanthor", "İzan").replace("z@example.com", "İzan a@izan.org") for t in secret_corpus()]
    assert masked(pii.find(docs_of(texts)).collect()) == {"İzan"}


def test_sanitise(docs_of):
    df = docs_of(secret_corpus() + ["x +1 555 123 4567 y 1.2.3.4", None, ""])
    rows = pii.sanitise(df.withColumn("spans", F.lit(1))).orderBy("doc_id").collect()
    assert "please ask [TERM] at [EMAIL] about it" in rows[0].text
    assert [r.text for r in rows[-3:]] == ["x [PHONE] y [IP]", None, ""]
    assert rows[10].text == secret_corpus()[10]


def test_overlaps_become_one_mask():
    t = "+1.2.3.4.5678 z"
    assert pii.mask(t, [dict(start=1, end=8, kind="ip"), dict(start=0, end=13, kind="phone")]) == "[PHONE] z"


def test_edges_and_empty_table(docs_of):
    df = docs_of(EDGES + SAMPLES).withColumn("base", F.lit("mine"))
    rows = pii.find(df).orderBy("doc_id").collect()
    for r, t in zip(rows, EDGES + SAMPLES):
        assert [tuple(s) for s in r.base] == plain(t) and r.text == t
    assert pii.find(docs_of([])).count() == 0 and pii.sanitise(docs_of([])).count() == 0
