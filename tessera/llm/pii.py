"""Personal data (operator 9): base patterns and information-theoretic
sanitisation.

The base patterns find the protected entities.  An exact value seldom recurs,
so what it shares with others is an entity as well: the domain of an address,
the network of an ip, the first digits of a card or phone number, and the kind
(``entities_of``).  Which other words give an entity away is estimated from the
whole corpus: a term ``t`` that occurs
``n_t`` times, ``n_te`` of them near entity ``e``, raises the probability of
``e`` from its share of all words to ``n_te / n_t``.  All counts are
occurrences in all texts, copies included; words inside base spans are no
words.  The gain in information,
divided by the information content of ``e``, is the share of ``e`` that ``t``
discloses; 1 means that ``t`` occurs near ``e`` only.  Terms at or above the
disclosure threshold become spans of kind ``term`` wherever they stand, near
the entity or not; sanitising replaces every span by the name of its kind.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections import Counter, defaultdict

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import byte_blocks, extended, lean, saved
from .ngram_join import MARKS, _marks

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
WINDOW = 5                 # words on either side of an entity that are its context
SUPPORT = 3                # least number of distinct texts a term shares with an entity
THRESHOLD = 0.9            # share of an entity's information a term may not reach
FLUSH = 300_000            # distinct words a task counts before it hands them on
PREFIX = {"card": 6, "phone": 4}   # digits of the issuer, of country and area
NETWORK = 2                # parts of an ip that name its network

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WORD = re.compile(r"[^\W\d_]+")


def emails(t: str) -> list[tuple[int, int]]:
    """Leftmost matches of ``[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\\.[A-Za-z0-9-]+)+``,
    found from the ``@`` signs outwards, which stays linear in long texts."""
    out, end, at = [], 0, t.find("@")
    while at >= 0:
        m = DOMAIN.match(t, at)
        if m:
            lo = at
            while lo > end and t[lo - 1] in LOCAL:
                lo -= 1
            if lo < at:
                out.append((lo, m.end()))
                end = m.end()
        at = t.find("@", at + 1)
    return out


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def digits_of(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def base_spans(t: str) -> list[tuple[str, int, int]]:
    """Base spans by kind as listed, then by start."""
    out = [("email", a, b) for a, b in emails(t)] if "@" in t else []
    for m in IP.finditer(t):
        if all(len(p := g.lstrip("0")) <= 3 and int(p or 0) <= 255 for g in m.groups()):
            out.append(("ip", *m.span()))
    for m in CARD.finditer(t):
        if m.end() - m.start() <= 37 and 16 <= len(d := digits_of(m[0])) <= 19 and luhn(d):
            out.append(("card", *m.span()))
    if "+" in t:
        for m in PHONE.finditer(t):
            if 8 <= len(digits_of(m[0])) <= 15:
                out.append(("phone", *m.span()))
    return out


def free_words(t: str, spans) -> list[tuple[str, int, int]]:
    """(word, start, end) of the lower-cased words that overlap no span."""
    taken = sorted((a, b) for _, a, b in spans)
    words, i, end = [], 0, 0                   # end: of the spans that start before the word
    for m in WORD.finditer(t):
        while i < len(taken) and taken[i][0] < m.end():
            end = max(end, taken[i][1])
            i += 1
        if end <= m.start():
            words.append((m[0].lower(), m.start(), m.end()))
    return words


def context_words(words, spans, window: int = WINDOW):
    """(span, [(word, start, end)]) of the ``window`` free words on either
    side of every span."""
    starts, ends = [w[1] for w in words], [w[2] for w in words]
    for span in spans:
        left, right = bisect_right(ends, span[1]), bisect_left(starts, span[2])
        yield span, words[max(0, left - window):left] + words[right:right + window]


def entities_of(t: str, span) -> list[str]:
    """The entities a span stands for: its value, what the value shares with
    others (domain, network or first digits), and its kind."""
    kind, a, b = span
    if kind == "email":
        value = t[a:b].lower()
        group = value[value.rindex("@") + 1:]
    elif kind == "ip":
        value = t[a:b]
        group = ".".join(value.split(".")[:NETWORK])
    else:
        value = digits_of(t[a:b])
        group = value[:PREFIX[kind]]
    return [f"{kind}:{value}", f"{kind}/{group}", kind]


def joined(spans) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


SCAN = {"key": "binary", "base": "array<struct<kind: string, start: int, end: int>>"}
EVIDENCE = ("key binary, entities array<string>, "
            "near array<struct<entity: string, term: string>>, "
            "term string, n long")
_SPAN = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())])
_NEAR = pa.struct([("entity", pa.string()), ("term", pa.string())])
_AT = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_HIT = pa.struct([("term", pa.string()), ("at", pa.list_(_AT))])


def _bit(bits, value: int) -> bool:
    at = value % MARKS
    return bool(bits[at >> 3] >> (at & 7) & 1)


def _filter(values: DataFrame, c: str):
    """Filter of fixed size over a column, for every task: what it lets
    through by chance is dropped by the join that follows."""
    return values.sparkSession.sparkContext.broadcast(
        _marks(values.select(F.xxhash64(c).alias("h")), "h"))


def scan(df: DataFrame, text: str, keys, through: bool) -> DataFrame:
    """The rows of ``df`` whose text's key the filter ``keys`` lets through,
    or the others, with that key and the base spans of the text.  Texts of the
    rows left out are not matched."""
    names = [c for c in df.columns]
    at = names.index(text)

    def run(batches):
        bits = keys.value

        def key_of(t):
            return xxhash.xxh3_128_digest((t or "").encode())
        for b in byte_blocks(batches, at):
            own = list(map(key_of, b.column(at).to_pylist()))
            mine = [_bit(bits, xxhash.xxh64_intdigest(k, 42)) == through for k in own]
            if not any(mine):
                continue
            b = b.filter(pa.array(mine, pa.bool_()))
            base = [[{"kind": k, "start": a, "end": z} for k, a, z in base_spans(t or "")]
                    for t in b.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([k for k, m in zip(own, mine) if m], pa.binary()),
                 pa.array(base, pa.list_(_SPAN))],
                names=[*names, "key", "base"])

    return df.mapInArrow(lean(run), extended(df, **SCAN))


def occurrences(df: DataFrame, text: str, terms: DataFrame) -> DataFrame:
    """(key, terms): the spans of all ``terms`` in every text that has any, by
    start, outside of its base spans; one row for all copies of a text."""
    inner = df.select(F.col(text).alias("text")).where(F.col("text").isNotNull())
    shared = _filter(terms, "term")

    def run(batches):
        bits = shared.value
        judged: dict[str, bool] = {}

        def passes(w):
            got = judged.get(w)
            if got is None:
                if len(judged) > FLUSH:
                    judged.clear()
                got = judged[w] = _bit(bits, xxhash.xxh64_intdigest(w.lower().encode(), 42))
            return got
        for b in byte_blocks(batches, 0):
            keys, hits = [], []
            for t in b.column(0).to_pylist():
                if not any(map(passes, set(WORD.findall(t)))):
                    continue
                found = defaultdict(list)
                for w, a, z in free_words(t, base_spans(t)):
                    if passes(w):
                        found[w].append({"start": a, "end": z})
                if found:
                    keys.append(xxhash.xxh3_128_digest(t.encode()))
                    hits.append([{"term": w, "at": at} for w, at in found.items()])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.binary()), pa.array(hits, pa.list_(_HIT))],
                names=["key", "hits"])

    hits = inner.mapInArrow(lean(run), "key binary, hits array<struct<term: string, "
                                       "at: array<struct<start: int, end: int>>>>")
    return (hits.dropDuplicates(["key"]).select("key", F.explode("hits").alias("x"))
            .select("key", "x.term", "x.at").join(terms, "term").groupBy("key")
            .agg(F.array_sort(F.flatten(F.collect_list("at"))).alias("at"))
            .select("key", F.transform("at", lambda s: F.struct(
                F.lit(TERM).alias("kind"), s["start"].alias("start"), s["end"].alias("end")))
                .alias("terms")))


def evidence(df: DataFrame, text: str, window: int) -> DataFrame:
    """Rows of two kinds from one pass over the texts: ``key, entities, near``
    of every text with base spans (the entities of every span; every free word
    in the window of an entity, once per entity), and ``term, n``, the free
    words counted per task before the shuffle."""
    inner = df.select(F.col(text).alias("text")).where(F.col("text").isNotNull())

    def run(batches):
        counts: Counter = Counter()            # of words as written

        def rows(keys=(), entities=(), near=()):
            lower: Counter = Counter()
            if not keys:
                for w, n in counts.items():
                    lower[w.lower()] += n
                counts.clear()
            k, n = len(keys), len(lower)
            return pa.RecordBatch.from_arrays(
                [pa.array([*keys, *[None] * n], pa.binary()),
                 pa.array([*entities, *[None] * n], pa.list_(pa.string())),
                 pa.array([*near, *[None] * n], pa.list_(_NEAR)),
                 pa.array([*[None] * k, *lower], pa.string()),
                 pa.array([*[None] * k, *lower.values()], pa.int64())],
                names=["key", "entities", "near", "term", "n"])
        for b in byte_blocks(batches, 0):
            keys, entities, near = [], [], []
            for t in b.column(0).to_pylist():
                spans = base_spans(t)
                if spans:
                    words = free_words(t, spans)
                    counts.update(w for w, _, _ in words)
                    keys.append(xxhash.xxh3_128_digest(t.encode()))
                    named = [entities_of(t, s) for s in spans]
                    entities.append([e for es in named for e in es])
                    found = {(e, *w): None for es, (_, ws) in
                             zip(named, context_words(words, spans, window)) for w in ws for e in es}
                    near.append([{"entity": e, "term": w} for e, w, _, _ in found])
                else:
                    counts.update(WORD.findall(t))
                if len(counts) > FLUSH:
                    yield rows()
            if keys:
                yield rows(keys, entities, near)
        yield rows()

    return inner.mapInArrow(lean(run), EVIDENCE)


def disclosing(seen: DataFrame, support: int, threshold: float) -> DataFrame:
    """(entity, term) pairs where the term discloses at least ``threshold`` of
    the entity, from the rows of ``evidence``.

    The share is ``1 + ln(n_te / n_t) / IC(e)`` with ``IC(e) = -ln(n_e / N)``.
    All four count occurrences in the whole corpus: of the term near the
    entity, of the term, of the entity, and of words.  Copies weigh alike in
    all of them, but are one of the ``support`` distinct texts a pair needs.
    """
    texts = seen.where(F.col("key").isNotNull())
    pairs = (texts.select("key", F.explode("near").alias("x"))
             .groupBy("x.entity", "x.term", "key").agg(F.count("*").alias("n"))
             .groupBy("entity", "term").agg(F.sum("n").alias("n_te"), F.count("*").alias("texts"))
             .where(F.col("texts") >= support))
    entities = (texts.select(F.explode("entities").alias("entity")).groupBy("entity")
                .agg(F.count("*").alias("n_e")))
    words = seen.where(F.col("term").isNotNull()).select("term", "n")
    counts = words.groupBy("term").agg(F.sum("n").alias("n"))
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    # no entity holds more information than ln N: pairs that would miss the
    # threshold even then, most of those with common terms, go before the join
    least = float(max(total, 2)) ** (threshold - 1) * (1 - 1e-9)
    content = F.greatest(-F.log(F.least(F.col("n_e") / F.lit(float(max(total, 1))), F.lit(1.0))),
                         F.lit(1e-9))
    share = 1 + F.log(F.least(F.col("n_te") / F.col("n"), F.lit(1.0))) / content
    return (pairs.join(counts, "term").where(F.col("n_te") >= F.col("n") * F.lit(least))
            .join(entities, "entity").where(share >= threshold).select("entity", "term"))


def find(df: DataFrame, text: str = "text", window: int = WINDOW, support: int = SUPPORT,
         threshold: float = THRESHOLD) -> DataFrame:
    """``df`` with ``base`` (spans of the base patterns, by kind as listed,
    then start) and ``spans`` (the same, then every occurrence of a term that
    discloses an entity of the corpus, by start): arrays of (kind, start, end)
    in code points, end exclusive.

    A null text has no spans, an empty table gives an empty one.  Copies of a
    text get the same spans; a row of a text without such terms does not meet a
    shuffle, but for the few that the filter lets through by chance.  Columns of ``df`` named
    ``base`` or ``spans`` are replaced; other columns stay as they are.
    """
    kept = [c for c in df.columns if c not in ("base", "spans")]
    df = df.select(*[F.col(f"`{c}`") for c in kept])
    inner = df.select(*[F.col(f"`{c}`").alias(f"__c{i}") for i, c in enumerate(kept)])
    at = f"__c{kept.index(text)}"
    seen = saved(evidence(inner, at, window), "evidence")
    reveal = saved(disclosing(seen, support, threshold).select("term").distinct(), "disclosing")
    terms = saved(occurrences(inner, at, reveal), "terms")
    keys = _filter(terms, "key")
    bare = scan(inner, at, keys, False).withColumn("spans", F.col("base"))
    full = (scan(inner, at, keys, True).join(terms, "key", "left")
            .withColumn("spans", F.concat("base", F.coalesce("terms", F.array()))).drop("terms"))
    return bare.unionByName(full).select(
        *[F.col(f"__c{i}").alias(c) for i, c in enumerate(kept)], "base", "spans")


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of every span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def mask(t: str, spans) -> str:
    """``t`` with every span replaced by the name of its kind; overlapping
    spans become one, named after the first."""
    out, end = [], 0
    for a, b, kind in sorted((s["start"], s["end"], s["kind"]) for s in spans):
        if a < end:
            # overlap: cut what the earlier replacement already covers
            end = max(end, b)
            continue
        out.append(t[end:a])
        out.append(f"[{kind.upper()}]")
        end = b
    return "".join(out) + t[end:]


def sanitise(df: DataFrame, text: str = "text", **options) -> DataFrame:
    """``df`` with personal data in ``text`` generalised: every span becomes
    the name of its kind, ``[EMAIL]``, ``[IP]``, ``[CARD]``, ``[PHONE]`` or
    ``[TERM]``.  Texts without spans, and null texts, stay as they are; no row
    is dropped."""
    found = find(df, text, **options).drop("base")
    names = found.columns[:-1]
    at, last = names.index(text), len(names)

    def run(batches):
        for b in byte_blocks(batches, at):
            new = [mask(t, s) if t is not None and s else t
                   for t, s in zip(b.column(at).to_pylist(), b.column(last).to_pylist())]
            cols = list(b.columns[:last])
            cols[at] = pa.array(new, pa.string())
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return found.mapInArrow(lean(run), found.drop("spans").schema)
