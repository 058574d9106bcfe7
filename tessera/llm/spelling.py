"""Spelling variant grouping (operator 13).

Bloom-guided neighbourhoods.  Two words are near if one edit apart.  The
vocabulary's words are put into blocked Bloom filters, one per word length
(and per hash part of a length with many words); every task generates the
edits of its words as fingerprints, by arithmetic on the word's own, and
probes the filter of the edit's length.  Only positive edits become strings
and shuffle to an exact join with the vocabulary, which removes the false
positives and brings the counts.

Being near is symmetric, so a word's deletions and its replacements by a
larger code point find every pair once; insertions are the deletions of the
other word.  The filters of one round have at most ``ROUND_BYTES``; a
vocabulary whose filters are larger is probed in several rounds.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_blocks, lean, saved

WORDS_HELD = 200_000       # counts a task holds before it passes them on
BITS = 24                  # bits of filter per word
PART_WORDS = 1 << 17       # words of one filter, about
ROUND_BYTES = 64 << 20     # filters broadcast at once
TASK_WORDS = 8192          # words whose edits one task probes, about
EDITS = 1 << 20            # edits held at once

#: Odd multipliers that choose the bit of each of the 8 words of a block.
SALTS = np.array([0x47B6137B, 0x44974D91, 0x8824AD5B, 0xA2B7289D, 0x705495C7, 0x2DF1424B,
                  0x9EFC4947, 0x5C6BFB31], np.uint32)
STEP = 0x9E3779B97F4A7C15              # odd: positions weigh its powers
BACK = pow(STEP, -1, 1 << 64)

#: Letters of the word rule, as Latin-1 bytes: A-Z lower-cased, the rest blank.
LETTERS = bytes((c + 32 if 65 <= c <= 90 else c) if 65 <= c <= 90 or 97 <= c <= 122 or c >= 0xC0
                else 32 for c in range(256))


def count_words(df: DataFrame, text: str = "text", key: str = "doc_id", shortest: int = 5,
                drop_every: int = 0) -> DataFrame:
    """(word, n): the words of all whole texts, with at least ``shortest``
    code points.  A word is a maximal run of ``[A-Za-z\\u00C0-\\u00FF]``, A-Z
    lower-cased.  With ``drop_every``, misspellings are put in: where the
    crc32 of ``<key>:<run>`` is a multiple of it, the run loses the code point
    at that crc32 modulo its length.

    Null texts have no words; a null key counts as the empty text.  Counts are
    merged in the task before they shuffle, at most ``WORDS_HELD`` at a time.
    """
    src = df.select(F.coalesce(F.col(f"`{key}`").cast("string"), F.lit("")).alias("k"),
                    F.col(f"`{text}`").alias("t")).where(F.col("t").isNotNull())

    def run(batches):
        held: Counter = Counter()

        def out():
            batch = pa.RecordBatch.from_arrays(
                [pa.array([w.decode("latin-1") for w in held], pa.string()),
                 pa.array(list(held.values()), pa.int64())], names=["word", "n"])
            held.clear()
            return batch
        for b in byte_blocks(batches, 1):
            for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                runs = Counter(t.encode("latin-1", "replace").translate(LETTERS).split())
                first = zlib.crc32(f"{k}:".encode())
                for w, c in runs.items():
                    if drop_every:
                        h = zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), first)
                        if h % drop_every == 0:
                            at = h % len(w)
                            w = w[:at] + w[at + 1:]
                    if len(w) >= shortest:
                        held[w] += c
                if len(held) >= WORDS_HELD:
                    yield out()
        if held:
            yield out()

    return (src.mapInArrow(lean(run), "word string, n long")
            .groupBy("word").agg(F.sum("n").alias("n")))


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit numbers with every bit spread over all others."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def weights(n: int) -> np.ndarray:
    steps = np.full(n, STEP, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def letters(words) -> np.ndarray:
    """Code points of words of one length, a row per word."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1)


def strings(codes: np.ndarray) -> list[str]:
    flat, n = np.ascontiguousarray(codes).tobytes().decode("utf-32-le"), codes.shape[1]
    return [flat[i:i + n] for i in range(0, len(flat), n)]


def terms(codes: np.ndarray) -> np.ndarray:
    """What every letter adds to its word's fingerprint."""
    return mixed(codes.astype(np.uint64) + np.uint64(1)) * weights(codes.shape[1])


def of_part(h: np.ndarray, parts: int) -> np.ndarray:
    return (h >> np.uint64(40)) % np.uint64(parts)


def bits_of(h: np.ndarray, blocks: int):
    """The block of every fingerprint and its bit in each word of the block."""
    at = ((h & np.uint64(0xFFFFFFFF)) * np.uint64(blocks)) >> np.uint64(32)
    high = (h >> np.uint64(32)).astype(np.uint32)
    return at.astype(np.int64), [np.uint32(1) << ((high * s) >> np.uint32(27)) for s in SALTS]


def bloom(h: np.ndarray) -> np.ndarray:
    """Blocked filter of the fingerprints: rows of 256 bits."""
    table = np.zeros((max(1, -(-len(h) * BITS // 256)), 8), np.uint32)
    at, bits = bits_of(h, len(table))
    for i, bit in enumerate(bits):
        np.bitwise_or.at(table[:, i], at, bit)
    return table


def probe(h: np.ndarray, filters: dict, parts: int) -> np.ndarray:
    """Positions of the fingerprints that the filters of one length may hold."""
    found = []
    for part, table in filters.items():
        left = np.arange(len(h)) if parts == 1 else np.flatnonzero(of_part(h, parts) == part)
        high = (h >> np.uint64(32)).astype(np.uint32)
        at = (((h & np.uint64(0xFFFFFFFF)) * np.uint64(len(table))) >> np.uint64(32)).astype(np.int64)
        for i, s in enumerate(SALTS):
            bit = (high[left] * s) >> np.uint32(27)
            left = left[(table[at[left], i] >> bit) & np.uint32(1) == 1]
        found.append(left)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def edits(codes: np.ndarray, alphabet: np.ndarray, shorter, same):
    """Positive edits of words of one length: (row, code points of the edit).

    ``shorter`` and ``same`` are the filters (part -> table) and the number of
    parts for the edits' lengths, or None."""
    n, length = codes.shape
    t = terms(codes)
    whole = t.sum(axis=1, dtype=np.uint64)
    w = weights(length)
    if shorter is not None and length > 1:
        head = np.zeros(n, np.uint64)
        for i in range(length):
            # of equal neighbours one deletion stands for all
            rows = np.arange(n) if i == 0 else np.flatnonzero(codes[:, i] != codes[:, i - 1])
            tail = (whole - head - t[:, i]) * np.uint64(BACK)
            hit = rows[probe(mixed((head + tail)[rows]), *shorter)]
            if len(hit):
                yield hit, np.delete(codes[hit], i, axis=1)
            head = head + t[:, i]
    if same is not None:
        letter = mixed(alphabet.astype(np.uint64) + np.uint64(1))
        for i in range(length):
            row, c = np.nonzero(alphabet[None, :] > codes[:, i, None])
            hit = probe(mixed((whole - t[:, i])[row] + (letter * w[i])[c]), *same)
            if len(hit):
                out = codes[row[hit]].copy()
                out[:, i] = alphabet[c[hit]]
                yield row[hit], out


def build_filters(vocabulary: DataFrame) -> tuple[DataFrame, dict]:
    """One filter per length and hash part: (length, part, bits), and the
    number of parts of every length."""
    counts = vocabulary.groupBy(F.length("word").alias("length")).count().collect()
    parts = {r["length"]: -(-r["count"] // PART_WORDS) for r in counts}

    def prints(batches):
        for pdf in batches:
            size = pdf["word"].str.len()
            for length, group in pdf.groupby(size):
                h = mixed(terms(letters(group["word"])).sum(axis=1, dtype=np.uint64))
                yield pd.DataFrame({"length": int(length), "h": h.astype(np.int64),
                                    "part": of_part(h, parts[length]).astype(np.int64)})

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        table = bloom(pdf["h"].to_numpy().astype(np.uint64))
        return pd.DataFrame({"length": pdf["length"].iloc[:1], "part": pdf["part"].iloc[:1],
                             "bits": [table.tobytes()]})
    built = (vocabulary.select("word").mapInPandas(prints, "length int, h long, part long")
             .groupBy("length", "part").applyInPandas(build, "length int, part long, bits binary"))
    return built, parts


def candidates(vocabulary: DataFrame, alphabet: np.ndarray) -> DataFrame:
    """(word, n, other): words and those of their edits that a filter holds."""
    built, parts = build_filters(vocabulary)
    built = saved(built, "filters")
    sizes = (built.select("length", "part", F.length("bits").alias("size"))
             .orderBy("length", "part").collect())
    rounds, used = [[]], 0
    for r in sizes:                     # whole filters, in order, up to the bound
        if rounds[-1] and used + r["size"] > ROUND_BYTES:
            rounds.append([])
            used = 0
        rounds[-1].append((r["length"], r["part"]))
        used += r["size"]
    out = None
    for some in rounds:
        if not some:
            continue
        least, most = min(some), max(some)
        place = F.struct("length", "part")
        rows = built.where(place.between(
            F.struct(F.lit(least[0]).alias("length"), F.lit(least[1]).cast("long").alias("part")),
            F.struct(F.lit(most[0]).alias("length"), F.lit(most[1]).cast("long").alias("part"))))
        found = vocabulary.where(F.length("word").between(least[0], most[0] + 1)).mapInPandas(
            prober({(r["length"], r["part"]): r["bits"] for r in rows.collect()}, parts, alphabet),
            "word string, n long, other string")
        out = found if out is None else out.unionByName(found)
    if out is None:
        out = vocabulary.select("word", "n", F.lit(None).cast("string").alias("other")).limit(0)
    return out


def prober(raw: dict, parts: dict, alphabet: np.ndarray):
    """Task function: positive edits of the words of a partition, under the
    given filters."""
    def run(batches):
        tables: dict = {}
        for (length, part), bits in raw.items():
            tables.setdefault(length, {})[part] = np.frombuffer(bits, np.uint32).reshape(-1, 8)

        def of(length):
            return (tables[length], parts[length]) if length in tables else None
        for pdf in batches:
            for length, group in pdf.groupby(pdf["word"].str.len()):
                step = max(1, EDITS // max(len(alphabet), 1))
                for lo in range(0, len(group), step):
                    some = group.iloc[lo:lo + step]
                    for row, codes in edits(letters(some["word"]), alphabet, of(length - 1),
                                            of(length)):
                        yield pd.DataFrame({"word": some["word"].to_numpy()[row],
                                            "n": some["n"].to_numpy()[row],
                                            "other": strings(codes)})
    return lean(run)


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form): every word points at the word its form
    points at, and so on, doubling, until none moves.  Forms have at least
    twice the count, so chains are short and never closed."""
    at = saved(links.select("word", F.col("form").alias("root")), "roots")
    while True:
        further = at.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        moved = saved(at.join(further, "root", "left").select(
            "word", F.coalesce("_next", "root").alias("root"),
            F.col("_next").isNotNull().alias("_moved")), "roots")
        at = moved.select("word", "root")
        if moved.where("_moved").isEmpty():
            return at


def group_variants(words: DataFrame, ratio: int = 2) -> DataFrame:
    """Near words, forms and roots of a vocabulary (word, n).

    Two words are near if they differ by one inserted, deleted or replaced
    code point.  ``form`` is the near word with the largest ``n`` (ties: the
    smallest in code point order) if that is at least ``ratio`` times the
    word's own, else null; ``root`` is the last word reached through forms,
    the word itself if it has none.  Returns ``word, form, root, n, n_near,
    form_n``; ``n_near`` is 0 and ``form_n`` null where there is none.

    Rows that repeat a word are added up; null words and counts and the empty
    word are left out; an empty table gives an empty one.
    """
    if ratio <= 1:
        raise ValueError("forms must be more frequent than their words")
    clean = words.select("word", "n").where("word <> '' AND n IS NOT NULL")
    vocabulary = saved(clean.groupBy("word").agg(F.sum("n").alias("n")), "vocabulary")
    tasks = max(1, -(-vocabulary.count() // TASK_WORDS))
    # at most as many letters as there are code points
    found = vocabulary.select(F.explode(F.array_distinct(F.split("word", ""))).alias("c"))
    alphabet = np.array(sorted(ord(r["c"]) for r in found.where("c <> ''").distinct().collect()),
                        np.uint32)
    guesses = candidates(vocabulary.repartition(tasks), alphabet)
    others = vocabulary.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = guesses.join(others, "other")
    both = pairs.select(F.inline(F.array(
        F.struct("word", F.col("other").alias("near"), F.col("other_n").alias("near_n")),
        F.struct(F.col("other").alias("word"), F.col("word").alias("near"),
                 F.col("n").alias("near_n")))))
    best = both.groupBy("word").agg(
        F.count("*").alias("n_near"),
        F.min(F.struct((-F.col("near_n")).alias("k"), F.col("near").alias("w"))).alias("b"))
    enough = -F.col("b.k") >= ratio * F.col("n")
    formed = saved(vocabulary.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("b.w")).alias("form"), F.when(enough, -F.col("b.k")).alias("form_n")),
        "forms")
    ends = roots(formed.where("form IS NOT NULL"))
    return (formed.join(ends, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
