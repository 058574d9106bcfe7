"""Periodic runs of words (operator 11).

Online dyadic square catching.  Words are appended to a text; over every
completed block of a power-of-two number of words stands a catcher, which
waits for its block to come again as the suffix of the text at a distance its
size is responsible for.  Each appended word advances these suffix comparisons
(one fingerprint against one catcher per block size) and the ends of the
stretches that are still open; a stretch of two periods is a new square, and
squares of one period that overlap merge into one run.  The comparisons of a
stretch of appended words are made together, as array operations, so a text is
read once, in chunks, with state in proportion to its length.

Texts are independent, so the job is a map without a shuffle.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_blocks, extended, lean

CHUNK = 4096               # words appended at once

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class Powers:
    """Powers of an odd number modulo 2^64 and of its inverse, as many as the
    longest text so far needed: the weights of the block fingerprints."""

    BASE = 0x9E3779B97F4A7C15

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def need(self, n: int) -> None:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", self.BASE), ("down", pow(self.BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))


def scatter(ids: np.ndarray) -> np.ndarray:
    """Word numbers as well-spread 64-bit numbers."""
    x = (ids.astype(np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Catchers:
    """The catchers of one text.

    ``append`` takes further words (as numbers), ``finish`` returns the runs.
    A run of period ``q`` has at least ``max(shortest, copies * q)`` words, and
    ``copies >= 3``, so the words that have an equal word ``q`` places on
    contain a whole aligned block of ``b`` words for the ``b`` with
    ``b <= q < 2b`` (and, for small ``q``, of ``base`` words): its catcher sees
    the copy.  Equal fingerprints are only a hint; stretches are found by
    comparing words.
    """

    def __init__(self, powers: Powers, shortest: int = 24, copies: int = 3):
        if copies < 3 or shortest < 3:
            raise ValueError("a run needs at least three copies and three words")
        self.powers, self.shortest, self.copies = powers, shortest, copies
        self.base = 1 << (((-(-2 * shortest // 3) + 1) // 2).bit_length() - 1)
        self.n = 0
        self.words = np.zeros(64, np.int64)
        self.prefix = np.zeros(65, np.uint64)
        self.open: dict[int, int] = {}            # period -> start of the stretch at the end
        self.squares: list[tuple[int, int, int]] = []       # closed: (start, end, period)

    def append(self, words: np.ndarray) -> None:
        t0, t1 = self.n, self.n + len(words)
        if t1 > len(self.words):
            size = max(t1, 2 * len(self.words))
            self.words = np.concatenate([self.words[:t0], np.zeros(size - t0, np.int64)])
            self.prefix = np.concatenate([self.prefix[:t0 + 1], np.zeros(size - t0, np.uint64)])
        self.powers.need(t1 + 1)
        self.words[t0:t1] = words
        weighted = scatter(self.words[t0:t1]) * self.powers.up[t0:t1]
        self.prefix[t0 + 1:t1 + 1] = self.prefix[t0] + np.cumsum(weighted, dtype=np.uint64)
        self.n = t1
        self._advance(t0)
        self._catch(t0)

    def finish(self) -> list[tuple[int, int, int]]:
        """(start, length, period) of every run, by start, then period.  One
        stretch found under several periods has the smallest."""
        done = self.squares + [(s, self.n, q) for q, s in self.open.items()]
        least: dict[tuple[int, int], int] = {}
        for s, e, q in done:
            if e - s >= max(self.shortest, self.copies * q):
                least[s, e] = min(q, least.get((s, e), q))
        return sorted((s, e - s, q) for (s, e), q in least.items())

    def _advance(self, t0: int) -> None:
        """Compare the new words with those one period back, for every open
        stretch; the ones that end are kept if they are squares."""
        for q, s in list(self.open.items()):
            e = self._right(t0, q)
            if e < self.n:
                del self.open[q]
                self._close(s, e, q)

    def _close(self, s: int, e: int, q: int) -> None:
        if e - s >= 2 * q:
            self.squares.append((s, e, q))

    def _prints(self, at: np.ndarray, b: int) -> np.ndarray:
        return (self.prefix[at + b] - self.prefix[at]) * self.powers.down[at]

    def _hits(self, t0: int, b: int, back: int):
        """Suffixes of ``b`` words that the new words complete and that equal
        the block ``back`` blocks before the one they start in: (distance,
        block start)."""
        lo = max(t0 - b + 1, back * b)
        at = np.arange(lo, self.n - b + 1)
        if not len(at):
            return None
        first = lo // b - back
        blocks = self._prints(np.arange(first, (self.n - b) // b - back + 1) * b, b)
        block = at // b - back
        same = np.flatnonzero(self._prints(at, b) == blocks[block - first])
        at, c = at[same], block[same] * b
        if not back:
            at, c = at[at > c], c[at > c]
        return at - c, c

    def _catch(self, t0: int) -> None:
        parts, b = [], self.base
        while 2 * b <= self.n:
            for back in (0, 1) if b == self.base else (1,):
                found = self._hits(t0, b, back)
                if found is not None and len(found[0]):
                    parts.append((*found, np.full(len(found[0]), b)))
            b *= 2
        if not parts:
            return
        q, c, size = (np.concatenate(x) for x in zip(*parts))
        end = c + q + size
        for p, s in self.open.items():
            left = ~self._within(q, c, end, p, s, self.n)
            q, c, end = q[left], c[left], end[left]
        order = np.lexsort((c, q))
        q, c, end = q[order], c[order], end[order]
        while len(q):
            p, at = int(q[0]), int(c[0])
            s, e = self._left(at, p), self._right(at + p, p)
            if e == self.n:
                self.open[p] = s
            else:
                self._close(s, e, p)
            # a stretch of two periods swallows what its multiples would find
            left = ~self._within(q, c, end, p, s, e)
            left[0] = False
            q, c, end = q[left], c[left], end[left]

    @staticmethod
    def _within(q, c, end, p, s, e) -> np.ndarray:
        """Hits that the stretch [s, e) of period ``p`` explains: those of its
        own period, and of multiples if it is a square."""
        own = q % p == 0 if e - s >= 2 * p else q == p
        return own & (c >= s) & (end <= e)

    def _right(self, i: int, q: int) -> int:
        """First place from ``i`` on whose word differs from the one ``q`` before."""
        w, step = self.words, 32
        while i < self.n:
            k = min(step, self.n - i)
            differ = w[i:i + k] != w[i - q:i - q + k]
            if differ.any():
                return i + int(differ.argmax())
            i, step = i + k, 2 * step
        return i

    def _left(self, i: int, q: int) -> int:
        """Smallest start of words equal to those ``q`` after them, up to ``i``."""
        w, step = self.words, 32
        while i > 0:
            k = min(step, i)
            differ = w[i - k:i] != w[i - k + q:i + q]
            if differ.any():
                return i - int(differ[::-1].argmax())
            i, step = i - k, 2 * step
        return i


def runs_of(words: list, powers: Powers, shortest: int = 24, copies: int = 3):
    """The runs of a list of words: (start, length, period)."""
    if len(words) < shortest:
        return []
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, len(words))
    catchers = Catchers(powers, shortest, copies)
    for lo in range(0, len(ids), CHUNK):
        catchers.append(ids[lo:lo + CHUNK])
    return catchers.finish()


def find_runs(df: DataFrame, text: str = "text", keep=("doc_id",), shortest: int = 24,
              copies: int = 3) -> DataFrame:
    """Runs of every whole text, and the text without their repeats.

    Returns the columns ``keep`` and ``n_words``, ``runs`` (start, length and
    period in words, by start, then period) and ``collapsed``: the words that
    no run contains after its first period, joined by one blank.  Words are
    separated by blank, tab and the line breaks 0x0A to 0x0D.

    A null text counts as empty: no words, no runs, collapsed to ``''``; so do
    texts of white space.  Every row gives one row, repeated rows and null ids
    included; an empty table gives an empty one.  Columns not in ``keep`` are
    not looked at, so their names cannot clash.
    """
    src = df.select(*[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text"))
    schema = extended(src.drop("_text"), n_words="bigint", runs=RUNS, collapsed="string")
    struct = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()),
                                 ("period", pa.int64())]))

    def run(batches):
        powers = Powers()
        for b in byte_blocks(batches, len(keep)):
            counts, runs, texts = [], [], []
            for t in b.column(len(keep)):
                value = t.as_buffer()
                words = value.to_pybytes().split() if value is not None else []
                found = runs_of(words, powers, shortest, copies)
                counts.append(len(words))
                runs.append([{"start": s, "length": n, "period": q} for s, n, q in found])
                if found:
                    stays = np.ones(len(words), bool)
                    for s, n, q in found:
                        stays[s + q:s + n] = False
                    words = [words[i] for i in np.flatnonzero(stays)]
                texts.append(b" ".join(words).decode())
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:len(keep)], pa.array(counts, pa.int64()), pa.array(runs, struct),
                 pa.array(texts, pa.string())],
                names=[*keep, "n_words", "runs", "collapsed"])

    return src.mapInArrow(lean(run), schema)


def strongest(runs) -> F.Column:
    """The run with the greatest exact length / period, the first of equals
    (null without runs): fractions are compared by cross products."""
    col = F.col(runs) if isinstance(runs, str) else runs
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    return F.aggregate(col, none, lambda best, r: F.when(
        best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"]), r)
        .otherwise(best))
