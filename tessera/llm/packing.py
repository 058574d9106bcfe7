"""Best-fit packing of token sequences (operator 8).

Documents become pieces of at most ``capacity`` tokens.  How pieces are
combined depends on their lengths only, so the search works on the histogram
of lengths: at most ``capacity`` numbers, whatever the size of the corpus.
Bin completion takes the largest length left, searches a filling of the rest
of the sequence by branch and bound, and uses the filling as often as the
counts allow.  If that needs more sequences than a lower bound, other
undominated fillings, and fewer uses of them, are tried across sequences, also
by branch and bound.  The bounds come from dual feasible functions of the
lengths (``least_sequences``); a filling is dominated if a piece left over
could take the place of some of its pieces (``dominated``).  The pieces get their places by their rank among the pieces of
the same length, which is counted in bounded blocks.
"""

from __future__ import annotations

import math
import os
from array import array
from functools import lru_cache
from heapq import heappop, heappush

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import byte_blocks, extended, lean, saved, tokenizer_path

CAPACITY = 2048
SEPARATOR = 0
NODES = 3000               # search nodes a filling may take; the incumbent stands then
BRANCHES = 2000            # steps the search across sequences may take off the first run
WIDTH = 16                 # fillings of least waste that a step of it branches over
CLASSES = 20               # dual feasible functions of the lower bound
RANK_BLOCK = 256           # least number of pieces that are ranked together
CACHE = 500_000            # words and parts a worker remembers
LATIN_END = "\u0250"       # first character that needs the vocabulary's own normaliser


def _byte_chars() -> list[str]:
    """Character of every byte in a byte-level vocabulary: itself if it is
    visible, else the next one from 256 on."""
    seen = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = iter(range(256, 512))
    return [chr(b) if b in seen else chr(next(rest)) for b in range(256)]


BYTE_CHARS = _byte_chars()


class WordIds:
    """Ids of whole texts, each distinct word encoded once per worker.

    Blanks and line feeds always separate the vocabulary's words, so a text is
    cut there.  What is left is normalised and cut by the vocabulary's pattern,
    and the library's model merges the parts.  Words that hold the start of a
    special string, and very long ones, go through the whole library.
    """

    def __init__(self, vocabulary: str):
        """``vocabulary``: content of the file."""
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer
        self.encode = Tokenizer.from_str(vocabulary)
        self.normal = self.encode.normalizer.normalize_str
        self.merge = self.encode.model.tokenize
        self.split = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\s\p{L}\p{N}]+").findall
        self.words: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}

    def library(self, s: str) -> bytes:
        return array("I", self.encode.encode(s, add_special_tokens=False).ids).tobytes()

    def part(self, p: str) -> bytes:
        got = self.parts.get(p)
        if got is None:
            mapped = p if p.isascii() and p.isprintable() else "".join(map(BYTE_CHARS.__getitem__, p.encode()))
            got = array("I", [t.id for t in self.merge(mapped)]).tobytes()
            if len(self.parts) >= CACHE:
                self.parts.clear()
            self.parts[p] = got
        return got

    def word(self, w: str) -> bytes:
        if "<|" in w or len(w) > 64:
            return self.library(w)
        # up to there NFC changes nothing and lower case is simple
        plain = w.lower() if w.isascii() or max(w) < LATIN_END else self.normal(w)
        if plain.isascii() and plain.isalpha():
            got = self.part(plain)
        elif plain.isascii() and plain[-1] in ".,!?;:" and plain[:-1].isalpha():
            got = self.part(plain[:-1]) + self.part(plain[-1])
        else:
            got = b"".join(map(self.part, self.split(plain)))
        if len(self.words) >= CACHE:
            self.words.clear()
        self.words[w] = got
        return got

    def __call__(self, text: str) -> bytes:
        known = self.words.get
        return b"".join([got if (got := known(w)) is not None else self.word(w)
                         for w in text.replace("\n", " ").split(" ") if w])


def pieces(df: DataFrame, doc_id: str = "doc_id", text: str = "text",
           vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """Token pieces of every document: ``row, doc_id, piece, start, length,
    ids`` (``ids``: little-endian unsigned 32-bit numbers).

    A document is its ids followed by the separator id; a null text counts as
    empty and gives the separator alone.  Only documents longer than
    ``capacity`` are cut.  ``row`` numbers the output rows, so repeated rows
    and rows with the same or no id are documents of their own; an empty table
    gives no pieces.  The result is written once, so that tokenising is not
    repeated.
    """
    with open(vocabulary or tokenizer_path("word_bpe_49k.json"), encoding="utf-8") as f:
        content = df.sparkSession.sparkContext.broadcast(f.read())   # one file's size
    inner = df.select(F.coalesce(F.col(text), F.lit("")).alias("text"),
                      F.col(doc_id).cast("long").alias("doc_id"))
    end = array("I", [SEPARATOR]).tobytes()
    step = 4 * capacity

    def run(batches):
        ids_of = WordIds(content.value)
        for b in byte_blocks(batches, 0, 4 << 20):
            doc, piece, start, length, ids = [], [], [], [], []
            for i, t in zip(b.column(1).to_pylist(), b.column(0).to_pylist()):
                whole = ids_of(t) + end
                for k, lo in enumerate(range(0, len(whole), step)):
                    part = whole[lo:lo + step]
                    doc.append(i)
                    piece.append(k)
                    start.append(lo // 4)
                    length.append(len(part) // 4)
                    ids.append(part)
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()),
                 pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                 pa.array(ids, pa.binary())],
                names=["doc_id", "piece", "start", "length", "ids"])

    cut = inner.mapInArrow(lean(run), "doc_id long, piece int, start long, length long, ids binary")
    return saved(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")


@lru_cache(8)
def _classes(capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Dual feasible values of every length up to ``capacity``, a row a
    function, and the value of a whole sequence in each: the length itself;
    and for k from 1 the number of (k+1)-th parts of a sequence that the length
    passes, of k (a length of exactly so many parts keeps its share)."""
    n = np.arange(capacity + 1, dtype=np.int64)
    rows, whole = [n], [capacity]
    for k in range(1, CLASSES):
        parts = (k + 1) * n
        rows.append(np.where(parts % capacity == 0, k * n, parts // capacity * capacity))
        whole.append(k * capacity)
    return np.array(rows), np.array(whole, np.int64)


def least_sequences(counts: list[int], capacity: int = CAPACITY) -> int:
    """A lower bound of the sequences that ``counts[n]`` pieces of every
    length ``n`` up to ``capacity`` take.

    The values of pieces that fit together never add up to more than a whole
    sequence in any function of ``_classes``, also if lengths beyond
    ``capacity - e`` count as whole sequences and those under ``e`` as nothing,
    for every ``e`` up to half of the capacity.  The greatest bound counts.
    """
    values, whole = _classes(capacity)
    number = np.array(counts, np.int64)
    upto, pieces_upto = np.cumsum(values * number, axis=1), np.cumsum(number)
    e = np.arange(capacity // 2 + 1)
    middle = upto[:, capacity - e] - np.where(e > 0, upto[:, np.maximum(e - 1, 0)], 0)
    sums = (middle + whole[:, None] * (pieces_upto[-1] - pieces_upto[capacity - e])).max(axis=1)
    return int((-(-sums // whole)).max())


def dominated(chosen: list[int], waste: int, over: int) -> bool:
    """Whether a piece left over (bits of ``over``: their lengths) fits in the
    place of some pieces of the filling ``chosen`` with ``waste``: it is
    longer than they are together, by the waste at most, or exactly as long as
    two or more of them.  Any packing with such a filling can trade them and
    stays as short, so it need not be tried."""
    every, two = 1, 0                          # sums of any pieces, of two or more
    for n in chosen:
        two |= (every & ~1 | two) << n
        every |= every << n
    if two & over:
        return True
    reach, width = every << 1, 1               # sums plus 1 to ``waste``
    while width < waste:
        step = min(width, waste - width)
        reach |= reach << step
        width += step
    return waste > 0 and bool(reach & over)


def fill(room: int, top: int, counts: list[int], below: list[int], sums: list[int],
         nodes: int = NODES) -> list[int]:
    """Lengths that fill ``room`` best, found by branch and bound.

    Lengths are tried from the largest that fits, so the first leaf is the
    best-fit filling and becomes the incumbent; fillings of more and smaller
    pieces with the same waste are dominated by it and never replace it.  A
    branch is left when all smaller pieces together could not come under the
    incumbent's waste.  ``below[n]`` is the largest length present up to
    ``n``, ``sums[n]`` the tokens in all pieces up to length ``n``.
    """
    best, waste, spent = [], room + 1, 0
    used: dict[int, int] = {}
    chosen: list[int] = []
    stack = [(room, below[min(room, top)])]
    while stack:
        left, n = stack[-1]
        while n > 0 and used.get(n, 0) >= counts[n]:
            n = below[n - 1]
        dead = n <= 0 or left - sums[n] >= waste or spent >= nodes
        if dead:
            if left < waste:
                best, waste = list(chosen), left
            stack.pop()
            if stack:
                used[chosen.pop()] -= 1
            if waste == 0 or spent >= nodes:
                break
            continue
        stack[-1] = (left, below[n - 1])       # the next alternative at this place
        spent += 1
        chosen.append(n)
        used[n] = used.get(n, 0) + 1
        rest = left - n
        stack.append((rest, below[min(rest, n)]))
    return best


def fillings(room: int, top: int, counts: list[int], below: list[int], sums: list[int],
             slack: int, nodes: float = NODES, width: int | None = WIDTH) -> tuple[list[list[int]], bool]:
    """Undominated fillings of ``room`` with at most ``slack`` waste, the
    ``width`` of least waste first (of those that ``nodes`` steps reach, larger
    pieces first), and whether these are all."""
    found, spent = [], 0
    present = sum(1 << n for n in range(1, min(room, top) + 1) if counts[n])
    used: dict[int, int] = {}
    chosen: list[int] = []
    stack = [(room, below[min(room, top)])]
    while stack:
        left, n = stack[-1]
        while n > 0 and used.get(n, 0) >= counts[n]:
            n = below[n - 1]
        if n <= 0 or left - sums[n] > slack or spent >= nodes:
            if left <= slack:
                over = present
                for v in set(chosen):
                    if used[v] >= counts[v]:
                        over &= ~(1 << v)
                if not dominated(chosen, left, over):
                    found.append((left, len(found), list(chosen)))
            stack.pop()
            if stack:
                used[chosen.pop()] -= 1
            continue
        stack[-1] = (left, below[n - 1])
        spent += 1
        chosen.append(n)
        used[n] = used.get(n, 0) + 1
        stack.append((left - n, below[min(left - n, n)]))
    whole = spent < nodes and (width is None or len(found) <= width)
    return [f for _, _, f in sorted(found)[:width]], whole


def _tables(counts: list[int]) -> tuple[list[int], list[int]]:
    """``below`` and ``sums`` of the counts, see ``fill``."""
    below, sums = [0] * len(counts), [0] * len(counts)
    for n in range(1, len(counts)):
        below[n] = n if counts[n] else below[n - 1]
        sums[n] = sums[n - 1] + n * counts[n]
    return below, sums


def _most(counts: list[int], lengths: list[int]) -> int:
    """How often the counts allow the filling."""
    return min(counts[v] // lengths.count(v) for v in set(lengths))


def _first_run(counts: list[int], capacity: int, nodes: int) -> list[tuple[int, list[int]]]:
    """Patterns with the best filling of every step, as often as it goes."""
    counts, patterns = list(counts), []
    below, sums = _tables(counts)
    while (n := below[capacity]) > 0:
        counts[n] -= 1                         # the piece the sequence is built around
        rest = fill(capacity - n, n, counts, below, sums, nodes) if n < capacity else []
        counts[n] += 1
        lengths = [n, *rest]
        times = _most(counts, lengths)
        for v in lengths:
            counts[v] -= times
        patterns.append((times, lengths))
        below, sums = _tables(counts)
    return patterns


def search(histogram: dict[int, int], capacity: int = CAPACITY, nodes: int | None = NODES,
           branches: int | None = BRANCHES,
           width: int | None = WIDTH) -> tuple[list[tuple[int, list[int]]], int]:
    """Sequence patterns ``(how often, lengths)`` that use up the histogram,
    and a number of sequences that no packing can go below: the patterns are
    proved best if they need as many.

    Every step completes a sequence around the largest length left and repeats
    it, so the number of patterns depends on the capacity, not on the number
    of pieces.  The first run takes the best filling as often as the counts
    allow and stands if the lower bound is reached.  Otherwise steps are
    branched over their undominated fillings, and over using one as often as
    it goes, half as often or once; runs with the fewest departures from the
    first choice come first (fewer uses count as two), of these the ones that
    depart early, and a run is left when the bound of what remains cannot come
    under the incumbent.  After ``branches`` steps the incumbent stands.  With
    ``nodes``, ``branches`` and ``width`` of None the search ends only with
    its proof, which may take time exponential in the number of lengths.
    """
    nodes, branches = nodes or math.inf, math.inf if branches is None else branches
    counts = [0] * (capacity + 1)
    for n, c in histogram.items():
        counts[n] += c
    total = sum(n * c for n, c in enumerate(counts))
    best = _first_run(counts, capacity, nodes)
    fewest, least = sum(t for t, _ in best), least_sequences(counts, capacity)
    spent, number, whole = 0, 0, True
    # departures, depth of the last one, -depth, number;
    # counts before the last pattern, tokens after it, sequences, patterns
    heap = [(0, 0, 0, 0, counts, total, 0, None)]
    while heap and fewest > least and spent < branches:
        off, last, depth, _, counts, left, used, run = heappop(heap)
        spent += off > 0
        if not left and used < fewest:
            fewest, best = used, []
            while run:
                run, pattern = run
                best.append(pattern)
            best.reverse()
            continue
        if used - (-left // capacity) >= fewest:
            continue
        if run:
            counts = list(counts)
            for v in run[1][1]:
                counts[v] -= run[1][0]
            if used + least_sequences(counts, capacity) >= fewest:
                continue
        below, sums = _tables(counts)
        n = below[capacity]
        slack = (fewest - 1 - used) * capacity - left
        counts[n] -= 1
        options, every = (fillings(capacity - n, n, counts, below, sums, slack, nodes, width)
                          if n < capacity else ([[]], True))
        counts[n] += 1
        whole = whole and every
        first = True
        for rest in options:
            lengths = [n, *rest]
            most = _most(counts, lengths)
            for times in dict.fromkeys((most, -(-most // 2), 1)):
                if times * (capacity - sum(lengths)) <= slack:
                    number += 1
                    more = 0 if first else 1 + (times < most)
                    heappush(heap, (off + more, -depth if more else last, depth - 1, number, counts,
                                    left - times * sum(lengths), used + times,
                                    (run, (times, lengths))))
                    first = False
    return best, fewest if whole and not heap else min(least, fewest)


def complete(histogram: dict[int, int], capacity: int = CAPACITY, nodes: int | None = NODES,
             branches: int | None = BRANCHES) -> list[tuple[int, list[int]]]:
    """The patterns of ``search``."""
    return search(histogram, capacity, nodes, branches)[0]


def places(patterns) -> tuple[np.ndarray, ...]:
    """Lookup arrays sorted by (length, rank): key, how often, first sequence,
    offset.  The pieces of a length take its places in rank order."""
    rank: dict[int, int] = {}
    rows, sequence = [], 0
    for times, lengths in patterns:
        offset = 0
        for n in lengths:
            lo = rank.get(n, 0)
            rank[n] = lo + times
            rows.append((n, lo, sequence, offset))
            offset += n
        sequence += times
    rows.sort()
    n, lo, seq, off = (np.array([r[i] for r in rows], np.int64) for i in range(4))
    return (n << 44) | lo, lo, seq, off


def pack(cut: DataFrame, capacity: int = CAPACITY, nodes: int | None = NODES,
         branches: int | None = BRANCHES, width: int | None = WIDTH) -> DataFrame:
    """Places for pieces: the columns of ``cut`` (which holds ``row`` and
    ``length``, 1 to ``capacity``) with ``sequence_id``, ``offset`` and
    ``least_sequences``, the number of sequences that no packing can go below
    (the same in all rows): if there are as many, the packing is proved best.
    ``nodes``, ``branches`` and ``width`` bound the search; None takes each
    bound off (see ``search``).

    Every piece is placed once, offsets in a sequence are gapless from 0, no
    sequence is longer than ``capacity``.  An empty table gives an empty
    result.  Pieces are told apart by ``row``; other columns may hold nulls and
    repeat.  Columns of ``cut`` named ``sequence_id``, ``offset`` or
    ``least_sequences`` are replaced.  What reaches the driver is the histogram of lengths.
    """
    names = [c for c in cut.columns if c not in ("sequence_id", "offset", "least_sequences")]
    cut = cut.select(*names)
    histogram = {r["length"]: r["n"] for r in
                 cut.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(not 0 < n <= capacity for n in histogram):
        raise ValueError(f"piece lengths must lie in 1 to {capacity}")
    patterns, least = search(histogram, capacity, nodes, branches, width)
    table = places(patterns)
    # a length's pieces are ranked in blocks by the hash of the row number
    blocks = [1] * (capacity + 1)
    for n, c in histogram.items():
        blocks[n] = -(-c // max(RANK_BLOCK, int(c ** 0.5)))
    block = F.pmod(F.xxhash64("row"), F.get(F.lit(blocks), F.col("length").cast("int")))
    dealt = cut.withColumn("__block", block.cast("long"))
    sizes = dealt.groupBy("length", "__block").agg(F.count("*").alias("__n"))
    before = Window.partitionBy("length").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("length", "__block",
                          F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    within = Window.partitionBy("length", "__block").orderBy("row")
    ranked = (dealt.withColumn("__at", F.row_number().over(within))
              .join(starts, ["length", "__block"])
              .withColumn("__rank", F.col("__before") + F.col("__at") - 1)
              .select(*names, "__rank"))
    shared = cut.sparkSession.sparkContext.broadcast(table)   # bounded by the patterns
    at, rank = names.index("length"), len(names)

    def run(batches):
        key, lo, seq, off = shared.value
        for b in batches:
            n = b.column(at).to_numpy()
            r = b.column(rank).to_numpy()
            i = np.searchsorted(key, (n << 44) | r, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:rank], pa.array(seq[i] + r - lo[i]), pa.array(off[i])],
                names=[*names, "sequence_id", "offset"])

    return (ranked.mapInArrow(lean(run), extended(cut, sequence_id="long", offset="long"))
            .withColumn("least_sequences", F.lit(least).cast("long")))


def sequences(placed: DataFrame, cut: DataFrame) -> DataFrame:
    """The packed sequences themselves: ``sequence_id, length, ids``; pieces
    of a sequence (at most its capacity) meet in one row."""
    parts = placed.select("row", "sequence_id", "offset").join(
        cut.select("row", "length", "ids"), "row")
    return (parts.groupBy("sequence_id")
            .agg(F.sum("length").alias("length"),
                 F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("p"))
            .select("sequence_id", "length",
                    F.unhex(F.array_join(F.transform("p", lambda p: F.hex(p["ids"])), ""))
                    .alias("ids")))
