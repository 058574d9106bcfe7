"""N-gram Jaccard join and its connected components (operator 10).

Documents are rows of a sparse incidence matrix over word n-grams; two link
when their rows overlap enough.  The overlaps are entries of the matrix times
its transpose, which is taken in blocks of rows, and inside a block in ranges
of n-grams whose counts add up.  Size-derived bounds keep the blocks few
without losing a link:

* rows that are equal are one class from the start;
* rows that overlap enough share one of their ``size - need + 1`` first
  n-grams, in any order that is the same for all rows.  The order puts n-grams
  last that are known to be frequent, so that passages many documents share
  bring few rows together;
* only rows whose sizes allow the overlap are brought together.

Rows that share such an n-gram by chance are many in a large corpus, and chains
of them would run through most of it.  So every row has a sketch, the parities
of its n-grams over about as many bits as it has n-grams: two rows differ in
at least as many n-grams as their sketches differ in bits.  Rows that share an
n-gram, and whose places in the order and sketches allow a link, are tied;
what is tied forms the candidate groups, and the product is taken inside each
group.  A large group is cut into blocks by size and hash; the blocks' own
products and those with one chosen block come first, and where they connect
the whole group the others are not needed.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_blocks, lean, saved

FREQUENT = 3               # documents whose prefixes share an n-gram that is put last
MARKS = 1 << 26            # bits of the filters over n-grams and classes (8 MB)
LIST = 8192                # rows of one n-gram whose sketches are compared in one task
PAIRS = 4                  # rows of one n-gram that are sent on as pairs
CUT_LISTS = 1 << 16        # lists that may be cut into parts
BLOCK = 1024               # rows of a block of the product
GRAMS = 1 << 21            # n-grams in the sets of a block
COLUMNS = 8192             # n-grams of a range of the product
GRAPH = 1 << 18            # edges of a graph whose components one task finds
TEXTS = 2 << 20            # bytes of texts that are hashed as a block
PIECE = 1 << 20            # bytes of them at once

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15                     # odd, so it has an inverse modulo 2^64
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out)


class Shingler:
    """Sorted distinct 64-bit hashes of the n-grams of texts.

    Words are what lies between ASCII white space, with A-Z in lower case; a
    text with fewer than ``n`` words has its whole sequence as one n-gram, a
    text without words none.  A block of texts is hashed as a whole: the hash
    of a word is a difference of running sums of its bytes' random numbers
    times powers of an odd base.
    """

    def __init__(self, n: int):
        self.n = n
        self.lower = np.arange(256, dtype=np.uint8)
        self.lower[65:91] += 32
        self.space = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
        self.number = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
        self.up, self.down = _powers(_BASE, PIECE), _powers(_INVERSE, PIECE)

    def words(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of the words data[start:end], in pieces of bounded size."""
        out = np.zeros(len(starts), np.uint64)
        run = 0
        for lo in range(0, len(data), PIECE):
            part = data[lo:lo + PIECE]
            scale = np.uint64(pow(_BASE, lo, 1 << 64))
            terms = self.number[part] * self.up[:len(part)] * scale
            sums = np.cumsum(terms) + np.uint64(run)
            a, b = np.searchsorted(starts, [lo, lo + len(part)])
            at = starts[a:b] - lo
            out[a:b] -= sums[at] - terms[at]
            a, b = np.searchsorted(ends, [lo + 1, lo + len(part) + 1])
            out[a:b] += sums[ends[a:b] - 1 - lo]
            run = int(sums[-1])
        for lo in range(0, len(data), PIECE):
            a, b = np.searchsorted(starts, [lo, lo + PIECE])
            out[a:b] *= self.down[starts[a:b] - lo] * np.uint64(pow(_INVERSE, lo, 1 << 64))
        return _mix(out + (ends - starts).astype(np.uint64))

    def grams(self, h: np.ndarray, n: int) -> np.ndarray:
        acc = np.full(len(h) - n + 1, n, np.uint64)
        for i in range(n):
            acc = _mix(acc ^ h[i:len(h) - n + 1 + i]) + np.uint64(i)
        return acc

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        texts = texts.cast(pa.binary()).fill_null(b"")
        if not len(texts):
            return []
        at = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset:texts.offset + len(texts) + 1]
        at = at.astype(np.int64)
        raw = texts.buffers()[2]
        data = (np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8))[at[0]:at[-1]]
        at = at - at[0]
        data = self.lower[data]
        word = ~self.space[data]
        edge = np.zeros(len(data) + 1, bool)
        edge[at] = True                        # no word goes over the end of a text
        before = np.concatenate([[False], word])[:len(word)]
        after = np.concatenate([word[1:], [False]])[:len(word)]
        starts = np.flatnonzero(word & (~before | edge[:-1]))
        ends = np.flatnonzero(word & (~after | edge[1:])) + 1
        h = self.words(data, starts, ends)
        first = np.searchsorted(starts, at)
        full = self.grams(h, self.n) if len(h) >= self.n else np.zeros(0, np.uint64)
        out = []
        for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
            if b - a >= self.n:
                s = np.sort(full[a:b - self.n + 1])
                keep = np.ones(len(s), bool)
                np.not_equal(s[1:], s[:-1], out=keep[1:])
                out.append(s[keep])
            else:
                out.append(self.grams(h[a:b], b - a) if b > a else np.zeros(0, np.uint64))
        return out


def class_of(s: np.ndarray) -> int:
    """Signed 64-bit number of an n-gram set."""
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def prefix_size(n: int, percent: int) -> int:
    """N-grams of a set of ``n`` of which any set that overlaps it enough must
    hold one."""
    return n - (-(-percent * n // 100)) + 1 if n else 0


def _lists(rows: list[np.ndarray], kind=pa.int64()) -> pa.Array:
    flat = np.concatenate([np.zeros(0, np.uint64), *rows])
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, rows)]), pa.int32()),
                                    pa.array(flat.view(np.int64), kind))


def sketch(s: np.ndarray) -> bytes:
    """Parities of the numbers of n-grams of a set by some bits of their hash:
    a power of two of bits, 64 at least, more than n-grams and at most twice
    as many."""
    size = max(64, 1 << len(s).bit_length())
    at = ((s >> np.uint64(20)) & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=size) & 1).astype(np.uint8), bitorder="little").tobytes()


def differing(x: bytes, y: bytes) -> int:
    """Bits in which two sketches differ, the longer one folded to the length
    of the other: never more than the n-grams that only one set has."""
    a, b = int.from_bytes(x, "little"), int.from_bytes(y, "little")
    size = 8 * max(len(x), len(y))
    while size > 8 * min(len(x), len(y)):
        size //= 2
        if len(x) > len(y):
            a = (a >> size) ^ (a & ((1 << size) - 1))
        else:
            b = (b >> size) ^ (b & ((1 << size) - 1))
    return (a ^ b).bit_count()


def _scan(df: DataFrame, n: int) -> DataFrame:
    """(id, n, class, sketch) per document."""
    def run(batches):
        shingles = Shingler(n)
        for b in byte_blocks(batches, 0, TEXTS):
            sets = shingles(b.column(0))
            yield pa.RecordBatch.from_arrays(
                [b.column(1), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([class_of(s) for s in sets], pa.int64()),
                 pa.array([sketch(s) if len(s) else None for s in sets], pa.binary())],
                names=["id", "n", "class", "sketch"])

    return df.mapInArrow(lean(run), "id long, n long, class long, sketch binary")


def _frequencies(df: DataFrame, n: int, percent: int) -> DataFrame:
    """(gram, c): how many documents have an n-gram among the first of their
    set, in the order of the hashes; counted per block before the shuffle."""
    def run(batches):
        shingles = Shingler(n)
        for b in byte_blocks(batches, 0, TEXTS):
            cut = [s[:prefix_size(len(s), percent)] for s in shingles(b.column(0))]
            grams, c = np.unique(np.concatenate([np.zeros(0, np.uint64), *cut]), return_counts=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(grams.view(np.int64)), pa.array(c, pa.int32())], names=["gram", "c"])

    return (df.mapInArrow(lean(run), "gram long, c int").groupBy("gram")
            .agg(F.sum("c").alias("c")).where(F.col("c") >= FREQUENT))


def _marks(values: DataFrame, c: str) -> np.ndarray:
    """Bits ``value mod MARKS`` of a column: a filter of fixed size."""
    bit = F.pmod(F.col(c), F.lit(MARKS)) + 1
    pages = (values.groupBy(F.bitmap_bucket_number(bit).alias("page"))
             .agg(F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("bits")).collect())
    bits = np.zeros((-(-MARKS // 32768), 4096), np.uint8)      # low bits first
    for r in pages:
        bits[r.page - 1] = np.frombuffer(r.bits, np.uint8)
    return bits.reshape(-1)


def _marked(bits: np.ndarray, values: np.ndarray) -> np.ndarray:
    at = values & np.uint64(MARKS - 1)
    return (bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1


def _prefixes(df: DataFrame, n: int, percent: int, shared) -> DataFrame:
    """(class, n, grams, parts): the first n-grams of every set, frequent ones
    last.  ``parts`` tells into how many parts an n-gram's list is cut; null
    stands for one each."""
    def run(batches):
        shingles = Shingler(n)
        bits, long_grams, long_counts = shared.value

        def prefix(s):
            late = _marked(bits, s)
            cut = s[np.lexsort((s, late))][:prefix_size(len(s), percent)] if late.any() else \
                s[:prefix_size(len(s), percent)]
            if not len(long_grams):
                return cut, None
            at = np.minimum(np.searchsorted(long_grams, cut), len(long_grams) - 1)
            parts = np.where(long_grams[at] == cut, -(-long_counts[at] // LIST), 1)
            return cut, parts if parts.max() > 1 else None

        for b in byte_blocks(batches, 0, TEXTS):
            rows = [s for s in shingles(b.column(0)) if len(s)]
            cut = [prefix(s) for s in rows]
            yield pa.RecordBatch.from_arrays(
                [pa.array([class_of(s) for s in rows], pa.int64()),
                 pa.array([len(s) for s in rows], pa.int64()), _lists([c for c, _ in cut]),
                 pa.array([p for _, p in cut], pa.list_(pa.int32()))],
                names=["class", "n", "grams", "parts"])

    return df.mapInArrow(lean(run), "class long, n long, grams array<long>, parts array<int>")


PAIR, RUN, TIE = 0, 1, 2


def _shared(percent: int):
    """What rows that share an n-gram have to do with each other, as (kind, a,
    b), from rows sorted by (gram, part, n, class).  Between two rows of a list
    whose sizes allow a link lie only rows of such sizes, so lists fall into
    runs of neighbours.  Of a short run every pair goes on whose overlap can be
    large enough if the n-gram is the first that both hold (``PAIR``); of a
    longer one each row, under a number that runs of the same rows have in
    common (``RUN``).  The rows of a run longer than ``LIST`` are tied to its
    first row, those of a cut list to a node of their own, the n-gram
    (``TIE``)."""
    names = ["gram", "part", "n", "class", "pos", "of"]

    def found(t):
        g, p, n, c, pos, of = (t.column(k).to_numpy() for k in names)
        cut = of > 1
        out = [(TIE, c[cut], g[cut])]
        g, p, n, c, pos = (x[~cut] for x in (g, p, n, c, pos))
        if len(g):
            first = np.ones(len(g), bool)
            first[1:] = (g[1:] != g[:-1]) | (p[1:] != p[:-1]) | (100 * n[:-1] < percent * n[1:])
            heads = np.flatnonzero(first)
            size = np.diff(np.append(heads, len(g)))
            run, size = np.cumsum(first) - 1, np.repeat(size, size)
            short = size <= PAIRS
            for d in range(1, min(PAIRS, len(g))):
                i = np.flatnonzero(short[:-d] & (run[:-d] == run[d:]))
                j = i + d
                most = np.minimum(n[i] - pos[i], n[j] - pos[j])
                ok = ((100 + percent) * most >= percent * (n[i] + n[j])) & (c[i] != c[j])
                i, j = i[ok], j[ok]
                out.append((PAIR, np.minimum(c[i], c[j]), np.maximum(c[i], c[j])))
            rows = ~short & (size <= LIST)
            number = _mix(np.add.reduceat(_mix(c.view(np.uint64)), heads)).view(np.int64)
            out.append((RUN, number[run[rows]], c[rows]))
            rows = size > LIST
            out.append((TIE, c[rows], c[heads][run[rows]]))
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat([k for k, _, _ in out], [len(a) for _, a, _ in out]), pa.int32()),
             pa.array(np.concatenate([a for _, a, _ in out])),
             pa.array(np.concatenate([b for _, _, b in out]))], names=["kind", "a", "b"])

    def run(batches):
        held = []                              # the last list so far
        for b in batches:
            if not b.num_rows:
                continue
            g, p = b.column("gram").to_numpy(), b.column("part").to_numpy()
            lo = int(np.flatnonzero((g != g[-1]) | (p != p[-1])).max(initial=-1)) + 1
            if not lo and held and (held[-1].column("gram")[0].as_py(), held[-1].column("part")[0].as_py()) == (g[0], p[0]):
                held.append(b)
                continue
            whole = [*held, b.slice(0, lo)]
            yield found(pa.Table.from_batches(whole))
            held = [b.slice(lo)]
        if held:
            yield found(pa.Table.from_batches(held))

    return run


def _alike(ids: list, n: np.ndarray, sketches: list[bytes], percent: int) -> list[tuple[int, int]]:
    """Edges that connect the rows whose sketches allow a link."""
    def enough(x, y, bits):
        return ((100 + percent) * (x + y - bits) >= 2 * percent * (x + y)) \
            & (100 * np.minimum(x, y) >= percent * np.maximum(x, y))
    if len(ids) <= 2 * PAIRS:
        return [(ids[i], ids[j]) for i, j in combinations(range(len(ids)), 2)
                if enough(n[i], n[j], differing(sketches[i], sketches[j]))]
    by = {}                                    # length of sketches: rows, sketches folded to lengths
    length = np.array([len(x) for x in sketches])
    for k in np.unique(length).tolist():
        at = np.flatnonzero(length == k)
        by[k] = at, {k: np.frombuffer(b"".join(sketches[i] for i in at.tolist()), np.uint64).reshape(len(at), -1)}

    def folded(k, to):
        kept = by[k][1]
        if to not in kept:
            x = folded(k, 2 * to)
            kept[to] = x[:, :x.shape[1] // 2] ^ x[:, x.shape[1] // 2:]
        return kept[to]
    place = np.zeros(len(ids), np.int64)
    for at, _ in by.values():
        place[at] = np.arange(len(at))
    left = {k: np.arange(len(at)) for k, (at, _) in by.items()}
    out, seen = [], np.zeros(len(ids), bool)
    for i in range(len(ids)):
        if seen[i]:
            continue
        k = int(length[i])
        left[k] = left[k][left[k] != place[i]]
        front = [i]
        while front and any(map(len, left.values())):
            x = front.pop()
            for k, (at, _) in by.items():
                some = left[k]
                if not len(some):
                    continue
                to = min(k, int(length[x]))
                own = folded(int(length[x]), to)[place[x]]
                bits = np.bitwise_count(folded(k, to)[some] ^ own).sum(axis=1, dtype=np.int64)
                ok = enough(n[at[some]], n[x], bits)
                if ok.any():
                    new, left[k] = at[some[ok]].tolist(), some[~ok]
                    seen[new] = True
                    front += new
                    out += [(ids[j], ids[i]) for j in new]
    return out


def _tied(percent: int):
    """Edges (a, b) that connect rows of the same key whose sketches allow a
    link, from rows (key, class, n, sketch) sorted by key."""
    def run(batches):
        key, rows = None, []

        def out(pairs):
            return pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64())],
                names=["a", "b"])

        def edges():
            if len(rows) < 2:
                return []
            ids, n, sketches = zip(*rows)
            return _alike(ids, np.array(n), sketches, percent)
        for b in batches:
            pairs = []
            for k, *row in zip(*(b.column(c).to_pylist() for c in ("key", "class", "n", "sketch"))):
                if k != key:
                    pairs += edges()
                    key, rows = k, []
                rows.append(row)
            yield out(pairs)
        yield out(edges())

    return run


def _candidates(lists: DataFrame, scan: DataFrame, percent: int) -> DataFrame:
    """Edges (a, b) whose components hold all links: ``lists`` has the rows of
    every n-gram (gram, part, n, class, pos, of), ``scan`` the sketches."""
    shared = saved(lists.repartition("gram", "part").sortWithinPartitions("gram", "part", "n", "class")
                   .mapInArrow(lean(_shared(percent)), "kind int, a long, b long").distinct(), "shared")
    keyed = (shared.where(F.col("kind") == PAIR)
             .select(F.xxhash64("a", "b").alias("key"), F.explode(F.array("a", "b")).alias("class"))
             .unionByName(shared.where(F.col("kind") == RUN)
                          .select(F.col("a").alias("key"), F.col("b").alias("class"))))
    sketches = scan.where("n > 0").groupBy("class").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    return (keyed.join(sketches, "class").select("key", "class", "n", "sketch")
            .repartition("key").sortWithinPartitions("key")
            .mapInArrow(lean(_tied(percent)), "a long, b long")
            .unionByName(shared.where(F.col("kind") == TIE).select("a", "b")))


def _sets(df: DataFrame, n: int, wanted: DataFrame) -> DataFrame:
    """(class, grams): whole n-gram sets of the wanted classes, one row each.
    A filter of fixed size tells which texts are worth sending; what it lets
    through by chance is dropped by the join that follows."""
    shared = df.sparkSession.sparkContext.broadcast(_marks(wanted, "class"))

    def run(batches):
        shingles, bits = Shingler(n), shared.value
        for b in byte_blocks(batches, 0, TEXTS):
            sets = [s for s in shingles(b.column(0)) if len(s)]
            ids = np.array([class_of(s) for s in sets], np.int64)
            keep = np.flatnonzero(_marked(bits, ids.view(np.uint64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[keep]), _lists([sets[i] for i in keep.tolist()])],
                names=["class", "grams"])

    rows = df.mapInArrow(lean(run), "class long, grams array<long>")
    return rows.groupBy("class").agg(F.first("grams").alias("grams"))


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections: the incidence matrix times its
    transpose, added up over ranges of n-grams.  N-grams of one row only are
    left out."""
    k = len(sets)
    row = np.repeat(np.arange(k), [len(s) for s in sets])
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, row = flat[order], row[order]
    new = np.ones(len(flat), bool)
    new[1:] = flat[1:] != flat[:-1]
    column = np.cumsum(new) - 1
    many = np.bincount(column) > 1
    number = np.cumsum(many) - 1
    keep = many[column]
    row, column = row[keep], number[column[keep]]
    out = np.zeros((k, k), np.float32)
    for lo in range(0, int(many.sum()), COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + COLUMNS])
        part = np.zeros((k, min(COLUMNS, int(column[b - 1]) - lo + 1)), np.float32)
        part[row[a:b], column[a:b] - lo] = 1
        out += part @ part.T
    return out


def spanning(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges (member, first member) of the components of a link matrix."""
    out, left = [], np.ones(len(linked), bool)
    for i in range(len(linked)):
        if not left[i]:
            continue
        left[i] = False
        front = np.array([i])
        while len(front):
            front = np.flatnonzero(linked[front].any(axis=0) & left)
            left[front] = False
            out += [(j, i) for j in front.tolist()]
    return out


def _product(percent: int):
    """Links (a, b) of the rows of every cell, as spanning edges, from rows
    sorted by (grp, cell) with their sets and known roots.  A cell whose rows
    are all connected already is skipped."""
    def links(rows):
        ids = np.array([r["class"] for r in rows], np.int64)
        if len(ids) < 2 or len({r["root"] for r in rows}) == 1:
            return []
        sets = [np.asarray(r["grams"]) for r in rows]
        n = np.array([len(s) for s in sets])
        both = overlaps(sets)
        ok = (100 + percent) * both.astype(np.int64) >= percent * (n[:, None] + n[None, :])
        np.fill_diagonal(ok, False)
        return [(ids[i], ids[j]) for i, j in spanning(ok)]

    def run(batches):
        key, rows = None, []

        def out(found):
            return pa.RecordBatch.from_arrays(
                [pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())],
                names=["a", "b"])
        for b in batches:
            cols = [b.column(k) for k in ("grp", "cell", "class", "root")]
            lists = b.column("grams")
            flat, ends = lists.values.to_numpy().view(np.uint64), lists.offsets.to_numpy()
            found = []
            for i, (g, cell, c, root) in enumerate(zip(*(x.to_pylist() for x in cols))):
                if (g, cell) != key:
                    found += links(rows)
                    key, rows = (g, cell), []
                rows.append({"class": c, "root": root, "grams": flat[ends[i]:ends[i + 1]].copy()})
            yield out(found)
        yield out(links(rows))

    return run


def _linked(rows: DataFrame, percent: int, name: str) -> DataFrame:
    """Links found in the cells of ``rows`` (grp, cell, class, root, grams)."""
    return saved(rows.select("grp", "cell", "class", "root", "grams")
                 .repartition("grp", "cell").sortWithinPartitions("grp", "cell")
                 .mapInArrow(lean(_product(percent)), "a long, b long"), name)


def _cells(rows: DataFrame, percent: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(first, rest, cut): the rows dealt out to the cells of the product, and
    the groups that are cut.

    ``rows`` holds (grp, class, n, grams).  A group of up to ``BLOCK`` rows and
    ``GRAMS`` n-grams is one cell.  A larger one is cut into bands of sizes — rows that can link lie
    in the same or in neighbouring bands — and bands into blocks by hash.  The
    first cells hold each block alone, and each with the first block of its
    band and of the next; the rest hold all other pairs of blocks."""
    sizes = rows.groupBy("grp").agg(F.count("*").alias("size"), F.sum("n").alias("weight"))
    sizes = saved(sizes, "sizes")
    rows = rows.join(sizes, "grp").where("size > 1")
    fits = (F.col("size") <= BLOCK) & (F.col("weight") <= GRAMS)
    small = rows.where(fits).withColumn("cell", F.lit(""))
    width = math.log(100 / percent) * (1 + 1e-9)
    large = (rows.where(~fits)
             .withColumn("band", F.floor(F.log(F.col("n").cast("double")) / F.lit(width)).cast("int")))
    bands = large.groupBy("grp", "band").agg(F.greatest(
        F.ceil(F.count("*") / F.lit(BLOCK // 2)),
        F.ceil(F.sum("n") / F.lit(GRAMS // 2))).cast("int").alias("blocks"))
    bands = saved(bands, "bands")
    near = bands
    for step, name in ((1, "above"), (-1, "below")):
        other = bands.select("grp", (F.col("band") - step).alias("band"), F.col("blocks").alias(name))
        near = near.join(other, ["grp", "band"], "left")
    large = large.join(saved(near, "bands"), ["grp", "band"]).withColumn(
        "block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    band, block = F.col("band"), F.col("block")

    def cell(b, x, c, y):
        return F.concat_ws("/", b.cast("string"), x.cast("string"), c.cast("string"), y.cast("string"))

    def upto(n):
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    own = F.transform(upto(F.col("blocks")),
                      lambda o: cell(band, F.least(o, block), band, F.greatest(o, block)))
    above = F.transform(upto(F.coalesce("above", F.lit(0))), lambda o: cell(band, block, band + 1, o))
    below = F.transform(upto(F.coalesce("below", F.lit(0))), lambda o: cell(band - 1, o, band, block))
    every = F.concat(own, above, below)
    # block 0 of a band with all, and every block alone: cells in proportion to the blocks
    first = F.filter(every, lambda c: (F.split_part(c, F.lit("/"), F.lit(2)) == "0")
                     | (c == cell(band, block, band, block)))
    names = [*small.columns]
    start = large.withColumn("cell", F.explode(first)).select(*names)
    rest = large.withColumn("cell", F.explode(F.array_except(every, first))).select(*names)
    return small.unionByName(start), rest, sizes.where(~fits).select("grp")


def _united(batches):
    """(node, root) from all edges of a graph of bounded size."""
    up: dict[int, int] = {}

    def find(x):
        while (y := up.setdefault(x, x)) != x:
            up[x] = x = up[y]
        return x
    for b in batches:
        for x, y in zip(b.column("a").to_pylist(), b.column("b").to_pylist()):
            x, y = find(x), find(y)
            up[max(x, y)] = min(x, y)
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(up), pa.int64()), pa.array([find(x) for x in up], pa.int64())], names=["node", "root"])


def components(links: DataFrame, name: str = "components") -> DataFrame:
    """(node, root) of every node of an undirected graph given by its edges
    (a, b): ``root`` is the smallest node of the connected component.

    A graph of up to ``GRAPH`` edges is left to one task.  For a larger one,
    alternates two contractions until nothing changes: every node ties its
    larger neighbours, then its smaller ones, to the smallest it knows.  Each
    step is a grouped minimum joined back; nothing is gathered per node, and
    every round is written to the shared folder.
    """
    def step(edges, larger):
        both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
        if larger:
            both = both.unionByName(both.select(F.col("v").alias("u"), F.col("u").alias("v")))
        else:
            both = both.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        both = both.distinct()
        least = saved(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), name)
        tied = both.join(least, "u")
        if larger:
            out = tied.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            out = tied.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(
                least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return saved(out.where("a <> b").distinct(), name)

    def state(edges):
        return edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()

    edges = saved(links.select("a", "b").where("a <> b").distinct(), name)
    if edges.count() <= GRAPH:
        return saved(edges.coalesce(1).mapInArrow(lean(_united), "node long, root long"), name)
    seen = None
    while (now := state(edges)) != seen and now[0]:
        seen = now
        edges = step(step(edges, True), False)
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return saved(edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
                 .unionByName(roots), name)


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", n: int = 4,
                    percent: int = 85) -> DataFrame:
    """Components of the documents whose n-gram sets have a Jaccard similarity
    of at least ``percent`` per cent: ``doc_id, n_shingles, component_id``.

    ``component_id`` is the smallest ``doc_id`` that is reachable by links,
    the document's own included.  Copies are linked; a document without words,
    or with a null text, is linked with nothing.  A null ``doc_id`` is kept
    and takes the smallest other id of its component, if there is one.
    Repeated rows come out as often as they occur; an empty table gives an
    empty result; other columns of ``df`` are not read.

    The result is exact but for collisions of the 64-bit hashes of words,
    n-grams and n-gram sets.
    """
    spark = df.sparkSession
    docs = df.select(F.col(text).alias("text"), F.col(doc_id).cast("long").alias("id"))
    scan = saved(_scan(docs, n), "classes")
    frequent = saved(_frequencies(docs.select("text"), n, percent), "frequent")
    # the longest lists are cut; any other is at most a CUT_LISTS-th of all rows
    long_lists = frequent.where(F.col("c") > LIST).orderBy(F.desc("c"), "gram").limit(CUT_LISTS).collect()
    grams = np.array([r.gram for r in long_lists], np.int64).view(np.uint64)
    order = np.argsort(grams)
    shared = spark.sparkContext.broadcast(
        (_marks(frequent, "gram"), grams[order],
         np.array([r.c for r in long_lists], np.int64)[order]))

    rows = (_prefixes(docs.select("text"), n, percent, shared).groupBy("class")
            .agg(*[F.first(c).alias(c) for c in ("n", "grams", "parts")]))
    lists = (rows.select("class", "n", "parts", F.posexplode("grams").alias("pos", "gram"))
             .withColumn("of", F.coalesce(F.get("parts", F.col("pos")), F.lit(1)))
             .withColumn("part", F.pmod(F.xxhash64("class"), F.col("of")).cast("int")))
    groups = components(_candidates(
        lists.select("gram", "part", "n", "class", "pos", "of"), scan, percent))

    wanted = groups.select(F.col("node").alias("class"), F.col("root").alias("grp"))
    sets = _sets(docs.select("text"), n, wanted)
    members = saved(sets.join(wanted, "class")
                    .select("grp", "class", F.size("grams").alias("n"), "grams"), "members")
    first, rest, cut = _cells(members, percent)
    links = _linked(first.withColumn("root", F.col("class")), percent, "links")
    roots = components(links)
    # groups that are not connected yet: the other cells
    placed = members.select("grp", "class").join(
        roots.select(F.col("node").alias("class"), "root"), "class", "left").select(
        "grp", "class", F.coalesce("root", "class").alias("root"))
    open_groups = (placed.groupBy("grp").agg(F.min("root").alias("x"), F.max("root").alias("y"))
                   .where("x <> y").select("grp"))
    open_groups = saved(open_groups.join(cut, "grp", "left_semi"), "open")
    if not open_groups.isEmpty():
        known = placed.join(open_groups, "grp", "left_semi").select("class", "root")
        more = _linked(rest.join(open_groups, "grp", "left_semi").join(known, "class"), percent, "links")
        roots = components(links.unionByName(more))

    # the smallest document id of every component
    classes = (scan.where("n > 0").groupBy("class").agg(F.min("id").alias("least")))
    named = saved(classes.join(roots, classes["class"] == roots["node"], "left")
                  .select("class", F.coalesce("root", "class").alias("root"), "least"), "named")
    smallest = saved(named.groupBy("root").agg(F.min("least").alias("component_id")), "smallest")
    final = saved(named.join(smallest, "root").select("class", "component_id"), "components")
    words = scan.select("id", "n", F.when(F.col("n") > 0, F.col("class")).alias("class"))
    linked = words.where("n > 0").join(final, "class").select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), "component_id")
    alone = words.where("n = 0").select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
                                        F.col("id").alias("component_id"))
    return linked.unionByName(alone)
