"""Sequential computations over arrays, without leaving the row: states that
depend on their neighbours need no exploded tokens and no window."""

from __future__ import annotations

import zlib

from pyspark.sql import Column
from pyspark.sql import functions as F



def pieces(items: Column) -> Column:
    """An array cut into about as many arrays as each of them has items.  An
    ``aggregate`` copies what it has built at every step; with pieces a text
    of n items costs n * sqrt(n) small copies instead of n * n."""
    size = F.ceil(F.sqrt(F.size(items))).cast("int")
    starts = F.sequence(F.lit(1), F.size(items), size)
    return F.when(F.size(items) > 0, F.transform(starts, lambda i: F.slice(items, i, size))) \
        .otherwise(F.array(F.slice(items, F.lit(1), F.lit(0))))


def scan(items: Column, zero: Column, step) -> Column:
    """The states ``s1 = step(zero, items[0])``, ``s2 = step(s1, items[1])``, …
    as an array as long as ``items``.  ``items`` should be a plain column, as
    it is read more than once, and states small, as they are copied."""
    def run(state, piece):
        states = F.aggregate(piece, F.array(state),
                             lambda a, x: F.concat(a, F.array(step(F.element_at(a, -1), x))))
        return F.slice(states, F.lit(2), F.size(piece))

    chained = F.aggregate(
        pieces(items), F.array(F.array(zero)),
        lambda done, p: F.when(F.size(p) > 0, F.concat(done, F.array(
            run(F.element_at(F.element_at(done, -1), -1), p)))).otherwise(done))
    return F.flatten(F.slice(chained, F.lit(2), F.lit(1 << 30)))


def dictionary(values: dict, of, buckets: int | None = None):
    """A fixed mapping as a function of a text column: its value, or null.

    The entries lie in buckets by the key's crc32, so a lookup reads one short
    map however long the mapping is.  ``of`` turns a value into a column."""
    n = buckets or max(1, len(values) // 2)
    rows: list[list] = [[] for _ in range(n)]
    for k, v in values.items():
        rows[zlib.crc32(k.encode()) % n] += [F.lit(k), of(v)]
    some = of(next(iter(values.values())))
    table = F.array(*[F.create_map(*(r or [F.lit("\x00"), some])) for r in rows])

    def lookup(key: Column) -> Column:
        return F.get(table, (F.crc32(key) % n).cast("int"))[key]
    return lookup
