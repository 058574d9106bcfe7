"""Mixing sources to target weights (operator 12).

Multivariate-hypergeometric splitting tree.  The documents of a source, in the
order of a hash, form a line of words that is read as often as the target
asks; the line is cut into blocks, and a source has an exact quota of blocks.
The tree deals the quotas out: a node that stands for several output shards
draws, without replacement, how many blocks of every source go to its left
half, and the rest goes right, so the leaves' quotas add up to the sources'.
A shard then takes its share of every source's permuted blocks, and shuffles
the pieces of documents in them locally.

Only (number, source, size) of a document travels.  A source that holds a
third of all rows is cut into hash pieces before its running sum, and into
blocks afterwards; no task holds a source.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WS_CLASS, saved

BLOCK = 8192               # words of a block
SHARD_BLOCKS = 512         # blocks of an output shard
PIECE_ROWS = 8192          # documents whose running sum one task piece takes, about
FANOUT = 256               # shards that one task of the tree splits a node into
MOST_BLOCKS = 500_000_000  # blocks are made larger beyond: a bound of the draws


def word_count(text: str) -> Column:
    """Words of a text (maximal runs without blank, tab and line breaks), 0
    for null."""
    return F.coalesce(F.regexp_count(F.col(f"`{text}`"), F.lit(WS_CLASS.replace("[", "[^", 1))),
                      F.lit(0)).cast("long")


def with_targets(sources: DataFrame, weights=(3, 1, 2), share: float = 1.5,
                 most: int = 2) -> DataFrame:
    """``sources`` (index, source_size) with ``target``: ``share`` times all
    sizes divided by weight (by ``index``, repeating), none above ``most``
    times its source's size, the excess reshared by weight until none is.

    Every round is one aggregate over the sources; three numbers reach the
    driver.  A round caps at least one more source, or is the last."""
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]),
                     (F.col("index") % len(weights) + 1).cast("int"))
    cap = F.col("source_size").cast("double") * most
    total = share * (sources.agg(F.sum("source_size")).first()[0] or 0)
    above, n_above, level = F.lit(False), 0, 0.0
    while True:
        fixed, weight, n = sources.agg(
            F.sum(F.when(above, cap).otherwise(0.0)), F.sum(F.when(~above, w)),
            F.count_if(above)).first()
        if not weight:                                  # no source, or all at their cap
            above = F.lit(True)
            break
        if level and n == n_above:
            break
        level, n_above = (total - fixed) / weight, n
        if not level:
            break
        above = F.lit(level) * w > cap
    return sources.withColumn("target", F.when(above, cap).otherwise(F.lit(level) * w))


def split(pdf: pd.DataFrame, total: int, shards: int, stop: int, seed: int) -> pd.DataFrame:
    """One node of the tree, split down to nodes of at most ``stop`` shards.

    Rows: ``node`` (its first shard), ``shards``, ``index`` (of the source),
    ``all`` (the source's blocks), ``first`` and ``blocks`` (its part of
    them).  Shard ``j`` of ``shards`` holds the blocks from
    ``j * total / shards`` up to the next one's, rounded down."""
    pdf = pdf.sort_values("index")
    index, every = pdf["index"].to_numpy(), pdf["all"].to_numpy()
    stack = [(int(pdf["node"].iloc[0]), int(pdf["shards"].iloc[0]), pdf["first"].to_numpy(),
              pdf["blocks"].to_numpy())]
    out = []
    while stack:
        at, n, first, blocks = stack.pop()
        if n <= stop:
            some = np.flatnonzero(blocks)
            out.append(pd.DataFrame({"node": at, "shards": n, "index": index[some],
                                     "all": every[some], "first": first[some],
                                     "blocks": blocks[some]}))
            continue
        half = n // 2
        room = (at + half) * total // shards - at * total // shards
        rng = np.random.default_rng([seed, at, n])
        left = rng.multivariate_hypergeometric(blocks, room, method="marginals")
        stack.append((at, half, first, left))
        stack.append((at + half, n - half, first + left, blocks - left))
    return pd.concat(out, ignore_index=True)


def stride(n: int, index: int, seed: int) -> int:
    """A step through ``n`` blocks that meets each once: without a common
    divisor with ``n``, near the golden section."""
    step = max(1, int(n * 0.6180339887) + (index * 7 + seed) % 5)
    while math.gcd(step, n) != 1:
        step += 1
    return step


def deal(sources: DataFrame, total: int, shards: int, seed: int) -> DataFrame:
    """(index, block, shard) of every block of every source.

    ``sources`` has ``index`` and ``all``.  The tree runs in phases; in a
    phase every node is a task that splits its shards into at most ``FANOUT``
    nodes.  A node holds one row per source with blocks in it."""
    schema = "node long, shards long, `index` long, `all` long, `first` long, blocks long"
    nodes = sources.where("`all` > 0").select(
        F.lit(0).cast("long").alias("node"), F.lit(shards).cast("long").alias("shards"),
        F.col("index").cast("long").alias("index"), "all",
        F.lit(0).cast("long").alias("first"), F.col("all").alias("blocks"))

    def down_to(stop: int):
        def phase(pdf: pd.DataFrame) -> pd.DataFrame:
            return split(pdf, total, shards, stop, seed)
        return phase
    stop = shards
    while stop > 1:
        stop = -(-stop // FANOUT)
        nodes = nodes.groupBy("node").applyInPandas(down_to(stop), schema)

    def strides(batches):
        for pdf in batches:
            pdf["step"] = [stride(int(n), int(i), seed) for n, i in zip(pdf["all"], pdf["index"])]
            yield pdf
    steps = nodes.mapInPandas(strides, schema + ", step long")
    rank = F.explode(F.sequence("first", F.col("first") + F.col("blocks") - 1))
    return (steps.select("index", "all", "step", F.col("node").alias("shard"), rank.alias("rank"))
            .select("index", ((F.col("rank") * F.col("step")) % F.col("all")).alias("block"), "shard"))


def mix(df: DataFrame, size: str = "size", source: str = "source", key: str = "doc_id",
        keep=("doc_id",), weights=(3, 1, 2), share: float = 1.5, most: int = 2,
        block: int = BLOCK, shard_blocks: int = SHARD_BLOCKS, seed: int = 0):
    """Mix the rows of ``df`` so that every source contributes its target.

    Returns two tables that share the number ``_row``.  ``docs``: one row per
    row of ``df`` with ``keep``, ``size``, ``source_size`` and ``target`` (words
    of its source, see ``with_targets``; sources weigh ``weights`` in code
    point order, null last).  ``pieces``: what the mix takes, with ``pass``
    (0 to ``most`` - 1), ``start`` and ``length`` (words of the document),
    ``block``, ``shard`` and ``place`` (from 0, the shard's shuffled order).  A
    source's pieces add up to its target, rounded to a word; a row is taken at
    most ``most`` times its size.  Reruns give the same pieces.

    Null sources form one source.  A null key counts as the text ``null``;
    rows that share a key are told apart by their size, then by number.  A
    null or negative size counts as 0: such rows are in ``docs`` only, and a
    source without words has target 0.  An empty table gives empty tables.
    Other columns are not looked at, so names cannot clash with them.

    The source table (one row per source) is numbered in one task, and a node
    of the tree holds one row per source; nothing else is held whole.
    """
    n = F.greatest(F.coalesce(F.col(f"`{size}`"), F.lit(0)), F.lit(0)).cast("long")
    rows = saved(df.select(
        F.monotonically_increasing_id().alias("_row"), *[F.col(f"`{c}`") for c in keep],
        F.col(f"`{source}`").alias("_source"), n.alias("size"),
        F.md5(F.concat_ws(":", F.lit(f"mix{seed}"), F.coalesce(
            F.col(f"`{key}`").cast("string"), F.lit("null")))).alias("_key")), "mix_rows")
    by_name = Window.orderBy(F.col("_source").asc_nulls_last())
    sources = saved(rows.groupBy("_source").agg(
        F.sum("size").alias("source_size"), F.count("*").alias("docs"))
        .withColumn("index", F.row_number().over(by_name) - 1), "mix_sources")
    sources = with_targets(sources, weights, share, most)
    words = F.least(F.floor(F.col("target") + 0.5), F.col("source_size") * most).cast("long")
    sources = saved(sources.withColumn("words", words), "mix_targets")
    wanted = sources.agg(F.sum("words")).first()[0] or 0
    block = max(block, -(-wanted // MOST_BLOCKS))
    sources = sources.withColumn("all", F.ceil(F.col("words") / F.lit(block)).cast("long"))
    total = sources.agg(F.sum("all")).first()[0] or 0

    # where every document starts in its source's line of words
    named = rows.join(sources.withColumnRenamed("_source", "_name"),
                      F.col("_source").eqNullSafe(F.col("_name")))
    parts = F.ceil(F.col("docs") / F.lit(PIECE_ROWS))
    part = F.floor(F.conv(F.substring("_key", 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)
                   * parts).cast("long")
    named = named.withColumn("_part", part)
    sums = named.groupBy("index", "_part").agg(F.sum("size").alias("_sum"))
    before = Window.partitionBy("index").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("index", "_part", F.coalesce(F.sum("_sum").over(before), F.lit(0))
                          .alias("_offset"))
    inside = (Window.partitionBy("index", "_part").orderBy("_key", "size", "_row")
              .rowsBetween(Window.unboundedPreceding, -1))
    placed = (named.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
              .join(offsets, ["index", "_part"])
              .withColumn("_at", F.col("_offset") + F.col("_in")))

    # the words taken, cut at the blocks
    taken = (placed.where("size > 0")
             .select("_row", "_key", "index", "size", "source_size", "words", "_at",
                     F.explode(F.sequence(F.lit(0), F.lit(most - 1))).alias("pass"))
             .withColumn("_from", F.col("pass") * F.col("source_size") + F.col("_at"))
             .withColumn("_to", F.least(F.col("_from") + F.col("size"), F.col("words")))
             .where("_from < _to"))
    cut = (taken.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("_from") / block), F.floor((F.col("_to") - 1) / block))))
        .withColumn("_lo", F.greatest("_from", F.col("block") * block))
        .withColumn("_hi", F.least("_to", (F.col("block") + 1) * block)))
    shards = max(1, -(-total // shard_blocks))
    dealt = saved(deal(sources, total, shards, seed), "mix_blocks")
    shuffled = Window.partitionBy("shard").orderBy(
        F.xxhash64(F.lit(seed), "_key", "size", "pass", "start"), "_key", "size", "pass", "start",
        "_row")
    pieces = (cut.join(dealt, ["index", "block"])
              .select("_row", "_key", "size", "pass", (F.col("_lo") - F.col("_from")).alias("start"),
                      (F.col("_hi") - F.col("_lo")).alias("length"), "block", "shard")
              .withColumn("place", F.row_number().over(shuffled) - 1)
              .drop("_key", "size"))
    docs = named.select("_row", *[F.col(f"`{c}`") for c in keep if c != "size"], "size",
                        "source_size", "target")
    return docs, pieces


def mixed_texts(docs: DataFrame, pieces: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: ``shard``, ``place`` and ``text``, the words of every
    piece joined by one blank.  ``docs`` carries the text among its ``keep``
    columns."""
    words = F.filter(F.split(F.col(f"`{text}`"), WS_CLASS), lambda w: w != "")
    return (pieces.join(docs.select("_row", f"`{text}`"), "_row")
            .select("shard", "place", F.array_join(
                F.slice(words, (F.col("start") + 1).cast("int"), F.col("length").cast("int")), " ")
                .alias("text")))
