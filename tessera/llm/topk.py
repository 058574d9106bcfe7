"""Exact top-k search over integer vectors (operator 4).

Exhaustive term-at-a-time accumulation: candidates are held as postings per
dimension, every non-zero component of a query scatters its weight times the
postings into a dense score array, and partition selection keeps the k best
of a block.  Query and candidate blocks are bounded on both sides, so no task
holds a set that grows with the table; the k best of all blocks are merged.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 16384        # queries a task holds
CANDIDATE_BLOCK = 16384    # candidates a task holds
SCORE_ROWS = 64            # queries scored at once: SCORE_ROWS x CANDIDATE_BLOCK scores


#: Stands for a null id while scores are ranked: after every other id.
NO_ID = (1 << 63) - 1


def integer_vectors(df: DataFrame, vec_id: str, vector: str, scale: float = 256.0) -> DataFrame:
    """(vec_id, v): ``floor(scale * x)`` of every component, as bigint.  Null
    vectors, and vectors with a null or non-finite component, are left out.  A
    vector whose squares add up to 2^62 or more raises an error: the product of
    two others cannot leave the range of a bigint."""
    x = F.col(vector).cast("array<double>")
    finite = F.forall(x, lambda e: F.coalesce(
        ~F.isnan(e) & (F.abs(e) != F.lit(float("inf"))), F.lit(False)))
    norm = F.aggregate(x, F.lit(0.0), lambda s, e: s + F.pow(F.floor(e * F.lit(scale)).cast("double"), 2))
    whole = F.transform(x, lambda e: F.floor(e * F.lit(scale)))
    safe = F.when(norm < F.lit(2.0 ** 62), whole).otherwise(
        F.raise_error(F.lit("a vector is too long for whole scores")).cast("array<bigint>"))
    return (df.where(F.col(vector).isNotNull() & finite)
            .select(F.col(vec_id).cast("long").alias("vec_id"), safe.alias("v")))


def postings(rows: list) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per dimension the rows with a non-zero component, and the components.
    Shorter vectors are as if padded with zeros."""
    dims = max((len(r) for r in rows), default=0)
    m = np.zeros((len(rows), dims), np.int64)
    for i, r in enumerate(rows):
        m[i, :len(r)] = r
    return [(at := np.flatnonzero(m[:, d]), m[at, d]) for d in range(dims)]


def scores(query_postings, n_queries: int, terms, n: int) -> np.ndarray:
    """Dense score arrays (a row per query), one term after the other."""
    s = np.zeros((n_queries, n), np.int64)
    for (rows, weights), (at, values) in zip(query_postings, terms):
        if len(rows) == n_queries and len(at) == n:         # a full term needs no scatter
            s += weights[:, None] * values[None, :]
        elif len(rows) and len(at):
            s[np.ix_(rows, at)] += weights[:, None] * values[None, :]
    return s


def select(row: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best scores, ties to the smaller id, best first."""
    if len(row) > k:
        kth = np.partition(row, len(row) - k)[len(row) - k]
        sure = np.flatnonzero(row > kth)
        tied = np.flatnonzero(row == kth)
        if len(tied) > (need := k - len(sure)):
            tied = tied[np.argpartition(ids[tied], need - 1)[:need]] if need else tied[:0]
        at = np.concatenate([sure, tied])
    else:
        at = np.arange(len(row))
    return at[np.lexsort((ids[at], -row[at]))]


def top_k(df: DataFrame, is_query, vec_id: str = "vec_id", vector: str = "embedding",
          k: int = 5, scale: float = 256.0) -> DataFrame:
    """The k highest integer inner products of every query row.

    ``is_query`` is a Boolean column over ``vec_id``.  Returns ``query_id,
    rank, vec_id, score``; ties go to the smaller ``vec_id``; a query with
    fewer candidates gets them all.  Rows that share the query's ``vec_id``
    are its own and no candidates.  Vectors that are null or hold a null or
    non-finite component take no part; an empty vector scores 0 everywhere;
    components beyond a shorter vector's end count as zero.  A repeated row
    (same id, same vector) is one query and one candidate; rows with one id and
    different vectors are separate queries, each with its own ranks, and
    separate candidates.  A row without an id is a candidate, last among ties,
    but no query.  Vectors too long for bigint scores raise an error; an empty
    table gives an empty one.
    """
    vecs = integer_vectors(df.select(F.col(vec_id).alias("vec_id"),
                                     F.col(vector).alias("embedding")),
                           "vec_id", "embedding", scale)
    vecs = (vecs.select(F.coalesce("vec_id", F.lit(NO_ID)).alias("vec_id"), "v").distinct()
            .withColumn("n", F.xxhash64("vec_id", "v")))
    named = F.col("vec_id") != NO_ID
    asks = named & is_query(F.col("vec_id"))
    query = vecs.where(asks)
    # two numbers reach the driver: how many blocks either side needs
    total, n_queries = vecs.agg(F.count("*"), F.count(F.when(asks, 1))).first()
    cand_blocks = max(1, -(-total // CANDIDATE_BLOCK))
    query_blocks = max(1, -(-n_queries // QUERY_BLOCK))

    def block(n):
        return F.pmod(F.xxhash64("n"), F.lit(n)).cast("int")

    def every(n):
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = query.select("vec_id", "n", "v", block(query_blocks).alias("qb"),
                        every(cand_blocks).alias("cb"))
    right = vecs.select("vec_id", "v", block(cand_blocks).alias("cb"),
                        every(query_blocks).alias("qb"))

    def search(qs: pd.DataFrame, cs: pd.DataFrame) -> pd.DataFrame:
        out = [[], [], [], []]
        number = qs["n"].to_numpy(np.int64)
        ids = cs["vec_id"].to_numpy(np.int64)
        qid = qs["vec_id"].to_numpy(np.int64)
        terms, vectors = postings(list(cs["v"])), list(qs["v"])
        for lo in range(0, len(qid) if len(ids) else 0, SCORE_ROWS):
            own = qid[lo:lo + SCORE_ROWS]
            s = scores(postings(vectors[lo:lo + SCORE_ROWS]), len(own), terms, len(ids))
            for q, one, row in zip(own, number[lo:lo + SCORE_ROWS], s):
                others = np.flatnonzero(ids != q)
                at = others[select(row[others], ids[others], k)]
                out[0].append(np.full(len(at), q))
                out[1].append(ids[at])
                out[2].append(row[at])
                out[3].append(np.full(len(at), one))
        names = ("query_id", "vec_id", "score", "n")
        if not out[0]:
            return pd.DataFrame({c: [] for c in names}).astype("int64")
        return pd.DataFrame({c: np.concatenate(v) for c, v in zip(names, out)})

    parts = (left.groupBy("qb", "cb").cogroup(right.groupBy("qb", "cb"))
             .applyInPandas(search, "query_id long, vec_id long, score long, n long"))
    best = Window.partitionBy("query_id", "n").orderBy(F.desc("score"), "vec_id")
    return (parts.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", F.nullif("vec_id", F.lit(NO_ID)).alias("vec_id"), "score"))
