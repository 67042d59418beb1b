"""Exact top-k by inner product with MaxScore.

A dimension is a term, its posting list the component of every vector of a shard. For a
query, a term's bound is the most that it can add to a score in the shard. Terms are split
by these bounds: the non-essential ones together cannot lift a vector over the k-th best
score so far, so postings of essential terms are traversed first and the others are probed,
strongest first, only for vectors that may still compete. Shard results are merged by query.

Vectors are packed into blocks of fixed size, as are queries; a block of vectors is a shard and is
shuffled once, the blocks of queries go to every shard. No side is broadcast or collected.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

SHARD_ROWS = 8192
QUERY_ROWS = 512
CHUNK = 1024
PROBES = 16  # competing vectors of a chunk from which on a query's other terms are one product
RESULT = "query_id long, vec_id long, score long"


def quantised(df: DataFrame, scale: int = 256) -> DataFrame:
    """vec_id and ``terms``: floor(scale * component) as longs, one row for each different pair of them.

    Rows with a null vec_id, a null vector, or a null, NaN or infinite component take no part.
    Rows that come again count once; different vectors of one vec_id all take part. Scaled components
    that don't fit in a long are refused while running, as are scores that don't.
    """
    x = F.transform("embedding", lambda v: v.cast("double"))
    bad = lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    valid = F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & ~F.exists("x", bad)
    checked = lambda v: F.when(F.abs(v * scale) < 2.0**62, F.floor(v * scale).cast("long")).otherwise(
        F.raise_error(F.lit("component too large")).cast("long"))
    return (
        df.select("vec_id", "embedding", x.alias("x")).where(valid)
        .select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("x", checked).alias("terms")).distinct()
    )


def _packed(df: DataFrame, block: Column, name: str) -> DataFrame:
    """One row for each block: its ids in ascending order and their terms."""
    rows = F.sort_array(F.collect_list(F.struct("vec_id", "terms")))  # as many as a block holds
    return df.groupBy(block.alias(name)).agg(rows.alias("rows")).select(
        name, F.col("rows.vec_id").alias(f"{name}_ids"), F.col("rows.terms").alias(f"{name}_terms"))


def _matrix(terms, dims: int) -> np.ndarray:
    """Vectors as rows; missing components count as 0."""
    out = np.zeros((len(terms), dims), dtype=np.int64)
    for i, t in enumerate(terms):
        out[i, : len(t)] = t
    return out


def _bounds(queries: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The most and the least that each term adds to a query's score in the shard."""
    at_low, at_high = queries * low, queries * high
    return np.maximum(at_low, at_high), np.minimum(at_low, at_high)


def search_shard(ids: np.ndarray, postings: np.ndarray, query_ids: np.ndarray, queries: np.ndarray,
                 low: np.ndarray, high: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """(query_id, vec_id, score) of the k best of a shard with ascending ids for each query, one for each id.

    ``postings`` has a row for each term. Queries go through a chunk of vectors together: their essential
    terms are traversed as one product, then the others are probed for the pairs that may still compete.
    """
    repeated = bool((ids[1:] == ids[:-1]).any())
    most, least = _bounds(queries, low, high)
    spread = most - least
    order = np.argsort(-spread, axis=1, kind="stable")  # widest range first
    in_order = lambda m: np.take_along_axis(m, order, 1)
    none = np.zeros((len(queries), 1), most.dtype)
    left = np.concatenate([np.cumsum(in_order(most)[:, ::-1], axis=1)[:, ::-1], none], axis=1)  # most that the terms from i on add
    floor_ = left[:, :1] - np.concatenate([none, np.cumsum(in_order(spread), axis=1)], axis=1)  # most with the first i terms lowest
    place = np.argsort(order, axis=1)  # of a term in its query's order
    best: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, postings.dtype), np.empty(0, np.int64))] * len(queries)
    for start in range(0, len(ids), CHUNK):
        chunk, here = postings[:, start:start + CHUNK], ids[start:start + CHUNK]
        full = np.array([len(scores) == k for scores, _ in best], bool)
        need = np.array([scores[-1] if len(scores) == k else 0 for scores, _ in best], postings.dtype)
        # Essential: with all of these terms at their bounds, the rest falls short of what is needed.
        short = full[:, None] & (floor_ <= need[:, None])
        essential = np.where(short.any(axis=1), short.argmax(axis=1), queries.shape[1])
        traversed = place < essential[:, None]
        scores = np.where(traversed, queries, 0) @ chunk
        rest = np.take_along_axis(left, essential[:, None], 1)
        may = (here[None, :] != query_ids[:, None]) & (~full[:, None] | (scores + rest > need[:, None]))
        # Queries that many vectors still compete for are probed with all their other terms in one product.
        probed = full & (essential < queries.shape[1]) & (may.sum(axis=1) > PROBES)
        scores[probed] += np.where(traversed[probed], 0, queries[probed]) @ chunk
        may[probed] &= scores[probed] > need[probed, None]
        for i in np.flatnonzero(may.any(axis=1)):
            rows = np.flatnonzero(may[i])
            found = scores[i, rows]
            for j, term in enumerate([] if probed[i] else order[i, essential[i]:], essential[i]):
                keep = found + left[i, j] > need[i]
                rows, found = rows[keep], found[keep]
                if not len(rows):
                    break
                if queries[i, term]:
                    found = found + queries[i, term] * chunk[term, rows]
            if len(rows):
                best[i] = _best(np.concatenate([best[i][0], found]), np.concatenate([best[i][1], here[rows]]), k, repeated)
    return [(q, v, s) for q, (scores, found) in zip(query_ids.tolist(), best) for s, v in zip(scores.tolist(), found.tolist())]


def _best(scores: np.ndarray, found: np.ndarray, k: int, repeated: bool) -> tuple[np.ndarray, np.ndarray]:
    """The k best scores and their ids, ties to the smaller id."""
    exact = scores.dtype == object  # beyond a long on the way
    if not exact and not repeated and len(scores) > 4 * k:  # what is below the k-th best takes no part in the sort
        competing = scores >= np.partition(scores, len(scores) - k)[len(scores) - k]
        scores, found = scores[competing], found[competing]
    top = np.array(sorted(range(len(found)), key=lambda j: (-scores[j], found[j])), int) if exact else np.lexsort((found, -scores))
    if repeated:  # only the best vector of an id
        top = top[np.sort(np.unique(found[top], return_index=True)[1])]
    return scores[top[:k]], found[top[:k]]


def _search(batches: Iterator[pd.DataFrame], k: int) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for ids, terms, query_ids, queries in zip(batch["shard_ids"], batch["shard_terms"], batch["query_ids"], batch["query_terms"]):
            dims = max((len(t) for part in (terms, queries) for t in part), default=0)
            postings, wanted = np.ascontiguousarray(_matrix(terms, dims).T), _matrix(queries, dims)
            reach = lambda m, axis: np.abs(m.astype(float)).max(axis=axis, initial=0)
            most = (reach(postings, 1) * reach(wanted, 0)).sum()
            if most > 2**60:  # sums might not fit: count in whole numbers of any size
                postings, wanted = postings.astype(object), wanted.astype(object)
            elif most < 2**50:  # doubles hold all of these sums exactly, and multiply faster
                postings, wanted = postings.astype(float), wanted.astype(float)
            low = postings.min(axis=1, initial=2**62) if dims else np.empty(0, np.int64)
            high = postings.max(axis=1, initial=-(2**62)) if dims else np.empty(0, np.int64)
            found = search_shard(np.asarray(ids), postings, np.asarray(query_ids), wanted, low, high, k)
            yield pd.DataFrame(found, columns=["query_id", "vec_id", "score"]).astype("int64")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k best vectors other than itself; ties to the smaller vec_id.

    Both frames hold vec_id and terms, as ``quantised`` gives them. A vector may be shorter than
    others: what it lacks counts as 0. Where an id has several vectors, as a query or a candidate, the
    best of their scores is the pair's. Queries with fewer others get all; empty frames give no rows.
    """
    shards = -(-vectors.count() // SHARD_ROWS)
    blocks = -(-queries.count() // QUERY_ROWS)
    of = lambda n: F.pmod(F.xxhash64("vec_id", "terms"), F.lit(max(n, 1)))  # vectors of one id lie apart
    shard = _packed(vectors, of(shards), "shard")
    query = _packed(queries, of(blocks), "query").withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(max(shards, 1) - 1))))
    pairs = shard.join(query.hint("merge"), "shard").select(
        "shard_ids", "shard_terms", "query_ids", "query_terms")
    found = pairs.mapInPandas(lambda batches: _search(batches, k), RESULT).repartition("query_id")
    found = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score")
