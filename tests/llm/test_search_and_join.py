"""MaxScore, n-gram join, components."""

from __future__ import annotations

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from isobar.llm import maxscore, ngram_join
from isobar.llm.components import connected

VECTORS = "vec_id long, embedding array<float>, label int"


def brute(vectors, k):
    terms = {}
    for i, v in vectors:
        terms.setdefault(i, []).append([math.floor(256 * float(np.float32(x))) for x in v])
    for q in terms:
        best = lambda v: max(sum(a * b for a, b in zip(x, y)) for x in terms[q] for y in terms[v])
        scores = sorted((-best(v), v) for v in terms if v != q)[:k]
        for rank, (s, v) in enumerate(scores, 1):
            yield q, rank, v, -s


@pytest.mark.parametrize("kind", ["dense", "sparse", "ties"])
def test_top_k_is_exact(spark, monkeypatch, kind):
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 40)
    monkeypatch.setattr(maxscore, "QUERY_ROWS", 30)
    monkeypatch.setattr(maxscore, "CHUNK", 16)
    rng = random.Random(kind)
    value = {"dense": lambda: rng.gauss(0, 0.2), "sparse": lambda: rng.random() if rng.random() < 0.1 else 0.0,
             "ties": lambda: float(rng.randrange(2))}[kind]
    vectors = [(i * 3, [value() for _ in range(12)]) for i in range(150)]
    df = maxscore.quantised(spark.createDataFrame([(*v, None) for v in vectors], VECTORS))
    assert sorted(tuple(r) for r in maxscore.top_k(df, df, 5).collect()) == sorted(brute(vectors, 5))


@pytest.mark.parametrize("negative", [False, True])
def test_top_k_of_ids_with_several_vectors(spark, monkeypatch, negative):
    """One id holds a third of all vectors, others two each, and every row comes twice."""
    monkeypatch.setattr(maxscore, "SHARD_ROWS", 40)
    monkeypatch.setattr(maxscore, "QUERY_ROWS", 30)
    monkeypatch.setattr(maxscore, "CHUNK", 16)
    rng = random.Random(5)
    vectors = [(7 if i % 3 == 0 else i // 2, [rng.gauss(-0.3 if negative else 0, 0.2) for _ in range(6)]) for i in range(120)]
    df = maxscore.quantised(spark.createDataFrame([(*v, None) for v in vectors * 2], VECTORS))
    assert sorted(tuple(r) for r in maxscore.top_k(df, df, 5).collect()) == sorted(brute(vectors, 5))


def test_top_k_odd_rows(spark):
    rows = [(0, [1.0, 2.0]), (1, None), (2, [1.0, None]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (None, [1.0, 1.0]),
            (5, [1.0]), (6, []), (7, [1.0, 2.0]), (7, [1.0, 2.0]), (8, [-1.0, 0.5])]
    df = spark.createDataFrame([(*r, None) for r in rows], VECTORS).withColumn("terms", F.lit("mine"))
    vectors = maxscore.quantised(df)
    found = [tuple(r) for r in maxscore.top_k(vectors, vectors.where("vec_id = 0"), 9).orderBy("rank").collect()]
    assert found == [(0, 1, 7, 5 * 65536), (0, 2, 5, 65536), (0, 3, 6, 0), (0, 4, 8, 0)]
    assert maxscore.top_k(vectors.limit(0), vectors.limit(0)).count() == 0
    large = [(1, [300.0, -7e4]), (2, [1e5, 1.0]), (3, [2.0**24, -1.0]), (4, [0.25, 2.0**21]), (5, [-1.0, 2.0**20])]
    vectors = maxscore.quantised(spark.createDataFrame([(*r, None) for r in large], VECTORS))
    assert sorted(tuple(r) for r in maxscore.top_k(vectors, vectors, 3).collect()) == sorted(brute(large, 3))
    beyond = maxscore.quantised(spark.createDataFrame([(1, [2.0**40], None), (2, [2.0**40], None)], VECTORS))
    with pytest.raises(Exception, match="int too (big|large)|Overflow"):
        maxscore.top_k(beyond, beyond, 3).collect()
    huge = maxscore.quantised(spark.createDataFrame([(1, [1e30], None)], VECTORS))
    with pytest.raises(Exception, match="too large"):
        huge.collect()


def sets(text, n=5):
    w = (text or "").lower().split()
    return {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if w else set()


def brute_join(rows):
    texts = {}
    for i, t in rows:
        texts.setdefault(t or "", []).append(i)
    keys = sorted(texts)
    links, root = {k: 0 for k in keys}, {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a, b in itertools.combinations(keys, 2):
        x, y = sets(a), sets(b)
        if x and y and len(x & y) >= 0.8 * len(x | y) - 1e-9:
            links[a] += 1
            links[b] += 1
            root[find(a)] = find(b)
    least = {}
    for k in keys:
        least[find(k)] = min(least.get(find(k), texts[k][0]), *texts[k])
    return {(i, least[find(k)], links[k], len(ids)) for k, ids in texts.items() for i in ids}


def near_copies(seed, groups=6, size=25):
    rng = random.Random(seed)
    out, number = [], 0
    for g in range(groups):
        base = [f"w{rng.randrange(500)}" for _ in range(rng.choice([4, 30, 90, 200]))]
        for _ in range(size):
            words = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 4])):
                words[rng.randrange(len(words))] = f"n{rng.randrange(500)}"
            out.append((number, " ".join(words)))
            number += 1
    return out


@pytest.mark.parametrize("block", [256, 8])
def test_join_equals_brute_force(documents, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK", block)
    rows = near_copies(11)
    assert {tuple(r) for r in ngram_join.join(documents(*rows)).collect()} == brute_join(rows)


def test_one_of_each_class_stays(documents):
    rows = near_copies(12, groups=4, size=10) + [(900, "too short"), (901, "too short"), (902, ""), (903, None)]
    kept = {r.doc_id for r in ngram_join.keep_one(documents(*rows)).collect()}
    expected = {c for _, c, _, _ in brute_join(rows) if c < 902} | {902, 903}
    assert kept == expected


def test_join_odd_rows(odd):
    found = [tuple(r) for r in ngram_join.join(odd.withColumn("digest", F.lit(1)).withColumn("links", F.lit(1))).collect()]
    assert len(found) == 10 and (3, 3, 0, 2) in found and found.count((3, 3, 0, 2)) == 2
    assert len(ngram_join.keep_one(odd).collect()) == 9  # of the repeated row one stays
    assert ngram_join.join(odd.limit(0)).count() == 0 and ngram_join.keep_one(odd.limit(0)).count() == 0


def test_banding_meets_the_recall():
    for threshold, recall in ((0.8, 0.999), (0.5, 0.95), (1.0, 0.9)):
        bands, rows = ngram_join.banding(threshold, recall)
        assert 1 - (1 - threshold**rows) ** bands >= recall and bands * rows <= ngram_join.HASHES


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 101), (101, 102), (102, 100), (200, 200), (100, 101)]
    found = {tuple(r) for r in connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {(i, 0) for i in range(41)} | {(i, 100) for i in (100, 101, 102)}
    assert connected(spark.createDataFrame([], "a long, b long")).count() == 0


@pytest.mark.parametrize("probes", [0, 3, 10**9])
@pytest.mark.parametrize("kind", [float, "int64", object])
def test_a_block_of_queries_is_searched_together(monkeypatch, probes, kind):
    """Traversal and probes of a chunk take one product each, however many queries the block holds."""
    monkeypatch.setattr(maxscore, "PROBES", probes)
    monkeypatch.setattr(maxscore, "CHUNK", 16)
    rng = np.random.default_rng(5)
    vectors, queries = rng.integers(-9, 10, (200, 6)), rng.integers(-9, 10, (30, 6))
    ids, asked = np.arange(0, 400, 2), np.arange(30) * 3
    postings = np.ascontiguousarray(vectors.T).astype(kind)
    found = maxscore.search_shard(ids, postings, asked, queries.astype(kind), postings.min(axis=1), postings.max(axis=1), 4)
    expected = [(q, int(ids[j]), int(s)) for q, w in zip(asked.tolist(), queries)
                for s, j in sorted(((s, j) for j, s in enumerate(vectors @ w) if ids[j] != q), key=lambda x: (-x[0], x[1]))[:4]]
    assert [(q, v, int(s)) for q, v, s in found] == expected
