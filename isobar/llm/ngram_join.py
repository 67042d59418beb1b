"""Jaccard self-join of documents on word n-grams: MinHash bands for candidates, full n-gram sets for the decision.

Equal texts are one class from the start. Band hashes of the distinct texts are shuffled; texts
that share one form candidate groups (components of "shares a band with the least text of that
band", so no pairs are emitted). Each group's n-gram sets are compared whole: in one task if it is
small, else in pairs of fixed-size blocks, each block pair being one row of work. What comes out
of a comparison is linear: for each text the number of its links, and one edge towards the least
text that it is connected to.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from isobar.llm.common import free_name, map_texts, stored
from isobar.llm.components import connected

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.99999
HASHES = 150
BLOCK = 256
CHUNK_WORDS = 1 << 16


def banding(threshold: float = THRESHOLD, recall: float = RECALL, hashes: int = HASHES) -> tuple[int, int]:
    """Bands and rows: the most rows with which pairs at the threshold meet with the wanted probability."""
    fits = []
    for rows in range(1, hashes + 1):
        bands = math.ceil(math.log(1 - recall) / math.log1p(-(threshold**rows))) if threshold < 1 else 1
        if bands * rows <= hashes:
            fits.append((bands, rows))
    if not fits:
        raise ValueError("too few hashes for this recall")
    return fits[-1]


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    return x ^ (x >> np.uint64(29))


def grams(texts: list[str], n: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of every n-gram of lower-case words, text after text, and where each text starts.

    A text of fewer than n words has one n-gram of all its words; one without words has none.
    """
    split = [t.lower().split() for t in texts]
    counts = np.array([len(s) for s in split], np.int64)
    coded = pa.array([w for s in split for w in s], pa.large_string()).dictionary_encode()
    hashes = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.to_pylist()], np.uint64)
    words = hashes[coded.indices.to_numpy()] if len(coded) else np.empty(0, np.uint64)
    starts = np.cumsum(counts) - counts
    kept = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    first = np.cumsum(kept) - kept
    owner = np.repeat(np.arange(len(texts)), kept)
    at = starts[owner] + np.arange(len(owner)) - first[owner]
    end = starts + counts
    out = np.full(len(owner), 0x9E3779B97F4A7C15, np.uint64)
    for d in range(n):
        place = at + d
        inside = place < end[owner]
        out = np.where(inside, _mixed(out * np.uint64(31) + words[np.minimum(place, max(len(words) - 1, 0))]), out)
    return out, first


def band_hashes(texts: list[str], n: int, bands: int, rows: int) -> list[np.ndarray | None]:
    """For each text its band hashes as signed longs; None if it has no n-gram."""
    gram, first = grams(texts, n)
    ends = np.append(first[1:], len(gram))
    full = np.flatnonzero(ends > first)
    random = np.random.default_rng(20240)
    a = random.integers(0, 2**63, bands * rows, np.uint64) * np.uint64(2) + np.uint64(1)
    b = random.integers(0, 2**63, bands * rows, np.uint64)
    out: list[np.ndarray | None] = [None] * len(texts)
    if len(full):
        least = np.empty((bands * rows, len(full)), np.uint64)
        for i in range(bands * rows):
            least[i] = np.minimum.reduceat(gram * a[i] + b[i], first[full])
        signed = np.empty((len(full), bands), np.int64)
        for band in range(bands):
            key = np.full(len(full), band + 1, np.uint64)
            for row in range(rows):
                key = _mixed(key * np.uint64(31) + least[band * rows + row])
            signed[:, band] = key.view(np.int64)
        for i, x in zip(full, signed):
            out[i] = x
    return out


def _chunks(texts: list[str]) -> Iterator[slice]:
    start, size = 0, 0
    for i, text in enumerate(texts):
        size += len(text) // 6 + 1
        if size >= CHUNK_WORDS:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _sketched(texts: list[str], n: int, bands: int, rows: int) -> list[list]:
    return [[x for part in _chunks(texts) for x in band_hashes(texts[part], n, bands, rows)]]


def links(texts: list[str], side: np.ndarray, n: int, threshold: float) -> np.ndarray:
    """Which texts are linked. With two sides only pairs across them count, with one all pairs."""
    gram, first = grams(texts, n)
    sets = [np.unique(g) for g in np.split(gram, first[1:])]
    sizes = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), sizes)
    kinds, number, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = count > 1
    column = np.cumsum(shared) - 1
    use = shared[number]
    owner, number = owner[use], column[number[use]]
    common = np.zeros((len(sets), len(sets)), np.float32)
    order = np.argsort(number, kind="stable")
    owner, number = owner[order], number[order]
    step = 4096
    for low in range(0, int(shared.sum()), step):
        span = slice(*np.searchsorted(number, [low, low + step]))
        x = np.zeros((len(sets), step), np.float32)
        x[owner[span], number[span] - low] = 1
        common += x @ x.T
    union = sizes[:, None] + sizes[None, :] - common
    linked = (common >= threshold * union - 1e-6) & (common > 0)
    np.fill_diagonal(linked, False)
    if len(np.unique(side)) > 1:
        linked &= side[:, None] != side[None, :]
    return linked


def _compared(batches: Iterator[pd.DataFrame], n: int, threshold: float) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for members, cross in zip(batch["members"], batch["crossing"]):
            unique = {m["digest"]: m for m in members}  # repeated rows of one document
            keys = sorted(unique)
            side = np.array([unique[k]["side"] for k in keys])
            if cross and len(np.unique(side)) < 2:
                continue
            linked = links([unique[k]["text"] for k in keys], side, n, threshold)
            label = np.arange(len(keys))
            while True:
                new = np.where(linked, label[None, :], len(keys)).min(axis=1, initial=len(keys))
                new = np.minimum(label, new)
                new = np.minimum(new, new[new])
                if (new == label).all():
                    break
                label = new
            number = linked.sum(axis=1)
            found = np.flatnonzero(number)
            yield pd.DataFrame({
                "digest": [keys[i] for i in found], "links": number[found].astype("int64"),
                "root": [keys[i] for i in label[found]],
            })


def text_classes(docs: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[DataFrame, DataFrame]:
    """(doc_id, digest) of every row, and for each digest: kept_id, copies, links, class (a digest).

    Digests identify texts; a null text counts as empty. ``links`` counts other texts of which the
    n-gram sets have at least the threshold's Jaccard similarity; a class is a component of such
    links. Texts without a word have no links. kept_id is the least doc_id of the text.
    """
    bands, rows = banding(threshold, recall)
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("digest", F.unhex(F.md5("text")))
    sketched = stored(map_texts(keyed.select("doc_id", "digest", "text"), lambda: lambda texts: _sketched(texts, n, bands, rows),
                                "bands array<long>"), "sketches")
    texts = stored(sketched.groupBy("digest").agg(
        F.min("doc_id").alias("kept_id"), F.count("*").alias("copies"), F.any_value("bands").alias("bands")), "texts")

    banded = texts.select("digest", F.explode("bands").alias("band"))
    least = banded.groupBy("band").agg(F.min("digest").alias("hub"), F.count("*").alias("n")).where("n > 1").drop("n")
    candidates = connected(banded.join(least.hint("merge"), "band").select(F.col("digest").alias("a"), F.col("hub").alias("b")))
    candidates = stored(candidates, "candidates")
    sizes = candidates.groupBy("root").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    work = (
        candidates.join(sizes.hint("merge"), "root").join(texts.select(F.col("digest").alias("node"), "kept_id").hint("merge"), "node")
        .withColumn("blocks", blocks).withColumn("side", own)
        .select("node", "kept_id", "root", "side", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("node", "kept_id", "root", "side", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"))
    )
    placed = keyed.join(work.hint("merge"), (keyed["digest"] == work["node"]) & keyed["doc_id"].eqNullSafe(work["kept_id"]))
    groups = placed.groupBy("root", "i", "j").agg(  # at most two blocks of texts; rows that come again are dropped as they are gathered
        F.collect_set(F.struct("digest", "side", "text")).alias("members")).select("members", (F.col("i") < F.col("j")).alias("crossing"))
    compared = stored(groups.mapInPandas(
        lambda b: _compared(b, n, threshold), "digest binary, links long, root binary"), "compared")
    roots = connected(compared.select(F.col("digest").alias("a"), F.col("root").alias("b")))
    counted = compared.groupBy("digest").agg(F.sum("links").alias("links"))
    classes = (
        texts.drop("bands").join(counted.hint("merge"), "digest", "left")
        .join(roots.select(F.col("node").alias("digest"), F.col("root").alias("class")).hint("merge"), "digest", "left")
        .select("digest", "kept_id", "copies", F.coalesce("links", F.lit(0)).cast("long").alias("links"),
                F.coalesce("class", "digest").alias("class"))
    )
    return sketched.select("doc_id", "digest", F.col("bands").isNotNull().alias("has_words")), classes


def join(docs: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """doc_id, class_id (least doc_id of the class), links, copies (documents of the same text): a row for each row.

    See ``text_classes``. doc_ids may be null or repeated; extra columns are ignored; no rows give no rows.
    """
    rows, classes = text_classes(docs, n, threshold, recall)
    classes = stored(classes, "classes")
    least = classes.groupBy("class").agg(F.min("kept_id").alias("class_id"))
    named = classes.join(least.hint("merge"), "class").select("digest", "class_id", "links", "copies")
    return rows.join(named.hint("merge"), "digest").select("doc_id", "class_id", "links", "copies")


def keep_one(docs: DataFrame, n: int = NGRAM, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row of each class, that with the least doc_id (null last), with all its columns.

    Rows whose text has no word are no copies of each other and all stay. Of repeated rows with
    the same doc_id and text one stays.
    """
    rows, classes = text_classes(docs, n, threshold, recall)
    digest, id_ = free_name(docs, "_digest"), free_name(docs, "_kept_id")
    best = F.min(F.struct(F.col("kept_id").isNull().alias("none"), "kept_id", "digest")).alias("best")
    kept = classes.groupBy("class").agg(best).select(F.col("best.kept_id").alias(id_), F.col("best.digest").alias(digest))
    wordless = F.coalesce("text", F.lit("")).rlike(r"^\s*$")
    keyed = docs.withColumn(digest, F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    joined = keyed.where(~wordless).join(
        kept.withColumnRenamed(digest, digest + "k").hint("merge"),
        (F.col(digest) == F.col(digest + "k")) & F.col("doc_id").eqNullSafe(F.col(id_)))
    return joined.dropDuplicates(["doc_id", digest]).select(*docs.columns).unionByName(docs.where(wordless))
