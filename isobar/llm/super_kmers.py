"""Passages that stand more than once: windows of words counted exactly by super-k-mer partitioning.

A window's minimiser is the least hash of the runs of a few words in it. Consecutive windows that
share their minimiser travel as one packed string, the super-k-mer, to the bucket of the minimiser;
equal windows have equal minimisers, so they meet there, and sorting a bucket's windows counts them
exactly, as strings. Hashes only choose buckets.

Three rounds over blocks of documents, which stay where they are: minimisers are tallied first, so
that only super-k-mers of repeated minimisers travel; these are judged in their buckets; then each
block drops the words that repeated windows cover. A minimiser with very many different
super-k-mers, such as one of a line that a third of the documents hold, would make a hot bucket: its
windows go one by one to a count by window instead, which is aggregated before its shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from isobar.llm.common import (
    arrow_schema, bounded_batches, bucketed, one_list, packed, pieces, stored, text_blocks, unpacked)

WINDOW = 35
GRAM = 8
BLOCK_BYTES = 2 << 20
#: Different super-k-mers of a minimiser that are judged in one group; those of more frequent ones go window by window.
GROUP = 512
BATCH_BYTES = 4 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit hash."""
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(31))


class Block:
    """The words of a block's texts, laid end to end, and the runs of windows that share a minimiser."""

    def __init__(self, flat: bytes, counts: np.ndarray, window: int, gram: int):
        self.flat, self.window = flat, window
        text = np.frombuffer(flat, np.uint8)
        spaces = np.flatnonzero(text == 32)
        self.starts = np.concatenate([[0], spaces + 1]) if len(text) else np.empty(0, np.int64)
        self.ends = np.append(spaces, len(text)) if len(text) else np.empty(0, np.int64)
        n, grams = len(self.starts), window - gram + 1
        none = np.empty(0, np.int64)
        self.first, self.width, self.key, self.weight, self.trace = none, none, none, none, none
        if n < window:
            return
        hashes = self._word_hashes(text)
        runs = np.zeros(n - gram + 1, np.uint64)
        for i in range(gram):
            runs = runs * np.uint64(0x9E3779B97F4A7C15) + hashes[i : n - gram + 1 + i]
        runs = _mixed(runs)
        least, span = runs, 1
        while 2 * span <= grams:
            least, span = np.minimum(least[:-span], least[span:]), 2 * span
        if span < grams:
            least = np.minimum(least[: len(runs) - grams + 1], least[grams - span :])
        doc = np.repeat(np.arange(len(counts)), counts)
        at = np.flatnonzero(doc[: n - window + 1] == doc[window - 1 :])  # windows inside one document
        if not len(at):
            return
        value = least[at]
        fresh = np.concatenate([[True], (at[1:] != at[:-1] + 1) | (value[1:] != value[:-1])])
        place = np.arange(len(at))
        inside = place - np.maximum.accumulate(np.where(fresh, place, 0))
        fresh |= inside % (4 * grams) == 0  # monotonous text would make runs without end
        heads = np.flatnonzero(fresh)
        self.first, self.width = at[heads], np.diff(np.append(heads, len(at)))
        value = value[heads]
        self.key = value.view(np.int64)
        # How often the minimiser stands in the super-k-mer: twice at least, if a window repeats inside it.
        length = self.width + grams - 1
        offsets = np.cumsum(length) - length
        covered = np.repeat(self.first - offsets, length) + np.arange(int(length.sum()))
        self.weight = np.add.reduceat(runs[covered] == np.repeat(value, length), offsets, dtype=np.int64)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes)])
        self.trace = _mixed(sums[self.first + self.width + window - 1] - sums[self.first]
                            + value * np.uint64(31) + self.width.astype(np.uint64)).view(np.int64)

    def _word_hashes(self, text: np.ndarray) -> np.ndarray:
        """By length and up to 8 bytes of either end: equal words have equal ones."""
        padded = np.concatenate([text, np.zeros(8, np.uint8)])
        eights = np.ndarray((len(text),), "<u8", padded, strides=(1,))
        size = self.ends - self.starts
        masks = np.array([(1 << 8 * i) - 1 for i in range(9)], np.uint64)
        head = eights[self.starts] & masks[np.minimum(size, 8)]
        tail = eights[np.maximum(self.ends - 8, self.starts)] * (size > 8).astype(np.uint64)
        return _mixed(head * np.uint64(0xD6E8FEB86659FD93) ^ _mixed(tail + size.astype(np.uint64)))

    def text_of(self, first: int, windows: int) -> bytes:
        return self.flat[self.starts[first] : self.ends[first + windows + self.window - 2]]


def _blocks(batches: Iterator[pa.RecordBatch], schema: pa.Schema, shelves: int, window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Normalised texts, and for every shelf the minimisers with their places and different super-k-mers."""
    for number, (texts, rest) in enumerate(text_blocks(batches, BLOCK_BYTES)):
        words = [t.split() for t in texts]  # bytes are split at ASCII white space
        counts = np.array([len(w) for w in words], np.int64)
        flat = b" ".join(b" ".join(w) for w in words if w)
        block = Block(flat, counts, window, gram)
        _, once = np.unique(block.trace, return_index=True)
        keys, at = np.unique(block.key, return_inverse=True)
        weight = np.bincount(at, block.weight, len(keys)).astype(np.int64)
        kinds = np.bincount(at[once], minlength=len(keys))
        shelf = (keys.view(np.uint64) % np.uint64(shelves)).astype(np.int64)
        order = np.argsort(shelf, kind="stable")
        filled, starts = np.unique(shelf[order], return_index=True)
        tallies = [{"shelf": k, "keys": keys[m].tobytes(), "weight": packed(weight[m]), "kinds": packed(kinds[m])}
                   for k, m in zip(filled.tolist(), np.split(order, starts[1:]))] if len(keys) else []
        made = {
            "block": pa.array([TaskContext.get().partitionId() << 32 | number]),
            "flat": pa.array([zstandard.ZstdCompressor(level=3).compress(flat)]), "counts": pa.array([packed(counts)]),
            "docs": one_list(rest, schema.field("docs").type), "tallies": pa.array([tallies], schema.field("tallies").type),
        }
        yield pa.RecordBatch.from_arrays([made[f.name].cast(f.type) for f in schema], schema=schema)


MARKED = pa.schema([("block", pa.int64()), ("keys", pa.binary()), ("hot", pa.binary())])


def _tallied(batches: Iterator[pa.RecordBatch], group: int) -> Iterator[pa.RecordBatch]:
    """For each block its minimisers that stand in two places or more of the whole table, and which of them are frequent."""
    rows = [r for batch in batches for r in batch.to_pylist()]  # the minimisers of one shelf, 8 bytes each
    if not rows:
        return
    keys = np.concatenate([np.frombuffer(r["keys"], np.int64) for r in rows])
    distinct, at = np.unique(keys, return_inverse=True)
    total = lambda name: np.bincount(at, np.concatenate([unpacked(r[name]) for r in rows]), len(distinct))
    repeated, hot = total("weight") > 1, total("kinds") > group
    start = 0
    for r in rows:
        own = at[start : start + len(r["keys"]) // 8]
        start += len(own)
        own = own[repeated[own]]
        if len(own):
            yield pa.RecordBatch.from_pylist(
                [{"block": r["block"], "keys": distinct[own].tobytes(), "hot": hot[own].tobytes()}], MARKED)


SENT = pa.schema([("key", pa.int64()), ("packed", pa.binary()), ("block", pa.int64()), ("places", pa.binary()), ("hot", pa.bool_())])


def _sent(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[pa.RecordBatch]:
    """Super-k-mers of repeated minimisers, single windows of frequent ones; equal ones of a block once, with their places."""
    for batch in batches:
        for i in range(batch.num_rows):
            marks = batch.column("marks")[i].as_py() or []
            if not marks:
                continue
            known = np.concatenate([np.frombuffer(m["keys"], np.int64) for m in marks])
            hot = np.concatenate([np.frombuffer(m["hot"], np.bool_) for m in marks])
            order = np.argsort(known)
            known, hot = known[order], hot[order]
            flat = zstandard.ZstdDecompressor().decompress(batch.column("flat")[i].as_py())
            block, number = Block(flat, unpacked(batch.column("counts")[i].as_py()), window, gram), batch.column("block")[i].as_py()
            place = np.minimum(np.searchsorted(known, block.key), len(known) - 1)
            chosen = np.flatnonzero(known[place] == block.key)
            found: dict[bytes, tuple[int, bool, list[int]]] = {}
            for r in chosen.tolist():
                key, first, width, single = int(block.key[r]), int(block.first[r]), int(block.width[r]), bool(hot[place[r]])
                for at, n in [(first + j, 1) for j in range(width)] if single else [(first, width)]:
                    found.setdefault(block.text_of(at, n), (key, single, []))[2].append(at)
            rows, size = [], 0
            for text, (key, single, places) in found.items():
                rows.append({"key": key, "packed": text, "block": number, "places": np.array(places, "<u4").tobytes(), "hot": single})
                size += len(text)
                if size > BATCH_BYTES:
                    yield pa.RecordBatch.from_pylist(rows, SENT)
                    rows, size = [], 0
            if rows:
                yield pa.RecordBatch.from_pylist(rows, SENT)


def _repeats(group: list[dict], window: int) -> list[bytes | None]:
    """For each member one byte a window, 1 where it stands elsewhere too; None where none does."""
    texts: dict[bytes, int] = {}
    for m in group:
        texts[m["packed"]] = texts.get(m["packed"], 0) + len(m["places"]) // 4
    windows, flags = [], {}
    for text, copies in texts.items():
        ends = np.flatnonzero(np.frombuffer(text, np.uint8) == 32).tolist()
        starts, ends = [0, *(e + 1 for e in ends)], [*ends, len(text)]
        flags[text] = bytearray(len(starts) - window + 1)
        windows += [(text[s:e], text, j, copies) for j, (s, e) in enumerate(zip(starts, ends[window - 1 :]))]
    windows.sort(key=lambda w: w[0])
    start = 0
    while start < len(windows):
        end, copies = start, 0
        while end < len(windows) and windows[end][0] == windows[start][0]:
            copies += windows[end][3]
            end += 1
        if copies > 1:
            for _, text, j, _ in windows[start:end]:
                flags[text][j] = 1
        start = end
    return [bytes(f) if any(f := flags[m["packed"]]) else None for m in group]


JUDGED = pa.schema([("block", pa.int64()), ("places", pa.binary()), ("flags", pa.binary())])


def _judged(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by minimiser; those of one make a group."""
    group: list[dict] = []

    def judged(rows: list[dict]) -> list[dict]:
        return [{"block": m["block"], "places": m["places"], "flags": f} for m, f in zip(rows, _repeats(rows, window)) if f]

    for batch in batches:
        out = []
        for row in batch.to_pylist():
            if group and group[0]["key"] != row["key"]:
                out += judged(group)
                group = []
            group.append(row)
        if out:
            yield pa.RecordBatch.from_pylist(out, JUDGED)
    if out := judged(group):
        yield pa.RecordBatch.from_pylist(out, JUDGED)


def _stripped(batches: Iterator[pa.RecordBatch], schema: pa.Schema, names: list[str], window: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i in range(batch.num_rows):
            counts = unpacked(batch.column("counts")[i].as_py()).astype(np.int64)
            text = np.frombuffer(zstandard.ZstdDecompressor().decompress(batch.column("flat")[i].as_py()), np.uint8)
            spaces = np.flatnonzero(text == 32)
            sizes = np.diff(np.concatenate([[-1], spaces, [len(text)]])) if len(text) else np.empty(0, np.int64)  # with the space
            edges = np.zeros(len(sizes) + 1, np.int64)
            for row in batch.column("verdicts")[i].as_py() or []:
                at = np.add.outer(np.frombuffer(row["places"], "<u4").astype(np.int64),
                                  np.flatnonzero(np.frombuffer(row["flags"], np.uint8))).ravel()
                np.add.at(edges, at, 1)
                np.add.at(edges, at + window, -1)
            kept = np.cumsum(edges[:-1]) == 0
            padded = np.append(text, 32).astype(np.uint8) if len(text) else text
            left = padded[np.repeat(kept, sizes)].tobytes()
            of = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[np.concatenate([[0], np.cumsum(counts)])])
            ends = np.cumsum(of(np.where(kept, sizes, 0))).tolist()
            texts = [left[a : max(a, b - 1)] for a, b in zip([0, *ends], ends)]
            docs = batch.column("docs")[i].values
            made = [*(docs.field(n) for n in names), pa.array(counts), pa.array(of((~kept).astype(np.int64))),
                    pa.array(texts, pa.binary()).view(pa.string())]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(made, schema)], schema=schema)


def strip_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, group: int = GROUP) -> DataFrame:
    """The rows with ``text`` without words that a repeated window covers, n_words (before) and n_removed.

    Words are maximal runs of other than ASCII white space and come back joined by single spaces. A
    window repeats if its words start anywhere else, in another row or the same one; rows that are equal
    repeat each other, so both lose their long passages. A null text counts as empty, and texts shorter
    than a window keep all words. Other columns pass through; n_words and n_removed are replaced.
    No documents, no rows. A text is held whole by one task.
    """
    spark = docs.sparkSession
    bounded_batches(spark)
    added = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("text", T.StringType())]
    rest = T.StructType([f for f in docs.schema.fields if f.name not in {a.name for a in added}])
    tally = T.StructType([T.StructField("shelf", T.IntegerType()), *(T.StructField(n, T.BinaryType()) for n in ("keys", "weight", "kinds"))])
    block = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("flat", T.BinaryType()), T.StructField("counts", T.BinaryType()),
        T.StructField("docs", T.ArrayType(rest)), T.StructField("tallies", T.ArrayType(tally))])
    shelves, schema = pieces(spark, 1), arrow_schema(block)
    blocks = bucketed(docs.select("text", *rest.names).mapInArrow(
        lambda b: _blocks(b, schema, shelves, window, gram), block), "passage_blocks", "block", shelves)
    marks = blocks.select("block", F.inline("tallies")).repartition("shelf").mapInArrow(
        lambda b: _tallied(b, group), "block long, keys binary, hot binary")
    marks = marks.groupBy("block").agg(F.collect_list(F.struct("keys", "hot")).alias("marks"))  # bounded by a block's windows
    sent = stored(blocks.select("block", "flat", "counts").join(marks.hint("merge"), "block").mapInArrow(
        lambda b: _sent(b, window, gram), "key long, packed binary, block long, places binary, hot boolean"), "super-kmers")
    judged = sent.where(~F.col("hot")).select("key", "packed", "block", "places").repartition("key").sortWithinPartitions("key").mapInArrow(
        lambda b: _judged(b, window), "block long, places binary, flags binary")
    single = sent.where("hot").select("packed", "block", "places")
    twice = single.groupBy("packed").agg(F.sum(F.octet_length("places")).alias("size")).where("size > 4").select("packed")
    verdicts = judged.unionByName(single.join(twice, "packed", "left_semi").select(
        "block", "places", F.unhex(F.lit("01")).alias("flags")))
    verdicts = verdicts.groupBy("block").agg(F.collect_list(F.struct("places", "flags")).alias("verdicts"))
    out = T.StructType([*rest.fields, *added])
    out_schema, names = arrow_schema(out), rest.names
    return blocks.select("block", "flat", "counts", "docs").join(verdicts.hint("merge"), "block", "left").mapInArrow(
        lambda b: _stripped(b, out_schema, names, window), out)
