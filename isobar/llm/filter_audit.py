"""How document filters interact, counted over a sparse document-term matrix.

Words are encoded by a dictionary of the whole table: each block of documents sends its distinct
words to shelves by their hash, a shelf numbers every distinct word once, and the numbers come
back. A block is then one CSR shard of the matrix: its row sums are the documents' words, its
nonzero counts their distinct words, and these decide the first two filters. The other flags are
expressions on the text and a shuffle of digests. What is left to audit is one row for each
part and combination of flags, whatever the number of documents.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from isobar.llm.common import arrow_schema, bounded_batches, one_list, packed, pieces, stored, text_blocks, unpacked

BLOCK_BYTES = 2 << 20
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_DISTINCT, MOST_CAPITALS = 50, 65, 5  # the last two in percent
MARKS = "[#$%&*|]"

SHELF = T.StructType([
    T.StructField("shelf", T.IntegerType()), T.StructField("lengths", T.BinaryType()), T.StructField("words", T.BinaryType())])
CSR = [T.StructField(n, T.BinaryType()) for n in ("indptr", "indices", "data")]


def _counted(batches: Iterator[pa.RecordBatch], shelves: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Blocks as CSR over their own words, which are numbered shelf after shelf."""
    for number, (texts, rest) in enumerate(text_blocks(batches, BLOCK_BYTES)):
        words: dict[bytes, int] = {}
        rows = [np.array([words.setdefault(w, len(words)) for w in t.split()], np.int64) for t in texts]  # bytes split at ASCII white space
        shelf = np.array([zlib.crc32(w) % shelves for w in words], np.int64)
        order = np.argsort(shelf, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        encoded, parts = list(words), []
        filled, starts = np.unique(shelf[order], return_index=True)
        for k, members in zip(filled.tolist(), np.split(order, starts[1:])):
            own = [encoded[i] for i in members.tolist()]
            parts.append({"shelf": k, "lengths": packed(np.array([len(w) for w in own])),
                          "words": zstandard.ZstdCompressor(level=1).compress(b"".join(own))})
        lengths = np.array([len(r) for r in rows], np.int64)
        cells = np.repeat(np.arange(len(rows)), lengths) * max(len(words), 1)
        if words:
            cells += place[np.concatenate(rows)]
        cells, data = np.unique(cells, return_counts=True)
        row, column = np.divmod(cells, max(len(words), 1))
        indptr = np.searchsorted(row, np.arange(len(rows) + 1))
        made = {
            "block": pa.array([TaskContext.get().partitionId() << 32 | number]),
            "words": pa.array([parts], schema.field("words").type),
            "docs": one_list(rest, schema.field("docs").type),
            **{n: pa.array([packed(v)]) for n, v in (("indptr", indptr), ("indices", column), ("data", data))},
        }
        yield pa.RecordBatch.from_arrays([made[f.name].cast(f.type) for f in schema], schema=schema)


NUMBERED = pa.schema([("block", pa.int64()), ("shelf", pa.int32()), ("ids", pa.binary())])


def _numbered(batches: Iterator[pa.RecordBatch], shelves: int) -> Iterator[pa.RecordBatch]:
    """Ids of each block's words; rows come by shelf and block, so a repeated task numbers alike."""
    known: dict[bytes, int] = {}
    now = None
    for batch in batches:
        for row in batch.to_pylist():
            if row["shelf"] != now:  # a word stands on one shelf only
                known, now = {}, row["shelf"]
            flat, at, ids = zstandard.ZstdDecompressor().decompress(row["words"]), 0, []
            for n in unpacked(row["lengths"]).tolist():
                ids.append(known.setdefault(flat[at : at + n], len(known) * shelves + now))
                at += n
            yield pa.RecordBatch.from_pylist(
                [{"block": row["block"], "shelf": now, "ids": packed(np.array(ids, np.int64), "<i8")}], NUMBERED)


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """Blocks with the columns of their matrix put in the dictionary's ids."""
    for batch in batches:
        for i in range(batch.num_rows):
            found = sorted(batch.column("found")[i].as_py() or [], key=lambda x: x["shelf"])
            ids = np.concatenate([np.empty(0, np.int64), *(unpacked(x["ids"], "<i8") for x in found)])
            local = unpacked(batch.column("indices")[i].as_py())
            yield {"docs": batch.column("docs")[i].values, "block": batch.column("block")[i].as_py(), "indices": ids[local],
                   **{n: unpacked(batch.column(n)[i].as_py()) for n in ("indptr", "data")}}


def _joined(docs: DataFrame) -> tuple[DataFrame, T.StructType]:
    """Every block beside the ids of its words, and the type of its documents."""
    bounded_batches(docs.sparkSession)
    rest = T.StructType([f for f in docs.schema.fields if f.name != "text"])
    block = T.StructType([
        T.StructField("block", T.LongType()), T.StructField("words", T.ArrayType(SHELF)), T.StructField("docs", T.ArrayType(rest)), *CSR])
    shelves, schema = pieces(docs.sparkSession, 1), arrow_schema(block)
    blocks = stored(docs.select("text", *rest.names).mapInArrow(lambda b: _counted(b, shelves, schema), block), "term-blocks")
    ids = blocks.select("block", F.inline("words")).repartition("shelf").sortWithinPartitions("shelf", "block").mapInArrow(
        lambda b: _numbered(b, shelves), "block long, shelf int, ids binary")
    found = ids.groupBy("block").agg(F.collect_list(F.struct("shelf", "ids")).alias("found"))  # bounded by a block's words
    return blocks.drop("words").join(found.hint("merge"), "block", "left"), rest


def document_term(docs: DataFrame) -> DataFrame:
    """CSR shards of the document-term matrix: block, docs (the rows' other columns), and packed indptr, indices, data.

    Indices are the dictionary's ids as 64-bit integers (gaps are possible), indptr and data 32-bit;
    see :func:`isobar.llm.common.unpacked`. Words are maximal runs of other than ASCII white space.
    A null or empty text is an empty row; repeated rows are rows of their own; no documents, no shards.
    """
    blocks, rest = _joined(docs)
    out = T.StructType([T.StructField("block", T.LongType()), T.StructField("docs", T.ArrayType(rest)), *CSR])
    schema = arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _shards(batches):
            made = [pa.array([s["block"]]), pa.ListArray.from_arrays(pa.array([0, len(s["docs"])], pa.int32()), s["docs"]),
                    pa.array([packed(s["indptr"])]), pa.array([packed(s["indices"], "<i8")]), pa.array([packed(s["data"])])]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(made, schema)], schema=schema)

    return blocks.mapInArrow(run, out)


def term_counts(docs: DataFrame) -> DataFrame:
    """The rows without ``text``, with n_words and n_distinct: row sums and nonzero counts of the matrix."""
    blocks, rest = _joined(docs.drop("n_words", "n_distinct"))
    out = T.StructType([*rest.fields, T.StructField("n_words", T.LongType()), T.StructField("n_distinct", T.LongType())])
    schema = arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for s in _shards(batches):
            sums = np.concatenate([[0], np.cumsum(s["data"], dtype=np.int64)])[s["indptr"]]
            made = [*(s["docs"].field(n) for n in rest.names), pa.array(np.diff(sums)), pa.array(np.diff(s["indptr"].astype(np.int64)))]
            yield pa.RecordBatch.from_arrays([a.cast(f.type) for a, f in zip(made, schema)], schema=schema)

    return blocks.mapInArrow(run, out)


def flagged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, part, failed (letters of the filters it fails), good, toxic of every row.

    docs: doc_id, text, source; labels: doc_id, quality, toxic (several rows of a document count
    as one that has each mark if any has it; other columns are ignored). Null text is empty, null
    source the empty part. E: the text is that of a smaller doc_id, so rows that share the smallest
    one pass, as do rows without an id.
    """
    text = F.coalesce("text", F.lit(""))
    measured = docs.select(
        "doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("text"),
        F.unhex(F.sha2(text, 256)).alias("digest"), text.rlike(MARKS).alias("marked"),
        (100 * F.regexp_count(text, F.lit("[A-Z]")) > MOST_CAPITALS * F.length(text)).alias("capital"))
    counts = stored(term_counts(measured), "term-counts")
    # Shuffled by digest and id, so a text that a third of the rows have is no hot key.
    first = counts.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).where("doc_id IS NOT NULL").withColumn("first", F.lit(True))
    marks = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    rows = counts.join(first, ["digest", "doc_id"], "left").join(marks, "doc_id", "left")
    fails = {
        "A": F.col("n_words") < LEAST_WORDS,
        "B": 100 * F.col("n_distinct") < LEAST_DISTINCT * F.col("n_words"),
        "C": F.col("capital"),
        "D": F.col("marked"),
        "E": F.col("doc_id").isNotNull() & F.col("first").isNull(),
    }
    letter = lambda c, name: F.when(c, F.lit(name)).otherwise(F.lit(""))
    return rows.select(
        "doc_id", "part", F.concat(*(letter(c, name) for name, c in fails.items())).alias("failed"),
        *((F.coalesce(m, F.lit(0)) == 1).alias(m) for m in ("good", "toxic")))


def audit(flags: DataFrame, filters: str = FILTERS) -> DataFrame:
    """One row for each part, order of the filters and step, zeros included; counts as in the query's contract.

    Every row of ``flags`` counts. Rows meet as counts by part and combination of flags, and each
    of these few is then laid out over all orders. No rows, no parts.
    """
    orders = F.split(F.lit(",".join("".join(p) for p in permutations(filters))), ",")
    states = flags.groupBy("part", "failed", "good", "toxic").agg(F.count("*").alias("n"))
    laid = states.select("*", F.explode(orders).alias("filter_order")).select(
        "*", F.explode(F.sequence(F.lit(1), F.lit(len(filters)))).alias("step"))
    without = lambda c: F.expr(f"translate({c}, failed, '')")
    so_far, before = "left(filter_order, step)", "left(filter_order, step - 1)"
    passed = lambda c: F.length(without(c)) == F.length(F.expr(c))
    count = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0)).cast("bigint")
    fails = F.expr("instr(failed, substring(filter_order, step, 1)) > 0")
    removed = fails & passed(before)
    # Of k failing filters each comes first in the same number of orders.
    share = F.when(fails, F.col("n") * F.expr(f"{factorial(len(filters))} div length(failed)")).otherwise(0)
    return laid.groupBy("part", "filter_order", "step").agg(
        count(passed(so_far)).alias("kept"), count(removed).alias("removed"), count(fails & ~passed(before)).alias("redundant"),
        count(fails & (F.length("failed") == 1)).alias("unique_fails"), count(removed & F.col("good")).alias("good_lost"),
        count(removed & F.col("toxic")).alias("toxic_lost"), F.sum(share).cast("bigint").alias("shapley"))
