"""Byte-level BPE over a corpus: every distinct word is encoded once.

Texts are cut into pre-tokens. A block of documents keeps its distinct pre-tokens and, for
every position, which of them stands there. Words are dealt to shelves by their hash; a
block's words of one shelf travel as one row, and where the rows of a shelf meet, each
distinct word is encoded once. Ids go back to the blocks, and each block puts its documents
together by position. A word comes at most once from each block, so frequent words make no
hot key. Decoding looks every id up in the table of token bytes, whose
size is that of the vocabulary.
"""

from __future__ import annotations

import base64
import heapq
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import zstandard
from pyspark.sql import DataFrame, functions as F, types as T

from isobar.llm.common import bounded_batches, pieces
from isobar.session import scratch_path

BLOCK_BYTES = 4 << 20
#: Bytes of words whose ids a task remembers; beyond that it starts anew, which costs time only.
KNOWN_BYTES = 32 << 20


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to ids, from lines of base64 token and rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def encode_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Merge the adjacent pair of lowest rank, the leftmost first, until none is left."""
    if (known := ranks.get(word)) is not None:
        return [known]
    n = len(word)
    end, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap: list[tuple[int, int, int]] = []

    def offer(i: int) -> None:
        j = end[i]
        if j < n and (rank := ranks.get(word[i : end[j]])) is not None:
            heapq.heappush(heap, (rank, i, end[j]))

    for i in range(n):
        offer(i)
    while heap:
        _, i, stop = heapq.heappop(heap)
        j = end[i]
        if j is None or j >= n or end[j] != stop:
            continue  # one side was merged meanwhile
        end[i], end[j] = stop, None
        if stop < n:
            before[stop] = i
        offer(i)
        if before[i] >= 0:
            offer(before[i])
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def _packed(values: np.ndarray) -> bytes:
    """Non-negative integers as compressed byte planes."""
    planes = values.astype("<u4").view(np.uint8).reshape(-1, 4).T
    return zstandard.ZstdCompressor(level=3).compress(np.ascontiguousarray(planes).tobytes())


def _unpacked(blob: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").ravel()


def _lists(lengths: np.ndarray, flat: bytes) -> list[bytes]:
    ends = np.cumsum(lengths).tolist()
    return [flat[a:b] for a, b in zip([0, *ends], ends)]


def _blocks(batches: Iterator[pa.RecordBatch], pattern: str, shelves: int, schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    cut = regex.compile(pattern).findall
    kept, places, words, size = [], [], {}, 0

    def block() -> pa.RecordBatch:
        docs = pa.concat_tables(kept).to_struct_array()
        docs = pa.concat_arrays(docs.chunks) if isinstance(docs, pa.ChunkedArray) else docs
        encoded = [w.encode() for w in words]
        shelf = np.array([zlib.crc32(w) % shelves for w in encoded], np.int64)
        order = np.argsort(shelf, kind="stable")  # words are numbered shelf after shelf
        number = np.empty(len(order), np.uint32)
        number[order] = np.arange(len(order), dtype=np.uint32)
        filled, starts = np.unique(shelf[order], return_index=True)
        parts = []
        for k, members in zip(filled.tolist(), np.split(order, starts[1:])):
            own = [encoded[i] for i in members.tolist()]
            parts.append({"shelf": k, "lengths": _packed(np.array([len(w) for w in own])),
                          "words": zstandard.ZstdCompressor(level=3).compress(b"".join(own))})
        flat = number[np.concatenate(places)] if words else np.empty(0, np.uint32)
        row = {
            "block": pa.array([uuid.uuid4().hex]), "words": pa.array([parts], schema.field("words").type),
            "counts": pa.array([_packed(np.array([len(p) for p in places]))]), "places": pa.array([_packed(flat)]),
            "docs": pa.ListArray.from_arrays(pa.array([0, len(docs)], pa.int32()), docs).cast(schema.field("docs").type),
        }
        return pa.RecordBatch.from_arrays([row[f.name] for f in schema], schema=schema)

    for batch in batches:
        texts, rest, start = batch.column("text"), pa.Table.from_batches([batch.drop_columns(["text"])]), 0
        for i, text in enumerate(texts):
            found = cut(text.as_py() or "")
            places.append(np.fromiter((words.setdefault(w, len(words)) for w in found), np.uint32, len(found)))
            size += 1 + (text.as_buffer().size if text.is_valid else 0)
            if size >= BLOCK_BYTES:
                kept.append(rest.slice(start, i + 1 - start))
                yield block()
                kept, places, words, size, start = [], [], {}, 0, i + 1
        if start < len(texts):
            kept.append(rest.slice(start))
    if places:
        yield block()


ENCODED = pa.schema([("block", pa.string()), ("shelf", pa.int32()), ("lengths", pa.binary()), ("ids", pa.binary())])


def _encoded(batches: Iterator[pa.RecordBatch], ranks: dict[bytes, int]) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, list[int]] = {}  # a word stands on one shelf only, so it is encoded here and nowhere else
    size = 0
    for batch in batches:
        for row in batch.to_pylist():
            flat = zstandard.ZstdDecompressor().decompress(row["words"])
            ids = []
            for word in _lists(_unpacked(row["lengths"]), flat):
                found = known.get(word)
                if found is None:
                    size += 200 + 2 * len(word)
                    if size > KNOWN_BYTES:
                        known.clear()
                        size = 0
                    found = known[word] = encode_word(word, ranks)
                ids.append(found)
            yield pa.RecordBatch.from_pylist([{
                "block": row["block"], "shelf": row["shelf"], "lengths": _packed(np.array([len(x) for x in ids])),
                "ids": _packed(np.array([i for x in ids for i in x])),
            }], ENCODED)


def _assembled(batches: Iterator[pa.RecordBatch], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    none = np.empty(0, np.int64)
    for batch in batches:
        for i in range(batch.num_rows):
            docs = batch.column("docs")[i].values
            shelves = sorted(batch.column("shelves")[i].as_py() or [], key=lambda x: x["shelf"])
            lengths = np.concatenate([none, *(_unpacked(x["lengths"]) for x in shelves)]).astype(np.int64)
            flat = np.concatenate([none, *(_unpacked(x["ids"]) for x in shelves)]).astype("<u4")
            starts = np.cumsum(lengths) - lengths
            places, done, ids = _unpacked(batch.column("places")[i].as_py()), 0, []
            for n in _unpacked(batch.column("counts")[i].as_py()).tolist():
                own = places[done : done + n]
                done += n
                size = lengths[own]
                first = np.repeat(starts[own] - (np.cumsum(size) - size), size)
                ids.append(flat[first + np.arange(len(first))].tobytes())
            columns = [docs.field(f.name) for f in list(schema)[:-1]]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(ids, pa.binary())], schema=schema)


def _shelved(df: DataFrame, buckets: int) -> DataFrame:
    """The blocks, written once to the shared folder and bucketed, so that a join by block moves only its other side."""
    spark, name = df.sparkSession, f"bpe_blocks_{uuid.uuid4().hex}"
    df.write.option("path", scratch_path(spark, "bpe-blocks")).option("compression", "zstd").bucketBy(
        buckets, "block").saveAsTable(name)
    blocks = spark.table(name)
    blocks.schema  # resolved before the name goes; the files stay
    spark.sql(f"DROP TABLE {name}")
    return blocks


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(schema)


def _assembly(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> tuple[DataFrame, T.StructType]:
    """Blocks beside the ids of their words, and the type of the encoded rows."""
    bounded_batches(docs.sparkSession)
    rest = [f for f in docs.schema.fields if f.name not in ("text", "ids")]
    kept = T.StructType([T.StructField(f.name, f.dataType) for f in rest])
    shelf = T.StructType([
        T.StructField("shelf", T.IntegerType()), T.StructField("lengths", T.BinaryType()), T.StructField("words", T.BinaryType())])
    block = T.StructType([
        T.StructField("block", T.StringType()), T.StructField("words", T.ArrayType(shelf)),
        T.StructField("counts", T.BinaryType()), T.StructField("places", T.BinaryType()),
        T.StructField("docs", T.ArrayType(kept)),
    ])
    out = T.StructType([*kept.fields, T.StructField("ids", T.BinaryType())])
    block_arrow, shelves = _arrow(block), pieces(docs.sparkSession, 1)
    blocks = _shelved(docs.select("text", *kept.names).mapInArrow(
        lambda b: _released(_blocks(b, pattern, shelves, block_arrow)), block), shelves)
    encoded = blocks.select("block", F.inline("words")).repartition("shelf").mapInArrow(
        lambda b: _released(_encoded(b, ranks)), "block string, shelf int, lengths binary, ids binary")
    entries = encoded.groupBy("block").agg(
        F.collect_list(F.struct("shelf", "lengths", "ids")).alias("shelves"))  # the words of one block, bounded by its bytes
    return (
        blocks.select("block", "docs", "counts", "places").join(entries.hint("merge"), "block", "left")
        .select("docs", "counts", "places", "shelves")
    ), out


def encode(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """The rows without ``text``, with ``ids``: its token ids as packed little-endian unsigned 32-bit integers.

    A null or empty text has no ids. All other columns are kept, but one called ids is replaced;
    repeated rows come back as often as they were given, no rows give none. No special tokens are
    recognised. A text is held whole by one task.
    """
    blocks, out = _assembly(docs, ranks, pattern)
    schema = _arrow(out)
    return blocks.mapInArrow(lambda b: _released(_assembled(b, schema)), out)


def round_trip(docs: DataFrame, ranks: dict[bytes, int], pattern: str) -> DataFrame:
    """What ``decode(encode(...))`` gives, with both last steps in the same Python worker."""
    blocks, encoded = _assembly(docs, ranks, pattern)
    tokens, out = _tokens(ranks), _with_bytes(encoded)
    middle, schema = _arrow(encoded), _arrow(out)
    return blocks.mapInArrow(lambda b: _released(_decoded(_assembled(b, middle), tokens, schema)), out)


def _released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches; workers are used again, so what Arrow keeps for later goes back to the system at the end."""
    yield from batches
    pa.default_memory_pool().release_unused()


def _decoded(batches: Iterator[pa.RecordBatch], tokens: list[bytes], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    table = pa.array(tokens, pa.binary())
    for batch in batches:
        packed = batch.column("ids")
        flat = np.frombuffer(b"".join(packed.drop_null().to_pylist()), "<u4")
        found = pc.take(table, pa.array(flat))  # all tokens' bytes end to end; texts are cut from them
        offsets = np.frombuffer(found.buffers()[1], np.int32)[found.offset :][: len(flat) + 1] if len(flat) else np.zeros(1, np.int32)
        counts = pc.fill_null(pc.binary_length(packed), 0).to_numpy(zero_copy_only=False) // 4
        ends = pa.py_buffer(offsets[np.concatenate([[0], np.cumsum(counts)])].astype(np.int32))
        texts = pa.Array.from_buffers(pa.binary(), len(packed), [None, ends, found.buffers()[2]])
        if packed.null_count:
            texts = pc.if_else(packed.is_valid(), texts, pa.scalar(None, pa.binary()))
        columns = [batch.column(f.name) for f in list(schema)[:-1]]
        yield pa.RecordBatch.from_arrays([*columns, texts], schema=schema)


def _tokens(ranks: dict[bytes, int]) -> list[bytes]:
    if sorted(ranks.values()) != list(range(len(ranks))):
        raise ValueError("ranks must be gapless from 0")
    return sorted(ranks, key=ranks.__getitem__)


def _with_bytes(encoded: T.StructType) -> T.StructType:
    return T.StructType([*(f for f in encoded.fields if f.name != "decoded"), T.StructField("decoded", T.BinaryType())])


def decode(encoded: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Add ``decoded``: the bytes of the packed ``ids``, null where they are; an id outside the vocabulary stops the job."""
    tokens, out = _tokens(ranks), _with_bytes(encoded.schema)
    arrow = _arrow(out)
    return encoded.mapInArrow(lambda b: _released(_decoded(b, tokens, arrow)), out)
