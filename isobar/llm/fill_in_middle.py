"""Fill-in-the-middle documents: prefix, suffix and middle of a text cut at lines, in an order a model can be trained on.

A text is laid out in blocks of fixed size. A Fenwick tree over them holds how many lines end
in each block and how many code points it has, so the block of any cut is found by binary
lifting, and only that block is searched for the boundary itself.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from isobar.llm.common import arrow_schema, bounded_batches

BLOCK = 4096
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"  # fixed values: sentinels, none of which can arise where two pieces meet
ADDED = "n bigint, form string, prefix_chars bigint, middle_chars bigint, output string"


class Layout:
    """Where the lines of a text end, by blocks of its bytes."""

    def __init__(self, text: bytes, block: int = BLOCK):
        self._bytes, self._block = np.frombuffer(text, np.uint8), block
        starts = np.arange(0, len(text), block)
        ends = np.add.reduceat(self._bytes == 10, starts, dtype=np.int64) if len(text) else np.empty(0, np.int64)
        points = np.add.reduceat(_begins(self._bytes), starts, dtype=np.int64) if len(text) else np.empty(0, np.int64)
        self._tree = [(0, 0), *zip(ends.tolist(), points.tolist())]
        for i in range(1, len(self._tree)):
            up = i + (i & -i)
            if up < len(self._tree):
                self._tree[up] = (self._tree[up][0] + self._tree[i][0], self._tree[up][1] + self._tree[i][1])
        self.units = int(ends.sum()) + (len(text) > 0 and text[-1] != 10)
        self.points = int(points.sum())

    def cut(self, units: int) -> tuple[int, int]:
        """Bytes and code points of the first ``units`` lines."""
        if units <= 0:
            return 0, 0
        at, left, points = 0, units, 0
        step = 1 << (len(self._tree) - 1).bit_length()
        while step:  # the longest run of blocks in which fewer than ``units`` lines end
            if at + step < len(self._tree) and self._tree[at + step][0] < left:
                at += step
                left -= self._tree[at][0]
                points += self._tree[at][1]
            step >>= 1
        if at == len(self._tree) - 1:  # the last line has no end of its own
            return len(self._bytes), self.points
        local = self._bytes[at * self._block : (at + 1) * self._block]
        found = int(np.flatnonzero(local == 10)[left - 1]) + 1
        return at * self._block + found, points + int(_begins(local[:found]).sum())


def _begins(values: np.ndarray) -> np.ndarray:
    """Which bytes begin a code point."""
    return (values & 0xC0) != 0x80


def draws(seed: int, doc_id: int | None) -> tuple[int, int, int, int]:
    """Four 32-bit numbers of a document: the first 16 bytes of the SHA-256 of seed and id; a null id counts as an empty string."""
    return struct.unpack(">4I", hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()[:16])


def rearranged(text: bytes, doc_id: int | None, seed: int, rate: int, spm: int) -> tuple[int, str, int | None, int | None, bytes]:
    """Lines, form, code points of prefix and middle (none if plain), and the output."""
    layout = Layout(text)
    n = layout.units
    one, two, chance, order = draws(seed, doc_id)
    p, s, m = (x.encode() for x in (PREFIX, SUFFIX, MIDDLE))
    if not text or p in text or s in text or m in text or chance % 100 >= rate:
        return n, "plain", None, None, text
    low, high = sorted((one % (n + 1), two % (n + 1)))
    (start, before), (end, until) = layout.cut(low), layout.cut(high)
    prefix, middle, suffix = text[:start], text[start:end], text[end:]
    if order % 100 < spm:
        return n, "spm", before, until - before, b"".join((s, suffix, p, prefix, m, middle))
    return n, "psm", before, until - before, b"".join((p, prefix, s, suffix, m, middle))


def transform(docs: DataFrame, seed: int = 7, rate: int = 100, spm: int = 50) -> DataFrame:
    """The rows without ``text``, with n, form, prefix_chars, middle_chars and output.

    ``rate`` percent of the documents are rearranged, ``spm`` percent of those suffix first;
    seed and doc_id alone decide, so a repeated row gives the same output again and the result
    doesn't depend on partitions. A null text counts as empty; an empty one, or one that holds
    a sentinel, stays plain. Other columns pass through; those named like new ones are replaced.
    A text is held whole by one task, whatever its length.
    """
    bounded_batches(docs.sparkSession)
    new = T._parse_datatype_string(ADDED)
    rest = [f for f in docs.schema.fields if f.name not in ("text", *new.fieldNames())]
    out = T.StructType([*rest, *new.fields])
    names, schema = [f.name for f in rest], arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            texts, ids = batch.column("text").cast(pa.binary()).to_pylist(), batch.column("doc_id").to_pylist()
            made = [rearranged(t or b"", i, seed, rate, spm) for t, i in zip(texts, ids)]
            columns = [pa.array(v, schema.field(len(names) + k).type) for k, v in enumerate(zip(*(m[:4] for m in made)))]
            output = pa.array([m[4] for m in made], pa.binary()).view(pa.string())
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).cast(schema.field(c).type) for c in names), *columns, output.cast(schema.field("output").type)], schema=schema)

    return docs.select(*names, "text").mapInArrow(run, out)


def restored(form: Column, output: Column) -> Column:
    """The text that was rearranged, from form and output alone."""
    def pieces(first: str, second: str, body) -> Column:
        a, b = F.instr(output, second), F.instr(output, MIDDLE)
        width = len(first)
        one = F.substring(output, F.lit(width + 1), a - width - 1)
        two = F.substring(output, a + len(second), b - a - len(second))
        return body(one, two, F.substring(output, b + len(MIDDLE), F.length(output)))

    return (F.when(form == "psm", pieces(PREFIX, SUFFIX, lambda p, s, m: F.concat(p, m, s)))
            .when(form == "spm", pieces(SUFFIX, PREFIX, lambda s, p, m: F.concat(p, m, s)))
            .otherwise(output))
