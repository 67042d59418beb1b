"""What several operators share: table access, stored intermediate tables, positions among sorted boundaries."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from isobar.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder and read back: later jobs neither
    recompute them nor depend on the executors that made them."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def pieces(spark: SparkSession, per_partition: int = 4) -> int:
    """A number of key ranges that keeps every shuffle partition busy."""
    return per_partition * int(spark.conf.get("spark.sql.shuffle.partitions"))


def longs(values: Sequence[int]) -> Column:
    """A constant array of longs that stays one literal in the plan."""
    if not values:
        return F.array().cast("array<bigint>")
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")


def count_at_most(splits: Sequence[int], value: Column) -> Column:
    """How many of the ascending longs are <= ``value``; looked up in two levels."""
    if not splits:
        return F.lit(0)
    width = math.isqrt(len(splits)) + 1
    coarse = F.size(F.filter(longs(splits[::width]), lambda s: s <= value))
    base = F.greatest((coarse - 1) * width, F.lit(0))
    return base + F.size(F.filter(F.slice(longs(splits), base + 1, F.lit(width)), lambda s: s <= value))


def quantiles(df: DataFrame, key: str, n: int) -> list[int]:
    """Up to n - 1 ascending, distinct values that cut a long column in about equal parts."""
    if n < 2:
        return []
    row = df.agg(F.percentile_approx(key, [i / n for i in range(1, n)], max(10_000, 20 * n))).first()
    return sorted(set(row[0] or []))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def free_name(df: DataFrame, name: str) -> str:
    """The name, lengthened until the frame has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def bounded_batches(spark: SparkSession) -> None:
    """Arrow batches small enough that long texts don't fill a Python worker; the session keeps the setting."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def map_texts(df: DataFrame, prepare: Callable[[], Callable[[list[str]], list]], added: str,
              column: str = "text", keep: bool = False) -> DataFrame:
    """Add columns that Python computes from a text column, batch by batch; null texts count as empty.

    ``prepare`` runs once for each task and returns the function from a list of texts to the
    added columns' values. Other columns pass through unchanged; the text itself only with
    ``keep``; columns named like added ones are replaced.
    """
    bounded_batches(df.sparkSession)
    new = T._parse_datatype_string(added)
    rest = [f for f in df.schema.fields if f.name not in new.fieldNames() and (keep or f.name != column)]
    out = T.StructType([*rest, *new.fields])
    names, schema = [f.name for f in rest], to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compute = prepare()
        for batch in batches:
            texts = [t or "" for t in batch.column(column).to_pylist()]
            values = compute(texts)
            made = [pa.array(v, schema.field(len(names) + i).type) for i, v in enumerate(values)]
            yield pa.RecordBatch.from_arrays([*(batch.column(n).cast(schema.field(n).type) for n in names), *made], schema=schema)

    return df.select(*dict.fromkeys([*names, column])).mapInArrow(run, out)


def text_blocks(batches: Iterator[pa.RecordBatch], limit: int, column: str = "text") -> Iterator[tuple[list[bytes], pa.Table]]:
    """Consecutive rows of about ``limit`` bytes of text: the texts, null as empty, and a table of the other columns."""
    texts, kept, size = [], [], 0
    for batch in batches:
        rest, start = pa.Table.from_batches([batch.drop_columns([column])]), 0
        for i, text in enumerate(batch.column(column).cast(pa.binary()).to_pylist()):
            texts.append(text or b"")
            size += 1 + len(texts[-1])
            if size >= limit:
                yield texts, pa.concat_tables([*kept, rest.slice(start, i + 1 - start)])
                texts, kept, size, start = [], [], 0, i + 1
        if start < batch.num_rows:
            kept.append(rest.slice(start))
    if texts:
        yield texts, pa.concat_tables(kept)


def one_list(rows: pa.Table, kind: pa.DataType) -> pa.Array:
    """The table's rows as the one element of a list array of the given type."""
    structs = rows.to_struct_array()
    if isinstance(structs, pa.ChunkedArray):
        structs = pa.concat_arrays(structs.chunks) if structs.num_chunks else pa.array([], structs.type)
    return pa.ListArray.from_arrays(pa.array([0, len(structs)], pa.int32()), structs).cast(kind)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    return to_arrow_schema(schema)


def packed(values: np.ndarray, kind: str = "<u4") -> bytes:
    """Integers as compressed byte planes of a fixed-width type."""
    width = np.dtype(kind).itemsize
    planes = values.astype(kind).view(np.uint8).reshape(-1, width).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpacked(blob: bytes, kind: str = "<u4") -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8).reshape(np.dtype(kind).itemsize, -1)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """The rows, written once to the shared folder as one file for each bucket of ``key``: joins by it move only their other side."""
    spark, alias = df.sparkSession, f"{name}_{uuid.uuid4().hex}"
    df.repartition(buckets, key).write.option("path", scratch_path(spark, name)).option("compression", "zstd").bucketBy(
        buckets, key).saveAsTable(alias)
    found = spark.table(alias)
    found.schema  # resolved before the name goes; the files stay
    spark.sql(f"DROP TABLE {alias}")
    return found
