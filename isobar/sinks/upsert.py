"""Keyed upsert into a partitioned parquet table.

Parquet has no MERGE, so the directories a batch touches are read, merged and written anew by
Spark's dynamic partition overwrite: tasks write beside the table, and the old files of a
directory stay until the job commits. Only touched directories are opened and listed, so the
cost follows the batch, not the table. One writer at a time.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from isobar.functions.temporal import in_period
from isobar.operators.merging import last_write, merge, merge_newer
from isobar.schemas import PARTITION, TableSpec
from isobar.session import require_utc
from isobar.sinks.files import Folder

STAGING = ".spark-staging"  # fixed value: where Spark's dynamic overwrite keeps new directories until it commits
LAYOUT = "_layout="  # hidden from Spark's own reads of the table
PLACED_ROWS = 200_000  # a larger batch meets the stored rows where they are written; keys of a smaller one can be broadcast
PIECE_ROWS = 250_000  # of a directory, in one task and file
COPIES = 1.2  # rows for each key from which on copies are dropped before the shuffle
STATEMENT_PARTITIONS = 500  # partitions named in one catalog statement; more take several


def read_stored(spark: SparkSession, path: str, spec: TableSpec, start: datetime | None = None,
                end: datetime | None = None, with_partition: bool = False) -> DataFrame:
    """Read an upserted table whole, or rows in ``[start, end)`` from the directories that can hold them."""
    folder = Folder(spark, path)
    names = folder.directories(f"{PARTITION}=")
    if not names and not folder.has(""):
        raise FileNotFoundError(f"no table at {path}")
    if spec.grain:
        low = _name(spec.part(start)) if start is not None else ""
        high = _name(spec.part(end)) if end is not None else "~"
        names = [n for n in names if low <= n <= high]
    df = _opened(spark, path, spec, names)
    if spec.grain:
        df = in_period(df, start, end)
    return df if with_partition else df.drop(PARTITION)


def read_parts(spark: SparkSession, path: str, spec: TableSpec, parts: Iterable[date | int | str]) -> DataFrame:
    """Rows of the named directories, with their partition column; those that don't exist have none."""
    return _opened(spark, path, spec, _present(spark, path, parts))


def upsert(batch: DataFrame, path: str, spec: TableSpec, rank: Sequence[str], table: str | None = None,
           newer: Sequence[str] | None = None, kept: bool = False) -> list[date | int | str]:
    """Insert or replace the batch's rows by key and return the touched directories.

    ``rank`` names the columns that decide between copies of a key inside the batch
    (greatest wins); they need not be stored. Pass an empty list only for a batch
    whose keys are unique, such as an aggregate grouped by them. Rows already
    stored yield to the batch, so repeating a batch changes nothing; with ``newer``,
    stored columns, they yield only to a row that is greater by these.
    ``table`` names a catalog table over the path, which is told of new directories.
    A batch is kept while it is read twice; ``kept`` says that the caller does so.
    """
    spark = batch.sparkSession
    require_utc(spark)
    recover(spark, path)
    rows, order = _shaped(batch, spec, rank)
    held = [] if kept or batch.storageLevel.useMemory else [rows.persist()]
    try:
        # One row for each directory, which the driver has to name to open it.
        touched = rows.groupBy(PARTITION).agg(
            F.bool_or(_keyless(spec)).alias("keyless"), F.count("*").alias("n"),
            F.approx_count_distinct(F.xxhash64(*spec.keys)).alias("keys")).collect()
        if not touched:
            return []
        if any(r.keyless for r in touched):
            raise ValueError(f"null in the key {spec.keys} of {spec.name}")
        parts = sorted(r[PARTITION] for r in touched)
        _check_layout(spark, path, spec)
        names = _present(spark, path, parts)
        stored = _opened(spark, path, spec, names) if names else None
        n, copies = sum(r.n for r in touched), sum(r.n for r in touched) > COPIES * sum(r["keys"] for r in touched)
        if rank and not newer and not copies and n > PLACED_ROWS:
            _write_placed(rows, order, stored, {r[PARTITION]: r.n for r in touched}, path, spec)
        else:
            if rank:  # copies of a key shrink before they are shuffled; the keys of a small batch are broadcast
                rows = last_write(rows, spec.keys, order).select(*spec.columns, PARTITION)
                if stored is not None:
                    held.append(rows.persist())
            if stored is not None:
                rows = merge_newer(stored, rows, spec.keys, newer) if newer else merge(stored, rows, spec.keys)
            _write(rows, path, spec)
        if table:
            _tell_catalog(spark, table, spec, [_name(p) for p in parts])
        return parts
    finally:
        for df in held:
            df.unpersist()


def replace(df: DataFrame, path: str, spec: TableSpec, table: str | None = None) -> None:
    """Write a whole table anew; its keys must be unique. Until the new rows are complete the old ones stay.

    Directories without new rows go last; after a driver lost before that, repeating the call drops them.
    """
    spark = df.sparkSession
    require_utc(spark)
    recover(spark, path)
    _check_layout(spark, path, spec)
    written = Observation()
    shaped = _shaped(df, spec)[0].observe(written, F.collect_set(F.col(PARTITION).cast("string")).alias("parts"))
    _write(shaped, path, spec)
    folder, new = Folder(spark, path), {_name(p) for p in written.get["parts"] or []}
    for name in set(folder.directories(f"{PARTITION}=")) - new:
        folder.remove(name)
    spark.catalog.refreshByPath(path)
    if table:
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
        _tell_catalog(spark, table, spec, sorted(new))


def recover(spark: SparkSession, path: str) -> None:
    """Put right what a driver lost while Spark committed has left; harmless at any other time but during a write.

    Spark deletes a directory and moves the new one, which is complete by then, to its place. One
    lost between the two is moved now; whatever else was staged belongs to a write that is repeated.
    """
    folder = Folder(spark, path)
    for staging in folder.directories(STAGING):
        for name in Folder(spark, f"{path}/{staging}").directories(f"{PARTITION}="):
            if not folder.has(name):
                folder.restore(f"{staging}/{name}", name)
        folder.remove(staging)


def _name(part: date | int | str) -> str:
    return f"{PARTITION}={part}"


def _present(spark: SparkSession, path: str, parts: Iterable[date | int | str]) -> list[str]:
    folder = Folder(spark, path)
    return [n for n in sorted({_name(p) for p in parts}) if folder.has(n)]


def _shaped(df: DataFrame, spec: TableSpec, rank: Sequence[str] = ()) -> tuple[DataFrame, list[str]]:
    """The stored columns, and the names of those that hold ``rank``: stored ones or, where they differ, columns beside them."""
    typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in spec.schema.fields]
    as_it_is = {f.name for f in spec.schema.fields if f.name in df.columns and df.schema[f.name].dataType == f.dataType}
    order = [c if c in as_it_is else f"_rank{i}" for i, c in enumerate(rank)]
    rows = df.select(*typed, *[F.col(c).alias(o) for c, o in zip(rank, order) if o != c])
    return rows.withColumn(PARTITION, spec.partition(rows)), order


def _opened(spark: SparkSession, path: str, spec: TableSpec, names: Sequence[str]) -> DataFrame:
    if not names:
        return spark.createDataFrame([], spec.stored_schema)
    return spark.read.schema(spec.stored_schema).option("basePath", path).parquet(*[f"{path}/{n}" for n in names])


def _check_layout(spark: SparkSession, path: str, spec: TableSpec) -> None:
    """The directories' rule is part of a stored table: another one would put a key in two places."""
    folder, layout = Folder(spark, path), f"{spec.grain or spec.buckets}"
    known = folder.directories(LAYOUT)
    if not known:
        folder.mark(f"{LAYOUT}{layout}")
    elif known != [f"{LAYOUT}{layout}"]:
        raise ValueError(f"{path} is laid out by {known[0].removeprefix(LAYOUT)}, not {layout}")


def _write(df: DataFrame, path: str, spec: TableSpec) -> None:
    # Rebalancing sizes files by bytes: adaptive execution splits a large
    # directory over tasks and joins small ones, whatever city dominates it.
    _write_files(df.hint("rebalance", PARTITION), path, spec)


def _write_files(df: DataFrame, path: str, spec: TableSpec) -> None:
    (df.sortWithinPartitions(PARTITION, *spec.sort_columns())
       .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").options(**spec.file_options)
       .partitionBy(PARTITION).parquet(path))
    df.sparkSession.catalog.refreshByPath(path)  # frames cached over the old files


def _write_placed(rows: DataFrame, order: Sequence[str], stored: DataFrame | None, counts: dict, path: str, spec: TableSpec) -> None:
    """Merge and write a large batch in one shuffle, which brings batch and stored rows to the task that writes them.

    A directory is cut into pieces by its keys' hash, about ``PIECE_ROWS`` rows each, so a piece holds all rows of its keys.
    """
    rows = rows.withColumn("_new", F.lit(True))
    if stored is not None:
        for r in stored.groupBy(PARTITION).count().collect():  # one row for each directory
            counts[r[PARTITION]] = counts.get(r[PARTITION], 0) + r["count"]
        rows = rows.unionByName(stored.withColumn("_new", F.lit(False)), allowMissingColumns=True)
    spark, total = rows.sparkSession, sum(counts.values())
    pieces = -(-max(counts.values()) // PIECE_ROWS)
    tasks = -(-total // PIECE_ROWS)
    more = [tasks] if tasks > int(spark.conf.get("spark.sql.shuffle.partitions")) else []  # else adaptive execution joins small ones
    placed = rows.withColumn("_piece", F.pmod(F.xxhash64(*spec.keys), F.lit(pieces))).repartition(*more, PARTITION, "_piece")
    best = last_write(placed, [PARTITION, "_piece", *spec.keys], ["_new", *order]).select(*spec.columns, PARTITION)
    _write_files(best, path, spec)


def _tell_catalog(spark: SparkSession, table: str, spec: TableSpec, names: Sequence[str]) -> None:
    for i in range(0, len(names), STATEMENT_PARTITIONS):
        value = lambda n: n if spec.grain is None else f"'{n}'" if spec.grain == "hour" else f"DATE'{n}'"
        parts = " ".join(f"PARTITION ({PARTITION}={value(n.partition('=')[2])})" for n in names[i:i + STATEMENT_PARTITIONS])
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS {parts}")
    spark.catalog.refreshTable(table)


def _keyless(spec: TableSpec) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in spec.keys])
