"""Incremental ingest of landed payload files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from isobar.schemas import LANDED_SCHEMA, OBSERVATIONS
from isobar.sinks.upsert import upsert
from isobar.sources.payloads import parse_payloads, rejected_payloads

# Between copies of a key in one micro-batch the file landed last wins, then its
# name, then the text itself, so that a replayed batch chooses the same row.
ARRIVAL = ("landed_at", "landed_file", "raw")


def landed_stream(spark: SparkSession, landing: str, max_files: int | None = None, archive: str | None = None) -> DataFrame:
    """New JSON-lines files under ``landing``, each row with its arrival.

    With ``archive``, files of finished batches are moved there, so the folder listed at each trigger stays short.
    """
    reader = spark.readStream.schema(LANDED_SCHEMA)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if archive:
        reader = reader.option("cleanSource", "archive").option("sourceArchiveDir", archive)
    return reader.json(landing).select(
        "*",
        F.col("_metadata.file_modification_time").alias("landed_at"),
        F.col("_metadata.file_path").alias("landed_file"),
    )


def ingest(spark: SparkSession, landing: str, table: str, checkpoint: str, every: str | None = None,
           max_files: int | None = None, after: Callable[[DataFrame], None] | None = None,
           rejects: str | None = None, archive: str | None = None) -> StreamingQuery:
    """Upsert landed payloads into the observations at ``table``; later batches win.

    Without ``every`` all waiting files are processed and the query ends. A restart
    on the same ``checkpoint`` repeats an unfinished batch, which the upsert absorbs,
    and goes on with files that landed meanwhile. ``after`` gets
    every reading a batch brought, copies included, once they are stored, e.g. to refresh aggregates. Payloads that give no reading
    go to the parquet table ``rejects``, one directory for each batch.
    """
    def store(batch: DataFrame, number: int) -> None:
        rows = parse_payloads(batch, keep=ARRIVAL).persist()
        try:
            upsert(rows, table, OBSERVATIONS, ARRIVAL)
            if rejects:
                rejected_payloads(batch, keep=("landed_at", "landed_file")).write.mode("overwrite").parquet(f"{rejects}/batch={number}")
            if after is not None:
                after(rows)
        finally:
            rows.unpersist()

    writer = landed_stream(spark, landing, max_files, archive).writeStream.foreachBatch(store)
    return triggered(writer.option("checkpointLocation", checkpoint), every).start()


def triggered(writer: DataStreamWriter, every: str | None) -> DataStreamWriter:
    """Run at an interval such as ``10 minutes``, or once over everything waiting."""
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
