"""Live daily aggregates with watermarked state.

The state of a day lives until the watermark passes it, so readings later than
``delay`` do not count here. Where readings of any age must count, ingest them with
:func:`isobar.plans.jobs.run_ingest`: each batch then corrects the days it touches from the stored
readings, right after it has stored its own. Months and years come from partials there, too: a
stream cannot window them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from isobar.operators.rollups import day_summary
from isobar.plans.jobs import store_summary
from isobar.schemas import DAY_SUMMARY, PRECIPITATION_TOTALS
from isobar.streaming.ingest import triggered


def first_polls(observations: DataFrame, delay: str) -> DataFrame:
    """Each (city, datetime) once: the first to arrive, while within ``delay``."""
    timed = observations.withColumn("datetime", F.col("datetime").cast("timestamp"))
    return timed.withWatermark("datetime", delay).dropDuplicatesWithinWatermark(["city", "datetime"])


def keep_first_polls(observations: DataFrame, path: str, checkpoint: str, delay: str, every: str | None = None) -> StreamingQuery:
    """Append each (city, datetime) to the parquet files at ``path`` once, as it first arrives.

    A repeat inside ``delay`` meets the key's state, one behind the watermark is late: either is left out.
    So is a first arrival behind the watermark; the state of a key goes once the watermark passes it.
    The file sink lists finished files itself, so a repeated batch appends nothing twice.
    """
    writer = first_polls(observations, delay).writeStream.outputMode("append").format("parquet").option("path", path)
    return triggered(writer.option("checkpointLocation", checkpoint), every).start()


def live_days(observations: DataFrame, delay: str) -> DataFrame:
    """Daily statistics and precipitation of a stream, duplicates counted once."""
    return day_summary(first_polls(observations, delay))


def maintain_days(observations: DataFrame, root: str, checkpoint: str, delay: str, every: str | None = None) -> StreamingQuery:
    """Keep the daily summary and precipitation tables under ``root`` current from state alone.

    Nothing stored is read: this is the fast path, for a root of its own, and readings later than
    ``delay`` don't count. These tables hold the extremes of ``temp``.
    """
    def store(batch: DataFrame, _: int) -> None:
        batch.persist()
        try:
            store_summary(batch, root, DAY_SUMMARY, PRECIPITATION_TOTALS["day"])
        finally:
            batch.unpersist()

    writer = live_days(observations, delay).writeStream.outputMode("update").foreachBatch(store)
    return triggered(writer.option("checkpointLocation", checkpoint), every).start()
