"""Whole jobs over a root folder holding one directory per table.

Run one with e.g. ``python -m isobar.plans.jobs rollup --root <path>``.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from isobar.functions.temporal import bucket, floor_to, next_period, period_range
from isobar.operators.rollups import (
    PERIOD, PRECIPITATION_COLUMNS, STATISTICS_COLUMNS, coarser_partials, day_summary, partials, summary_from_partials,
    with_extremes_of_temp,
)
from isobar.operators.series import trend
from isobar.schemas import (
    DAILY_PARTIALS, DAY_SUMMARY, HOURLY_PARTIALS, KEY, LATEST, MONTHLY_PARTIALS, OBSERVATIONS, PARTITION,
    PRECIPITATION_TOTALS, STATISTICS, TableSpec,
)
from isobar.session import configure
from isobar.sinks.upsert import read_parts, read_stored, recover, replace, upsert
from isobar.sources.payloads import rows_from_documents
from isobar.streaming.ingest import ingest

FEW = 200_000  # keys whose cities Spark can broadcast
WRITERS = 3  # tables written at a time beside the one that the next grain is computed from

AGGREGATES = (HOURLY_PARTIALS, DAILY_PARTIALS, MONTHLY_PARTIALS, DAY_SUMMARY, *STATISTICS.values(), *PRECIPITATION_TOTALS.values())


def table_path(root: str, spec: TableSpec) -> str:
    return f"{root.rstrip('/')}/{spec.name}"


def insert_documents(documents: DataFrame, root: str, rank: Sequence[str],
                     spec: TableSpec = OBSERVATIONS, column: str = "doc") -> list:
    """Insert JSON documents as rows of a table; ``rank`` columns stand beside the text."""
    rows = rows_from_documents(documents, spec.schema, column, keep=rank)
    return upsert(rows, table_path(root, spec), spec, rank)


def process_day(spark: SparkSession, root: str, instant: datetime,
                cities: DataFrame | Sequence[str] | None = None) -> None:
    """Both daily results of the day holding ``instant``, for some or all cities.

    One scan of one day's directories feeds both tables. The extremes are those of ``temp``
    and so have their own table, beside the one with those of the readings' own ``temp_min`` and
    ``temp_max``; :func:`rollup` and :func:`refresh` keep both.
    """
    start, end = period_range("day", instant)
    observations = read_stored(spark, table_path(root, OBSERVATIONS), OBSERVATIONS, start, end)
    summary = day_summary(observations, cities).persist()
    try:
        store_summary(summary, root, DAY_SUMMARY, PRECIPITATION_TOTALS["day"])
    finally:
        summary.unpersist()


def store_summary(summary: DataFrame, root: str, statistics: TableSpec, precipitation: TableSpec,
                  write: Callable[[DataFrame, str, TableSpec], object] | None = None) -> None:
    """Write a frame that holds statistics and precipitation to its two tables."""
    write = write or (lambda df, path, spec: upsert(df, path, spec, rank=[]))
    for columns, spec in ((STATISTICS_COLUMNS, statistics), (PRECIPITATION_COLUMNS, precipitation)):
        write(summary.select(*columns), table_path(root, spec), spec)


def rollup(spark: SparkSession, root: str) -> None:
    """All aggregate tables anew: the readings are scanned once, each grain's partials once."""
    path = lambda spec: table_path(root, spec)
    for spec in (OBSERVATIONS, *AGGREGATES):
        recover(spark, path(spec))
    replace(partials(read_stored(spark, path(OBSERVATIONS), OBSERVATIONS), "hour"), path(HOURLY_PARTIALS), HOURLY_PARTIALS)
    hours = read_stored(spark, path(HOURLY_PARTIALS), HOURLY_PARTIALS)
    replace(coarser_partials(hours, "day"), path(DAILY_PARTIALS), DAILY_PARTIALS)
    days = read_stored(spark, path(DAILY_PARTIALS), DAILY_PARTIALS)
    replace(coarser_partials(days, "month"), path(MONTHLY_PARTIALS), MONTHLY_PARTIALS)
    months = read_stored(spark, path(MONTHLY_PARTIALS), MONTHLY_PARTIALS)
    for grain, finer in (("day", days), ("month", months), ("year", months)):
        store_grain(summary_from_partials(finer, grain), root, grain, replace)


def store_grain(summary: DataFrame, root: str, grain: str,
                write: Callable[[DataFrame, str, TableSpec], object] | None = None) -> None:
    """Write a grain's statistics and precipitation, for days both kinds of statistics."""
    summary = summary.persist()
    try:
        _store_grain(summary, root, grain, write or (lambda df, path, spec: upsert(df, path, spec, rank=[])))
    finally:
        summary.unpersist()


def _store_grain(summary: DataFrame, root: str, grain: str, write: Callable[[DataFrame, str, TableSpec], object]) -> None:
    store_summary(summary, root, STATISTICS[grain], PRECIPITATION_TOTALS[grain], write)
    if grain == "day":
        write(with_extremes_of_temp(summary).select(*STATISTICS_COLUMNS), table_path(root, DAY_SUMMARY), DAY_SUMMARY)


def refresh(spark: SparkSession, root: str, changed: DataFrame) -> None:
    """Bring the aggregate tables up to date after readings of some (city, datetime) changed.

    Only the changed cities' hours are recomputed from the readings, then their days from the
    hour partials, and so on up to years, however long ago the readings were. What is read is the
    directories that hold them, what is rewritten the directories of the results. The tables are
    those of :func:`rollup`; partials must be complete, so the first batches go into an empty root
    or a roll-up comes first.
    """
    path = lambda spec: table_path(root, spec)
    hours = changed.select("city", bucket(changed, "hour").alias("datetime")).distinct().persist()
    held: list[DataFrame] = [hours]

    def of(source: TableSpec, grain: str) -> DataFrame:
        """Stored rows of the changed cities in their changed periods of ``grain``, with these as ``PERIOD``."""
        touched = hours if grain == "hour" else hours.select("city", bucket(hours, grain).alias("datetime")).distinct()
        rows = read_parts(spark, path(source), source, _directories(source, grain, sorted({floor_to(grain, at) for at in names})))
        rows = rows.withColumn(PERIOD, bucket(rows, grain))
        return rows.join(touched.withColumnRenamed("datetime", PERIOD), ["city", PERIOD], "left_semi").drop(PARTITION)

    def keep(df: DataFrame) -> DataFrame:
        held.append(df.persist())
        return df

    def store(df: DataFrame, at: str, spec: TableSpec) -> None:
        upsert(df, at, spec, rank=[], kept=True)

    # No later step reads the results of a grain, so their tables are written while the next grain is computed.
    writers, writing = ThreadPoolExecutor(WRITERS), []
    beside = lambda df, at, spec: writing.append(writers.submit(inheritable_thread_target(spark)(store), df, at, spec))
    try:
        names = [r[0] for r in hours.select("datetime").distinct().collect() if r[0]]  # one for each hour
        if not names:
            return
        upsert(partials(of(OBSERVATIONS, "hour"), "hour"), path(HOURLY_PARTIALS), HOURLY_PARTIALS, rank=[])
        fresh = keep(coarser_partials(of(HOURLY_PARTIALS, "day"), "day"))
        store(fresh, path(DAILY_PARTIALS), DAILY_PARTIALS)
        _store_grain(keep(summary_from_partials(fresh.withColumn(PERIOD, F.col("datetime")), "day")), root, "day", beside)
        months = keep(coarser_partials(of(DAILY_PARTIALS, "month"), "month"))
        store(months, path(MONTHLY_PARTIALS), MONTHLY_PARTIALS)
        _store_grain(keep(summary_from_partials(months.withColumn(PERIOD, F.col("datetime")), "month")), root, "month", beside)
        _store_grain(keep(summary_from_partials(of(MONTHLY_PARTIALS, "year"), "year")), root, "year", beside)
        for written in writing:
            written.result()
    finally:
        writers.shutdown()
        for df in held:
            df.unpersist()


def _directories(spec: TableSpec, grain: str, periods: Sequence[datetime]) -> set[date | str]:
    """Directories of a table that can hold rows of whole periods of ``grain``."""
    found = set()
    for start in periods:
        at, end = floor_to(spec.grain, start), next_period(grain, start)
        while at < end:
            found.add(spec.part(at))
            at = next_period(spec.grain, at)
    return found


def store_latest(readings: DataFrame, root: str) -> None:
    """Keep the newest reading of each city, as :func:`isobar.operators.series.latest` chooses it.

    A stored reading yields only to a newer one, of equal times to that of the greater other values,
    so batches may come in any order and again. Readings without a time or city have no place.
    """
    timed = readings.where("city IS NOT NULL AND datetime IS NOT NULL")
    order = ["datetime", *(c for c in LATEST.columns if c not in KEY)]
    upsert(timed, table_path(root, LATEST), LATEST, rank=order, newer=order)


def refresh_trends(spark: SparkSession, root: str, changed: DataFrame, measures: Sequence[str], spec: TableSpec) -> None:
    """Bring stored trends up to date after readings of some (city, datetime) changed and :func:`refresh` has run.

    A reading changes its own row and that of its successor, however far away, and no other: only
    these are written. Which hours hold the neighbours is looked up in the hour partials of the
    days around, beyond those in the day partials; of the readings only these hours are read.
    """
    path = lambda s: table_path(root, s)
    keys = changed.select(*KEY).where("city IS NOT NULL AND datetime IS NOT NULL").distinct().persist()
    held = [keys]
    try:
        counts = keys.groupBy(bucket(keys, "hour").alias("_hour")).count().collect()  # one row for each hour
        if not counts:
            return
        own = {r[0] for r in counts}
        around = _hours_around(spark, root, keys, own, sum(r[1] for r in counts) <= FEW, held)
        held.append(around.persist())
        names = own | {r[0] for r in around.select("_hour").distinct().collect()}  # one for each hour
        rows = read_parts(spark, path(OBSERVATIONS), OBSERVATIONS, [OBSERVATIONS.part(at) for at in names])
        named = {m.replace(".", "_"): m for m in measures}
        # Readings, changed keys and hours around them meet by city and day, as the trend needs them: one shuffle, no join.
        values = [F.col(m).alias(name) for name, m in named.items()]
        blank = [F.lit(None).cast(f.dataType).alias(f.name) for f in rows.select(*values).schema]
        met = (rows.select(*KEY, *values, F.lit(0).alias("_kind"))
               .unionByName(keys.select(*KEY, *blank, F.lit(2).alias("_kind")))
               .unionByName(around.select("city", F.col("_hour").alias("datetime"), *blank, F.lit(1).alias("_kind"))))
        met = met.withColumns({"_day": bucket(met, "day"), "_hour": bucket(met, "hour")}).repartition("city", "_day")
        kind = lambda *by: F.max("_kind").over(Window.partitionBy("city", "_day", "_hour", *by))
        marked = met.withColumn("_mark", (kind("datetime") == 2).cast("int")).withColumn("_wanted", kind() > 0)
        trends = trend(marked.where("_kind = 0 AND _wanted"), {**{name: name for name in named}, "_changed": F.col("_mark")}, day="_day")
        changes = (F.col("_changed") == 1) | (F.col("_changed") - F.col("_changed_delta") == 1)
        upsert(trends.where(changes), path(spec), spec, rank=[])
    finally:
        for df in held:
            df.unpersist()


def _hours_around(spark: SparkSession, root: str, keys: DataFrame, own: Iterable[datetime], few: bool, held: list[DataFrame]) -> DataFrame:
    """city and _hour: the nearest hours before and after those of the keys that hold readings of the city, as far as no key lies in them.

    ``own`` are the hours of the keys, which are ``few`` if their cities are worth a join before
    stored hours are shuffled. Frames that are kept for the result join ``held``; hours may repeat.
    """
    day = timedelta(days=1)
    cities = keys.select("city").distinct()
    near = {at + i * day for at in {floor_to("day", at) for at in own} for i in (-1, 0, 1)}

    def keep(df: DataFrame) -> DataFrame:
        held.append(df.persist())
        return df

    def of_cities(df: DataFrame) -> DataFrame:
        return df.join(cities, "city", "left_semi") if few else df

    def filled(days: Iterable[datetime]) -> DataFrame:
        found = read_parts(spark, table_path(root, HOURLY_PARTIALS), HOURLY_PARTIALS, _directories(HOURLY_PARTIALS, "day", list(days)))
        return of_cities(found.select("city", F.col("datetime").alias("_hour")))

    # Hours of the keys and stored ones meet by city: the shuffle that the window needs serves for both.
    hours = keys.select("city", bucket(keys, "hour").alias("_hour"), F.lit(True).alias("_own"))
    met = filled(near).withColumn("_own", F.lit(False)).unionByName(hours).repartition("city")
    both = met.groupBy("city", "_hour").agg(F.bool_or("_own").alias("_own"), F.bool_or(~F.col("_own")).alias("_stored")).where("_stored")
    by_city = Window.partitionBy("city").orderBy("_hour")  # hours of the few days, not readings
    beside = F.struct("_hour", "_own")
    linked = both.select("city", "_hour", "_own", F.lag(beside).over(by_city).alias("_before"), F.lead(beside).over(by_city).alias("_after"))
    to_day = lambda c: F.date_trunc("day", c)
    # A neighbour more than a day off may have others between, in days that were not read.
    linked = linked.where("_own").select(
        "city", "_hour",
        F.when(to_day(F.col("_hour")) - to_day(F.col("_before._hour")) <= F.expr("INTERVAL 1 DAY"), F.col("_before")).alias("_before"),
        F.when(to_day(F.col("_after._hour")) - to_day(F.col("_hour")) <= F.expr("INTERVAL 1 DAY"), F.col("_after")).alias("_after"))
    linked = keep(linked.where("_before IS NULL OR _after IS NULL OR NOT _before._own OR NOT _after._own"))
    found = linked.select("city", F.explode(F.array("_before", "_after")).alias("_beside")).where("NOT _beside._own").select("city", "_beside._hour")
    open_ = linked.where("_before IS NULL OR _after IS NULL")
    if open_.isEmpty():
        return found
    days = read_stored(spark, table_path(root, DAILY_PARTIALS), DAILY_PARTIALS)
    days = of_cities(days.select("city", F.col("datetime").alias("_day")))
    # The last stored day before an open hour's and the first one after it, over one row for each city and day.
    asked = open_.select("city", to_day("_hour").alias("_day"), F.lit(True).alias("_open"))
    listed = days.withColumn("_open", F.lit(False)).unionByName(asked).repartition("city").groupBy("city", "_day").agg(
        F.bool_or("_open").alias("_open"), F.bool_or(~F.col("_open")).alias("_stored"))
    stored = F.when(F.col("_stored"), F.col("_day"))
    earlier = lambda order: Window.partitionBy("city").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    far = listed.select("city", "_open", F.max(stored).over(earlier(F.asc("_day"))).alias("_back"),
                        F.min(stored).over(earlier(F.desc("_day"))).alias("_on")).where("_open")
    wanted = keep(far.select("city", F.explode(F.array("_back", "_on")).alias("_day")).where("_day IS NOT NULL").distinct())
    others = filled(r[0] for r in wanted.select("_day").distinct().collect())
    others = others.withColumn("_day", to_day(F.col("_hour"))).join(wanted, ["city", "_day"], "left_semi").groupBy("city", "_day").agg(
        F.min("_hour").alias("_first"), F.max("_hour").alias("_last"))
    return found.unionByName(others.select("city", F.explode(F.array("_first", "_last")).alias("_hour")))


def run_ingest(spark: SparkSession, landing: str, root: str, checkpoint: str, every: str | None = None,
               max_files: int | None = None, archive: str | None = None, trends: TableSpec | None = None,
               measures: Sequence[str] = ("temp", "pressure")):
    """Stream landed payloads into the readings, the latest ones, and the aggregates of each batch; with ``trends`` into that table, too.

    Everything is done in the batch that brings a reading, after its upsert: there is no second
    stream, and a batch that fails in between is repeated whole, which changes nothing twice.
    """
    def after(readings: DataFrame) -> None:
        refresh(spark, root, readings)
        store_latest(readings, root)
        if trends is not None:
            refresh_trends(spark, root, readings, measures, trends)

    return ingest(spark, landing, table_path(root, OBSERVATIONS), checkpoint, every, max_files, after=after,
                  rejects=f"{root.rstrip('/')}/rejected_payloads", archive=archive)


def main(argv: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)
    landing = commands.add_parser("ingest", help="upsert landed payload files and refresh aggregates")
    landing.add_argument("--landing", required=True)
    landing.add_argument("--checkpoint", required=True)
    landing.add_argument("--archive", help="where files go once they are processed; they stay by default")
    landing.add_argument("--every", help="interval such as '10 minutes'; once by default")
    commands.add_parser("rollup", help="recompute every aggregate table")
    day = commands.add_parser("day", help="daily tables of one day")
    day.add_argument("--date", type=datetime.fromisoformat, help="today (UTC) by default")
    day.add_argument("--city", action="append", help="repeat for several; all cities by default")
    for command in commands.choices.values():
        command.add_argument("--root", required=True)
    args = parser.parse_args(argv)

    spark = configure(SparkSession.builder.appName("isobar").getOrCreate())
    if args.command == "ingest":
        run_ingest(spark, args.landing, args.root, args.checkpoint, args.every, archive=args.archive).awaitTermination()
    elif args.command == "rollup":
        rollup(spark, args.root)
    else:
        process_day(spark, args.root, args.date or datetime.now(timezone.utc), args.city)


if __name__ == "__main__":
    main()
