"""Daily, monthly and yearly statistics per city.

Averages of a month or year weigh every reading equally, so coarser grains are
built from mergeable day partials (sum, count, min, max), never from averages.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from isobar.functions.readings import total_precipitation
from isobar.functions.temporal import bucket, in_period
from isobar.sources.tables import of_cities

STATISTICS_COLUMNS = ("city", "datetime", "avg_pressure", "avg_temp", "temp_min", "temp_max")
PRECIPITATION_COLUMNS = ("city", "datetime", "sum_precipitation")
PERIOD = "_period"  # holds the start of a row's period, in frames that have such a column


def day_summary(df: DataFrame, cities: DataFrame | Sequence[str] | None = None,
                start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Both daily results by tumbling one-day window, in one scan and one shuffle.

    Here ``temp_min`` and ``temp_max`` are the extremes of ``temp`` itself. The
    choice of cities is stated on the result: Catalyst moves a list or a frame small
    enough to broadcast down to the scan, and a larger frame meets one row per city
    and day instead of a hot city's readings.
    """
    rows = in_period(df, start, end).filter(F.col("datetime").isNotNull())
    summary = (
        rows.groupBy("city", F.window("datetime", "1 day"))
        .agg(
            F.avg("pressure").alias("avg_pressure"),
            F.avg("temp").alias("avg_temp"),
            F.min("temp").alias("temp_min"),
            F.max("temp").alias("temp_max"),
            F.sum(total_precipitation()).alias("sum_precipitation"),
        )
        .select("city", F.col("window.start").alias("datetime"), *STATISTICS_COLUMNS[2:], "sum_precipitation")
    )
    return summary if cities is None else of_cities(summary, cities)


def daily_weather(df: DataFrame, cities: DataFrame | Sequence[str] | None = None,
                  start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Daily pressure and temperature per city."""
    return day_summary(df, cities, start, end).select(*STATISTICS_COLUMNS)


def daily_precipitation(df: DataFrame, cities: DataFrame | Sequence[str] | None = None,
                        start: datetime | None = None, end: datetime | None = None) -> DataFrame:
    """Daily rain plus snow per city."""
    return day_summary(df, cities, start, end).select(*PRECIPITATION_COLUMNS)


def statistics(df: DataFrame, grain: str) -> DataFrame:
    """Statistics per city and calendar period, straight from the readings.

    Here the extremes are those of the readings' own ``temp_min`` and ``temp_max``.
    """
    return (
        _by_period(df, grain)
        .agg(
            F.avg("pressure").alias("avg_pressure"),
            F.avg("temp").alias("avg_temp"),
            F.min("temp_min").alias("temp_min"),
            F.max("temp_max").alias("temp_max"),
        )
        .select(*STATISTICS_COLUMNS)
    )


def precipitation(df: DataFrame, grain: str) -> DataFrame:
    """Rain plus snow per city and calendar period, straight from the readings."""
    return _by_period(df, grain).agg(F.sum(total_precipitation()).alias("sum_precipitation"))


def daily_partials(df: DataFrame) -> DataFrame:
    """Mergeable day partials."""
    return partials(df, "day")


def partials(df: DataFrame, grain: str) -> DataFrame:
    """Mergeable partials of hours or days: the only pass over the readings a full roll-up needs.

    ``temp_min`` and ``temp_max`` are the extremes of the readings' own, ``low`` and ``high`` those of ``temp``.
    """
    return _by_period(df, grain).agg(
        F.count(F.lit(1)).alias("n"),
        F.sum("temp").alias("temp_sum"),
        F.count("temp").alias("temp_count"),
        F.sum("pressure").alias("pressure_sum"),
        F.count("pressure").alias("pressure_count"),
        F.min("temp_min").alias("temp_min"),
        F.max("temp_max").alias("temp_max"),
        F.min("temp").alias("low"),
        F.max("temp").alias("high"),
        F.sum(total_precipitation()).alias("sum_precipitation"),
    )


def statistics_from_partials(partials: DataFrame, grain: str) -> DataFrame:
    """Statistics of any grain from day partials."""
    return _by_period(partials, grain).agg(*_merge_statistics()).select(*STATISTICS_COLUMNS)


def precipitation_from_partials(partials: DataFrame, grain: str) -> DataFrame:
    """Precipitation totals of any grain from day partials."""
    return _by_period(partials, grain).agg(F.sum("sum_precipitation").alias("sum_precipitation"))


def summary_from_partials(partials: DataFrame, grain: str) -> DataFrame:
    """Statistics and precipitation of any grain from finer partials, in one aggregation; ``low`` and ``high`` besides."""
    return _by_period(partials, grain).agg(*_merge_statistics(), F.min("low").alias("low"), F.max("high").alias("high"),
                                           F.sum("sum_precipitation").alias("sum_precipitation"))


def with_extremes_of_temp(summary: DataFrame) -> DataFrame:
    """A summary from partials whose extremes are those of ``temp`` itself, as in :func:`day_summary`."""
    return summary.withColumns({"temp_min": F.col("low"), "temp_max": F.col("high")})


def coarser_partials(partials: DataFrame, grain: str) -> DataFrame:
    """Partials of a coarser grain: a year over months reads 12 rows per city."""
    sums = ("n", "temp_sum", "temp_count", "pressure_sum", "pressure_count")
    return _by_period(partials, grain).agg(
        *[F.sum(c).alias(c) for c in sums], F.min("temp_min").alias("temp_min"), F.max("temp_max").alias("temp_max"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("sum_precipitation").alias("sum_precipitation"))


def all_grains(df: DataFrame) -> DataFrame:
    """Day, month and year in one frame with a ``grain`` column.

    Grouping sets repeat every input row per set, so they run over the day
    partials; the readings are aggregated once.
    """
    return all_grains_from_partials(daily_partials(df))


def all_grains_from_partials(partials: DataFrame) -> DataFrame:
    keyed = partials.select(
        "city",
        F.col("datetime").alias("_day"),
        bucket(partials, "month").alias("_month"),
        bucket(partials, "year").alias("_year"),
        *[c for c in partials.columns if c not in ("city", "datetime")],
    )
    city, day, month, year = (F.col(c) for c in ("city", "_day", "_month", "_year"))
    grouped = keyed.groupingSets([[city, day], [city, month], [city, year]], city, day, month, year).agg(
        # Bits of the id, left to right, mark which of (city, day, month, year) is rolled up.
        F.grouping_id().alias("_set"),
        *_merge_statistics(),
        F.sum("sum_precipitation").alias("sum_precipitation"),
    )
    by_set = lambda at_day, at_month, at_year: (
        F.when(F.col("_set") == 3, at_day).when(F.col("_set") == 5, at_month).otherwise(at_year)
    )
    return grouped.select(
        by_set(F.lit("day"), F.lit("month"), F.lit("year")).alias("grain"),
        "city",
        by_set(day, month, year).alias("datetime"),
        *STATISTICS_COLUMNS[2:],
        "sum_precipitation",
    )


def _by_period(df: DataFrame, grain: str):
    # A period that rows were joined by is not derived again, or they would be shuffled again.
    start = F.col(PERIOD) if PERIOD in df.columns else bucket(df, grain)
    return df.filter(F.col("datetime").isNotNull()).groupBy("city", start.alias("datetime"))


def _merge_statistics() -> list[Column]:
    return [
        F.try_divide(F.sum("pressure_sum"), F.sum("pressure_count")).alias("avg_pressure"),
        F.try_divide(F.sum("temp_sum"), F.sum("temp_count")).alias("avg_temp"),
        F.min("temp_min").alias("temp_min"),
        F.max("temp_max").alias("temp_max"),
    ]
