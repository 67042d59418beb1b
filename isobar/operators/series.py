"""Newest readings, histories and trends per city."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from isobar.functions.temporal import bucket


def newest(df: DataFrame, n: int) -> DataFrame:
    """The ``n`` newest readings of each city; of equal times the greater other values come first.

    A first cut per city and day bounds what meets for a city to ``n`` rows for each of its days.
    """
    by_day = _first_rows(df.withColumn("_day", bucket(df, "day")), ("city", "_day"), n).drop("_day")
    return _first_rows(by_day, ("city",), n)


def latest(df: DataFrame) -> DataFrame:
    """Current conditions: the newest reading of each city; of equal times the one of the greatest other values.

    The newest time per city is found over two columns by hash aggregation; only rows of that
    time are then looked at whole.
    """
    newest_time = df.groupBy("city").agg(F.max("datetime").alias("datetime"))
    return _first_rows(df.join(newest_time, ["city", "datetime"], "left_semi"), ("city",), 1)


def history(df: DataFrame) -> DataFrame:
    """Readings by city, newest first (range-partitioned, so a hot city is split by time)."""
    return df.orderBy("city", F.desc("datetime"))


def trend(df: DataFrame, measures: Sequence[str] | Mapping[str, Column | str], day: str | None = None) -> DataFrame:
    """Each reading with the change of its measures since the city's previous one.

    ``measures`` are columns, nested ones like ``wind.speed`` included (named wind_speed), or
    names with their columns. Rows without a time have no place in a series and are left out.

    A plain window over the city would put a hot city into one task. Rows are
    windowed per (city, day) instead; the first row of a day takes its predecessor
    from the city's last earlier day, found over one row per city and day of the same
    windowed rows. With (city, second) as key a day holds 86,400 rows at most. ``day`` names a column
    that holds the reading's day: over a table bucketed and sorted by city and this column, the
    readings are then not shuffled at all. There, readings without a city are followed within a day only.
    """
    named = dict(measures) if isinstance(measures, Mapping) else {m.replace(".", "_"): m for m in measures}
    reading = F.struct(*[(F.col(c) if isinstance(c, str) else c).alias(name) for name, c in named.items()])
    series = df.where(F.col("datetime").isNotNull()).select(
        "city", "datetime", (F.col(day) if day else bucket(df, "day")).alias("_day"), reading.alias("_reading"))

    # Both uses of this frame shuffle the same columns, so the readings are scanned and shuffled once.
    within = Window.partitionBy("city", "_day").orderBy("datetime", "_reading")
    chained = series.select(
        "*", F.lag("_reading").over(within).alias("_previous"), F.lead(F.lit(True), 1, False).over(within).alias("_followed"))

    across = Window.partitionBy("city").orderBy("_day")
    carried = chained.where(~F.col("_followed")).select(
        F.col("city").alias("_city"), F.col("_day").alias("_on"), F.lag("_reading").over(across).alias("_carried"))
    previous = F.coalesce("_previous", "_carried")
    # Null-safe, or one side's scan would get a filter that the other has not.
    same = (lambda a, b: a == b) if day else Column.eqNullSafe  # only a plain comparison fits a table's buckets
    same_day = same(F.col("city"), F.col("_city")) & same(F.col("_day"), F.col("_on"))
    return chained.join(carried, same_day, "left" if day else "inner").select(
        "city", "datetime", "_reading.*",
        *[(F.col(f"_reading.{m}") - previous.getField(m)).alias(f"{m}_delta") for m in named],
    )


def first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """One row per key: the first in the declared order."""
    return _ranked(df, keys, order, 1)


def _first_rows(df: DataFrame, keys: Sequence[str], n: int) -> DataFrame:
    others = [F.desc(c) for c in df.columns if c not in (*keys, "datetime")]
    return _ranked(df, keys, [F.desc("datetime"), *others], n)


def _ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    numbered = df.withColumn("_row", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return numbered.filter(F.col("_row") <= n).drop("_row")
