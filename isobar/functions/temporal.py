"""Calendar buckets and half-open time ranges."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import DataType, TimestampNTZType

from isobar.session import require_utc

GRAINS = ("day", "month", "year")
DIRECTORY_GRAINS = ("hour", *GRAINS)


def bucket(df: DataFrame, grain: str, column: str = "datetime") -> Column:
    """Start of the UTC calendar period, in the type of the column itself; refused in sessions of another zone."""
    if grain not in DIRECTORY_GRAINS:
        raise ValueError(f"unknown grain {grain}")
    require_utc(df.sparkSession)
    return F.date_trunc(grain, column).cast(df.schema[column].dataType)


def floor_to(grain: str, instant: datetime) -> datetime:
    """Start of the UTC calendar period holding ``instant``."""
    instant = _utc(instant).replace(minute=0, second=0, microsecond=0)
    if grain == "hour":
        return instant
    instant = instant.replace(hour=0)
    if grain == "day":
        return instant
    if grain == "month":
        return instant.replace(day=1)
    if grain == "year":
        return instant.replace(month=1, day=1)
    raise ValueError(f"unknown grain {grain}")


def next_period(grain: str, start: datetime) -> datetime:
    """Start of the period after the one holding ``start``."""
    step = {"hour": timedelta(hours=1), "day": timedelta(days=1), "month": timedelta(days=32), "year": timedelta(days=367)}[grain]
    return floor_to(grain, floor_to(grain, start) + step)


def period_range(grain: str, start: datetime, end: datetime | None = None) -> tuple[datetime, datetime]:
    """Whole periods covering ``[start, end)``; the one period of ``start`` without ``end``."""
    first = floor_to(grain, start)
    if end is None:
        return first, next_period(grain, first)
    last = floor_to(grain, end)
    return first, last if last == _utc(end) else next_period(grain, last)


def instant(value: datetime, kind: DataType) -> Column:
    """A literal of the given timestamp type, so that filters on it reach the scan."""
    text = _utc(value).isoformat(sep=" ")
    if isinstance(kind, TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    return F.lit(text + "+00:00").cast("timestamp")


def in_period(df: DataFrame, start: datetime | None, end: datetime | None,
              column: str = "datetime") -> DataFrame:
    """Rows with ``start <= column < end``; a bound left None is open."""
    kind = df.schema[column].dataType
    if start is not None:
        df = df.filter(F.col(column) >= instant(start, kind))
    if end is not None:
        df = df.filter(F.col(column) < instant(end, kind))
    return df


def _utc(value: datetime) -> datetime:
    return value.astimezone(timezone.utc).replace(tzinfo=None) if value.tzinfo else value
