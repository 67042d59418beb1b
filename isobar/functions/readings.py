"""Unit conversion and null rules of single readings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ZERO_CELSIUS = 273.15


def kelvin_to_celsius(kelvin: Column | str) -> Column:
    """Degrees Celsius to two places; null stays null. Ties round half up."""
    return F.round(_column(kelvin) - F.lit(ZERO_CELSIUS), 2)


def total_precipitation(rain: Column | str = "precipitation.rain",
                        snow: Column | str = "precipitation.snow") -> Column:
    """Rain plus snow, an absent amount counting as nothing."""
    return F.coalesce(_column(rain), F.lit(0.0)) + F.coalesce(_column(snow), F.lit(0.0))


def hourly_amount(amounts: Column | str) -> Column:
    """The one-hour amount of a rain or snow object, 0 where absent."""
    return F.coalesce(F.try_element_at(_column(amounts), F.lit("1h")), F.lit(0.0))


def first_field(array: Column | str, field: str) -> Column:
    """A field of the first element; null for a missing or empty array."""
    return F.get(_column(array), 0).getField(field)


# Epoch seconds of the years 1 to 9999.
EPOCH_RANGE = (-62_135_596_800, 253_402_300_799)


def epoch_to_timestamp(seconds: Column | str) -> Column:
    """Whole epoch seconds as a time; null beyond the years 1 to 9999."""
    value = _column(seconds)
    return F.timestamp_seconds(F.when(value.between(*EPOCH_RANGE), value).cast("bigint"))


def timestamp_text(moment: Column | str) -> Column:
    """``YYYY-MM-DD HH:MM:SS``, in the session zone (UTC)."""
    return F.date_format(_column(moment), "yyyy-MM-dd HH:mm:ss")


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
