from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from isobar.functions.readings import kelvin_to_celsius
from isobar.functions.temporal import bucket, in_period, next_period, period_range
from isobar.session import require_utc


def test_period_range():
    at = datetime(2024, 2, 29, 13, 5)
    assert period_range("day", at) == (datetime(2024, 2, 29), datetime(2024, 3, 1))
    assert period_range("month", at) == (datetime(2024, 2, 1), datetime(2024, 3, 1))
    assert period_range("year", at) == (datetime(2024, 1, 1), datetime(2025, 1, 1))
    assert period_range("day", at, datetime(2024, 3, 2)) == (datetime(2024, 2, 29), datetime(2024, 3, 2))
    assert period_range("month", at, datetime(2024, 3, 2)) == (datetime(2024, 2, 1), datetime(2024, 4, 1))


def test_zoned_instants_are_taken_as_utc():
    bangkok = timezone(timedelta(hours=7))
    assert period_range("day", datetime(2024, 1, 2, 3, tzinfo=bangkok))[0] == datetime(2024, 1, 1)


@pytest.mark.parametrize("grain", ["day", "month", "year"])
def test_periods_follow_each_other(grain):
    start = datetime(2019, 1, 1)
    while start < datetime(2025, 1, 1):
        following = next_period(grain, start)
        assert period_range(grain, following - timedelta(microseconds=1)) == (start, following)
        start = following


def test_unknown_grain(spark):
    with pytest.raises(ValueError):
        bucket(spark.range(1).select(F.current_timestamp().alias("datetime")), "week")


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_bucket_keeps_the_type_and_range_is_half_open(spark, kind):
    df = spark.sql(f"""
        SELECT cast(t AS {kind}) AS datetime FROM VALUES
        ('2024-01-01 00:00:00'), ('2024-01-01 23:59:59'), ('2024-01-02 00:00:00') AS v(t)""")
    assert df.select(bucket(df, "month").alias("m")).schema["m"].dataType.simpleString() == kind
    assert in_period(df, datetime(2024, 1, 1), datetime(2024, 1, 2)).count() == 2


def test_window_ignores_the_zone_and_trunc_does_not(spark, conf):
    conf(spark__sql__session__timeZone="Asia/Bangkok")
    df = spark.sql("SELECT timestamp_seconds(1704121200) AS datetime")
    starts = df.groupBy(F.window("datetime", "1 day")).count().select(F.unix_timestamp("window.start"))
    assert starts.first()[0] == 1704067200
    assert df.select(F.unix_timestamp(F.date_trunc("day", "datetime"))).first()[0] == 1704042000
    with pytest.raises(ValueError):
        bucket(df, "day")
    with pytest.raises(ValueError):
        require_utc(spark)


def test_literals_do_not_depend_on_the_zone(spark, conf):
    conf(spark__sql__session__timeZone="Asia/Bangkok")
    df = spark.sql("SELECT timestamp_seconds(1704067200) AS datetime")
    assert in_period(df, datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 1)).count() == 1


def test_kelvin_rounds_half_up(spark):
    df = spark.sql("SELECT * FROM VALUES (301.275D), (273.15D), (CAST(NULL AS DOUBLE)) AS v(k)")
    assert [r[0] for r in df.select(kelvin_to_celsius("k")).collect()] == [28.13, 0.0, None]
