from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from isobar.operators import rollups
from readings import close, frame, random_readings, reading, rows

SEEDS = range(3)
GRAINS = ["day", "month", "year"]


@pytest.mark.parametrize("seed", SEEDS)
def test_partials_agree_with_readings(spark, seed):
    df = random_readings(spark, seed).cache()
    partials = rollups.daily_partials(df)
    for grain in GRAINS:
        assert close(rows(rollups.statistics_from_partials(partials, grain)), rows(rollups.statistics(df, grain)))
        assert close(rows(rollups.precipitation_from_partials(partials, grain)), rows(rollups.precipitation(df, grain)))


@pytest.mark.parametrize("seed", SEEDS)
def test_all_grains_is_their_union(spark, seed):
    df = random_readings(spark, seed).cache()
    together = rollups.all_grains(df).cache()
    for grain in GRAINS:
        part = together.filter(F.col("grain") == grain)
        assert close(rows(part, *rollups.STATISTICS_COLUMNS), rows(rollups.statistics(df, grain)))
        assert close(rows(part, *rollups.PRECIPITATION_COLUMNS), rows(rollups.precipitation(df, grain)))
    assert together.count() == sum(rollups.statistics(df, g).count() for g in GRAINS)


def test_against_plain_python(spark):
    df = random_readings(spark, 7)
    groups = {}
    for r in df.collect():
        groups.setdefault((r.city, datetime(r.datetime.year, r.datetime.month, 1)), []).append(r)
    mean = lambda values: sum(values) / len(values) if values else None
    present = lambda rs, name: [getattr(r, name) for r in rs if getattr(r, name) is not None]
    expected = sorted(((c, m, mean(present(rs, "pressure")), mean(present(rs, "temp")),
                        min(present(rs, "temp_min"), default=None), max(present(rs, "temp_max"), default=None))
                       for (c, m), rs in groups.items()), key=repr)
    assert close(rows(rollups.statistics(df, "month")), expected)


def test_averages_weigh_readings_not_days(spark):
    df = frame(spark, [reading("A", datetime(2024, 1, 1, h), 0.0) for h in range(3)]
               + [reading("A", datetime(2024, 1, 2), 8.0)])
    assert rollups.statistics_from_partials(rollups.daily_partials(df), "month").first().avg_temp == 2.0


def test_two_kinds_of_extremes(spark):
    df = frame(spark, [reading("A", datetime(2024, 1, 1, 3), 5.0), reading("A", datetime(2024, 1, 1, 9), 7.0)])
    by_window, by_trunc = rollups.daily_weather(df).first(), rollups.statistics(df, "day").first()
    assert (by_window.temp_min, by_window.temp_max) == (5.0, 7.0)
    assert (by_trunc.temp_min, by_trunc.temp_max) == (3.5, 8.5)
    assert by_window.datetime == by_trunc.datetime == datetime(2024, 1, 1)


def test_missing_values_and_times(spark):
    df = frame(spark, [
        reading("A", datetime(2024, 1, 1, 3), None, None), reading("A", None, 99.0),
        reading("B", datetime(2024, 1, 1, 3), 1.0, rain=0.5), reading("B", datetime(2024, 1, 1, 4), 1.0, snow=0.25),
    ])
    summary = {r.city: r for r in rollups.day_summary(df).collect()}
    assert summary["A"].avg_temp is None and summary["A"].sum_precipitation == 0.0
    assert summary["B"].sum_precipitation == 0.75
    grains = rollups.all_grains(df).collect()
    assert len(grains) == 6 and all(r.datetime is not None for r in grains)
    assert all(r.avg_temp is None for r in grains if r.city == "A")
    frames = [rollups.daily_weather(df), rollups.daily_precipitation(df)]
    assert [f.count() for f in frames] == [2, 2]


def test_choice_of_cities_and_period(spark, conf):
    df = random_readings(spark, 3).cache()
    start, end = datetime(2023, 1, 1), datetime(2023, 6, 1)
    chosen = spark.createDataFrame([("HOT",), ("C1",), ("C1",), ("nowhere",)], "city string")
    inside = [r for r in rollups.day_summary(df).collect()
              if r.city in ("HOT", "C1") and start <= r.datetime < end]
    expected = sorted((tuple(r) for r in inside), key=repr)
    assert close(rows(rollups.day_summary(df, ["HOT", "C1"], start, end)), expected)
    assert close(rows(rollups.day_summary(df, chosen, start, end)), expected)
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    assert close(rows(rollups.day_summary(df, chosen, start, end)), expected)


def test_one_scan_and_partial_aggregation(spark):
    df = random_readings(spark, 0, n=50)
    plan = rollups.day_summary(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "partial_sum" in plan
