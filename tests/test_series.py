from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import Window, functions as F

from isobar.operators import series
from readings import close, frame, random_readings, reading, rows


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_trend_equals_a_plain_window(spark, conf, seed, threshold):
    conf(spark__sql__autoBroadcastJoinThreshold=threshold)
    df = random_readings(spark, seed, days=20).cache()
    by_city = Window.partitionBy("city").orderBy("datetime")
    expected = df.select("city", "datetime", "temp", "pressure",
                         (F.col("temp") - F.lag("temp").over(by_city)).alias("temp_delta"),
                         (F.col("pressure") - F.lag("pressure").over(by_city)).alias("pressure_delta"))
    assert close(rows(series.trend(df, ["temp", "pressure"])), rows(expected))


def test_trend_never_windows_readings_by_city_alone(spark):
    plan = series.trend(random_readings(spark, 0, n=20), ["temp"])._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [lag" in line]
    assert len(windows) == 2
    assert all("_day" in line for line in windows)


@pytest.mark.parametrize("n", [1, 3, 500])
def test_newest(spark, n):
    df = random_readings(spark, 5, days=30).cache()
    by_city = {}
    for r in df.collect():
        by_city.setdefault(r.city, []).append(r.datetime)
    expected = sorted(((c, t) for c, ts in by_city.items() for t in sorted(ts)[-n:]), key=repr)
    assert rows(series.newest(df, n), "city", "datetime") == expected
    assert series.newest(df, n).columns == df.columns


def test_latest_keeps_whole_rows(spark):
    df = random_readings(spark, 6).cache()
    everything = df.collect()
    newest = {r.city: r for r in sorted(everything, key=lambda r: r.datetime)}
    assert {r.city: r for r in series.latest(df).collect()} == newest


def test_history_order(spark):
    found = [(r.city, r.datetime) for r in series.history(random_readings(spark, 2)).collect()]
    assert found == sorted(found, key=lambda r: (r[0], -(r[1] - datetime(1970, 1, 1)).total_seconds()))


def test_top_rows_are_cut_before_the_shuffle(spark):
    plan = series.newest(random_readings(spark, 0, n=20), 2)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 4  # per city and day, then per city, each before and after its shuffle


def test_ties_have_one_answer(spark):
    df = frame(spark, [reading("A", datetime(2024, 1, 1), temp=float(t)) for t in range(5)])
    assert [r.temp for r in series.latest(df).collect()] == [4.0]
    assert sorted(r.temp for r in series.newest(df.repartition(3), 2).collect()) == [3.0, 4.0]


def test_trend_of_nested_measures(spark):
    df = frame(spark, [reading("A", datetime(2024, 1, d), rain=float(d * d)) for d in (1, 2, 3)] + [reading("A", None, rain=1.0)])
    found = series.trend(df, ["precipitation.rain"]).orderBy("datetime").collect()
    assert [tuple(r)[2:] for r in found] == [(1.0, None), (4.0, 3.0), (9.0, 5.0)]
    named = series.trend(df, {"wet": F.col("precipitation.rain") * 2})
    assert named.columns == ["city", "datetime", "wet", "wet_delta"]
