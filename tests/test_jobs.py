from __future__ import annotations

import json
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from isobar.functions.temporal import period_range
from isobar.operators import rollups
from isobar.plans import jobs
from isobar.plans.jobs import insert_documents, process_day, refresh, rollup, table_path
from isobar.schemas import CITIES, DAILY_PARTIALS, DAY_SUMMARY, OBSERVATIONS, PRECIPITATION_TOTALS, STATISTICS
from isobar.sinks.upsert import read_stored, upsert
from readings import close, random_readings, rows


@pytest.fixture
def root(spark, tmp_path):
    readings = random_readings(spark, 11, n=300, days=9)
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in OBSERVATIONS.schema.fields
               if f.name not in readings.columns]
    path = str(tmp_path / "root")
    upsert(readings.select("*", *missing), table_path(path, OBSERVATIONS), OBSERVATIONS, rank=["temp"])
    return path


def stored(spark, root, spec):
    return read_stored(spark, table_path(root, spec), spec)


def assert_current(spark, root):
    observations = stored(spark, root, OBSERVATIONS).cache()
    assert close(rows(stored(spark, root, DAY_SUMMARY)), rows(rollups.daily_weather(observations)))
    for grain in STATISTICS:
        assert close(rows(stored(spark, root, STATISTICS[grain])), rows(rollups.statistics(observations, grain)))
        assert close(rows(stored(spark, root, PRECIPITATION_TOTALS[grain])),
                     rows(rollups.precipitation(observations, grain)))


def test_rollup_then_refresh(spark, root, monkeypatch):
    rollup(spark, root)
    assert_current(spark, root)
    document = {"city": "HOT", "datetime": "2022-12-28 23:59:59", "temp": 99.0, "temp_max": 120.0,
                "precipitation": {"rain": 7.0, "snow": 0.0}}
    documents = spark.createDataFrame([(json.dumps(document), 1)], "doc string, arrival int")
    days = insert_documents(documents, root, rank=["arrival"])
    assert days == ["2022-12-28-23"]
    changed = stored(spark, root, OBSERVATIONS).where("temp = 99").select("city", "datetime")
    assert rows(changed, "city") == [("HOT",)]
    read = []
    monkeypatch.setattr(jobs, "partials", lambda df, grain: read.append(df.select("city").distinct().collect()) or rollups.partials(df, grain))
    refresh(spark, root, changed)
    assert read == [[("HOT",)]]  # other cities of the hour are not read again
    assert_current(spark, root)
    refresh(spark, root, changed.limit(0))
    assert_current(spark, root)


def test_documents_of_other_tables(spark, tmp_path):
    documents = [(json.dumps({"city": "A", "lat": "1.5", "lng": v, "country_id": 3}), v) for v in (1, 2)]
    insert_documents(spark.createDataFrame(documents, "doc string, v int"), str(tmp_path), ["v"], CITIES)
    assert rows(stored(spark, str(tmp_path), CITIES)) == [("A", 1.5, 2.0, 3, None)]


def test_process_day_for_some_and_all_cities(spark, root):
    observations = stored(spark, root, OBSERVATIONS)
    start, end = period_range("day", observations.filter("city = 'HOT'").agg(F.min("datetime")).first()[0])
    when = start + timedelta(hours=15)
    rollup(spark, root)
    before = rows(stored(spark, root, STATISTICS["day"]))
    fresh = f"{root}-fresh"  # only the readings are there
    upsert(observations, table_path(fresh, OBSERVATIONS), OBSERVATIONS, rank=[])
    process_day(spark, fresh, when, ["HOT"])
    assert close(rows(stored(spark, fresh, DAY_SUMMARY)),
                 rows(rollups.daily_weather(observations, ["HOT"], start, end)))
    for _ in range(2):
        process_day(spark, fresh, when)
    assert close(rows(stored(spark, fresh, DAY_SUMMARY)), rows(rollups.daily_weather(observations, None, start, end)))
    process_day(spark, root, when)
    assert close(rows(stored(spark, root, DAY_SUMMARY)), rows(rollups.daily_weather(observations)))
    assert close(rows(stored(spark, root, PRECIPITATION_TOTALS["day"])), rows(rollups.daily_precipitation(observations)))
    assert rows(stored(spark, root, STATISTICS["day"])) == before


def test_command_line(spark, root):
    jobs.main(["rollup", "--root", root])
    assert stored(spark, root, DAILY_PARTIALS).agg(F.sum("n")).first()[0] == 300
    jobs.main(["day", "--root", root, "--date", "2022-12-30", "--city", "HOT", "--city", "C1"])
    jobs.main(["day", "--root", root])
