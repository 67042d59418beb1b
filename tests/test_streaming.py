from __future__ import annotations

import json
import os
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from isobar.operators import rollups, series
from isobar.plans import jobs
from isobar.plans.jobs import run_ingest, table_path
from isobar.schemas import DAILY_PARTIALS, DAY_SUMMARY, LATEST, OBSERVATIONS, PRECIPITATION_TOTALS, STATISTICS
from isobar.sinks.upsert import read_stored
from isobar.sources.payloads import parse_payloads, read_landed
from isobar.streaming.ingest import ingest, landed_stream
from isobar.streaming.live import live_days, maintain_days
from readings import close, rows

EPOCH = datetime(1970, 1, 1)


def land(folder, name, *polls, at=None):
    """Write one file of (city, time, kelvin) polls, with a chosen arrival time."""
    os.makedirs(folder, exist_ok=True)
    path = os.path.join(folder, name)
    with open(path, "w") as out:
        for city, when, temp in polls:
            payload = {"dt": int((when - EPOCH).total_seconds()), "rain": {"1h": 0.5},
                       "main": {"temp": temp, "temp_min": temp - 1, "temp_max": temp + 1, "pressure": 1000}}
            out.write(json.dumps({"city": city, "raw": json.dumps(payload)}) + "\n")
    if at is not None:
        os.utime(path, (at, at))


def polls(seed):
    return [(f"C{i % 4}", datetime(2024, 1, 30) + timedelta(hours=5 * i + seed), 273.15 + i) for i in range(30)]


def test_stream_equals_batch(spark, tmp_path):
    landing, table = str(tmp_path / "landing"), str(tmp_path / "table")
    for i in range(4):
        land(landing, f"{i}.json", *polls(i))
    ingest(spark, landing, table, str(tmp_path / "cp"), max_files=1).awaitTermination()
    assert rows(read_stored(spark, table, OBSERVATIONS)) == rows(parse_payloads(read_landed(spark, landing)))


def test_last_poll_wins_across_and_within_batches(spark, tmp_path):
    landing, table, cp = (str(tmp_path / n) for n in ("landing", "table", "cp"))
    t = datetime(2024, 1, 1, 6)
    land(landing, "b.json", ("A", t, 274.15), at=1_700_000_000)
    land(landing, "a.json", ("A", t, 275.15), at=1_700_000_100)
    ingest(spark, landing, table, cp).awaitTermination()
    assert [r.temp for r in read_stored(spark, table, OBSERVATIONS).collect()] == [2.0]
    land(landing, "0.json", ("A", t, 276.15), ("B", t, 276.15))
    land(landing, "broken.json")
    with open(os.path.join(landing, "broken.json"), "w") as out:
        out.write(json.dumps({"city": "C", "raw": "{"}) + "\n")
    with open(os.path.join(landing, "odd.json"), "w") as out:
        for raw in ('{"dt": 1e17}', '{"main": {}}', None, '{"dt": 1704067200.0, "main": {"humidity": 100000.5}, "visibility": 7.0}'):
            out.write(json.dumps({"city": "D", "raw": raw}) + "\n")
    ingest(spark, landing, table, cp, rejects=str(tmp_path / "rejects")).awaitTermination()
    assert rows(read_stored(spark, table, OBSERVATIONS), "city", "temp") == [("A", 3.0), ("B", 3.0), ("D", None)]
    assert rows(read_stored(spark, table, OBSERVATIONS).where("city = 'D'"), "visibility", F.col("humidity").cast("double")) == [(7, 100000.5)]
    assert rows(spark.read.parquet(str(tmp_path / "rejects")), "city", "reason") == [
        ("C", "broken text"), ("D", "no payload"), ("D", "no time"), ("D", "time out of range")]


def test_failed_batch_is_repeated_after_restart(spark, tmp_path):
    landing, table, cp = (str(tmp_path / n) for n in ("landing", "table", "cp"))
    land(landing, "a.json", *polls(0))

    def fail(_):
        raise RuntimeError("lost")

    with pytest.raises(Exception, match="lost"):
        ingest(spark, landing, table, cp, after=fail).awaitTermination()
    land(landing, "b.json", *polls(1))
    seen = []
    ingest(spark, landing, table, cp, after=lambda df: seen.extend(r.datetime.date() for r in df.collect())).awaitTermination()
    assert rows(read_stored(spark, table, OBSERVATIONS)) == rows(parse_payloads(read_landed(spark, landing)))
    assert min(seen) == date(2024, 1, 30)


def test_ingest_refreshes_every_grain(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")
    late = ("C0", datetime(2024, 1, 30, 1), 500.0)
    land(landing, "0.json", *polls(0))
    run_ingest(spark, landing, root, str(tmp_path / "cp")).awaitTermination()
    land(landing, "1.json", late, ("C1", datetime(2025, 6, 1), 280.0), *polls(2)[:5])
    run_ingest(spark, landing, root, str(tmp_path / "cp")).awaitTermination()
    stored = read_stored(spark, table_path(root, OBSERVATIONS), OBSERVATIONS).cache()
    assert close(rows(read_stored(spark, table_path(root, DAILY_PARTIALS), DAILY_PARTIALS)),
                 rows(rollups.daily_partials(stored)))
    for grain in STATISTICS:
        for spec, direct in ((STATISTICS[grain], rollups.statistics), (PRECIPITATION_TOTALS[grain], rollups.precipitation)):
            assert close(rows(read_stored(spark, table_path(root, spec), spec)), rows(direct(stored, grain)))


def test_live_days_follow_late_rows_and_ignore_repeats(spark, tmp_path):
    landing, root, cp = (str(tmp_path / n) for n in ("landing", "root", "cp"))
    land(landing, "0.json", *polls(0))
    readings = parse_payloads(landed_stream(spark, landing))
    start = lambda: maintain_days(readings, root, cp, delay="10 days").awaitTermination()
    start()
    land(landing, "1.json", *polls(0), *polls(1))
    start()
    expected = rollups.day_summary(parse_payloads(read_landed(spark, landing)).dropDuplicates(["city", "datetime"]))
    weather, rain = DAY_SUMMARY, PRECIPITATION_TOTALS["day"]
    assert close(rows(read_stored(spark, f"{root}/{weather.name}", weather)), rows(expected, *weather.columns))
    assert close(rows(read_stored(spark, f"{root}/{rain.name}", rain)), rows(expected, *rain.columns))


def test_a_row_behind_any_watermark_counts_in_the_stored_tables(spark, tmp_path):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")
    run = lambda: run_ingest(spark, landing, root, str(tmp_path / "cp")).awaitTermination()
    land(landing, "0.json", ("A", datetime(2024, 1, 1, 6), 280.0), ("A", datetime(2024, 3, 1, 6), 280.0))
    run()
    land(landing, "1.json", ("A", datetime(2024, 1, 1, 7), 290.0))  # two months late
    run()
    expected = rollups.day_summary(parse_payloads(read_landed(spark, landing)))
    assert close(rows(read_stored(spark, f"{root}/{DAY_SUMMARY.name}", DAY_SUMMARY)), rows(expected, *DAY_SUMMARY.columns))
    assert rows(read_stored(spark, f"{root}/{LATEST.name}", LATEST), "city", "temp") == [("A", 6.85)]


@pytest.mark.parametrize("lost", ["refresh", "store_latest"])
def test_restart_between_upsert_and_correction(spark, tmp_path, monkeypatch, lost):
    landing, root = str(tmp_path / "landing"), str(tmp_path / "root")
    run = lambda: run_ingest(spark, landing, root, str(tmp_path / "cp")).awaitTermination()
    land(landing, "0.json", *polls(0))
    run()
    land(landing, "1.json", ("C0", datetime(2023, 11, 1, 7), 290.0), *polls(1))

    def fails(*_):
        raise RuntimeError("driver lost")

    monkeypatch.setattr(jobs, lost, fails)
    with pytest.raises(Exception, match="driver lost"):
        run()
    monkeypatch.undo()
    land(landing, "2.json", *polls(2))
    run()
    readings = parse_payloads(read_landed(spark, landing)).cache()
    for spec, expected in ((DAY_SUMMARY, rollups.daily_weather(readings)), (STATISTICS["month"], rollups.statistics(readings, "month")),
                           (PRECIPITATION_TOTALS["year"], rollups.precipitation(readings, "year"))):
        assert close(rows(read_stored(spark, table_path(root, spec), spec)), rows(expected))
    assert rows(read_stored(spark, table_path(root, LATEST), LATEST)) == rows(series.latest(readings).select(*LATEST.columns))


def test_processed_files_are_archived(spark, tmp_path):
    landing, archive = str(tmp_path / "landing"), str(tmp_path / "archive")
    for i in range(3):
        land(landing, f"{i}.json", *polls(i))
        ingest(spark, landing, str(tmp_path / "table"), str(tmp_path / "cp"), archive=archive).awaitTermination()
    assert len(os.listdir(landing)) < 3


def test_append_mode_emits_finished_days_only(spark, tmp_path):
    landing = str(tmp_path / "landing")
    land(landing, "0.json", ("A", datetime(2024, 1, 1, 6), 280.0), ("A", datetime(2024, 1, 5, 6), 280.0))
    land(landing, "1.json", ("A", datetime(2024, 1, 5, 7), 280.0))
    days = live_days(parse_payloads(landed_stream(spark, landing, 1)), "1 hour")
    query = (days.writeStream.outputMode("append").format("memory").queryName("finished")
             .option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start())
    query.awaitTermination()
    assert rows(spark.table("finished"), F.to_date("datetime").alias("d")) == [(date(2024, 1, 1),)]


def test_ntz_streams_can_be_watermarked(spark, tmp_path):
    source = str(tmp_path / "source")
    df = spark.sql("""SELECT 'A' AS city, timestamp_ntz'2024-01-01 06:00:00' AS datetime, 1.0D AS temp,
                             2.0D AS pressure, named_struct('rain', 1.0D, 'snow', 0.5D) AS precipitation""")
    df.write.parquet(source)
    maintain_days(spark.readStream.schema(df.schema).parquet(source), str(tmp_path / "root"),
                  str(tmp_path / "cp"), delay="2 days").awaitTermination()
    spec = PRECIPITATION_TOTALS["day"]
    assert rows(read_stored(spark, f"{tmp_path}/root/{spec.name}", spec), "city", "sum_precipitation") == [("A", 1.5)]
