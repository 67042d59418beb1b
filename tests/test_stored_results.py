"""Stored trends, lookups of one city, sketches, buckets, open payloads and rejected lines."""

from __future__ import annotations

import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from isobar.operators import places, series
from isobar.plans import jobs
from isobar.schemas import CITIES_SCHEMA, COUNTRIES_SCHEMA, OBSERVATIONS, TRENDS, TableSpec, OBSERVATION_SCHEMA, KEY
from isobar.sinks.tables import write_bucketed
from isobar.sinks.upsert import read_stored, upsert
from isobar.sources import dimensions, payloads
from isobar.sources.tables import of_city
from isobar.streaming.live import keep_first_polls
from readings import close, observation, random_readings, rows


def stored_trends(spark, root):
    return rows(read_stored(spark, jobs.table_path(root, TRENDS), TRENDS))


@pytest.mark.parametrize("seed", range(2))
def test_trends_after_batches_out_of_order(spark, tmp_path, seed):
    rng, root = random.Random(seed), str(tmp_path / "root")
    start = datetime(2024, 1, 1)
    times = [start + timedelta(days=rng.choice([0, 1, 2, 9, 30, 31]), minutes=rng.randrange(1440)) for _ in range(40)]
    whole = {}
    for _ in range(4):  # corrections of readings among them
        batch = {(rng.choice(["A", "A", "B", f"C{rng.randrange(3)}"]), rng.choice(times)): rng.randrange(100) / 2 for _ in range(12)}
        whole |= batch
        df = spark.createDataFrame([observation(c, t, temp=v, pressure=1000 + v) for (c, t), v in batch.items()], OBSERVATION_SCHEMA)
        upsert(df, jobs.table_path(root, OBSERVATIONS), OBSERVATIONS, [])
        jobs.refresh(spark, root, df)
        jobs.refresh_trends(spark, root, df.select("datetime", "city"), ["temp", "pressure"], TRENDS)
        jobs.refresh_trends(spark, root, df.limit(0), ["temp", "pressure"], TRENDS)
    expected = series.trend(read_stored(spark, jobs.table_path(root, OBSERVATIONS), OBSERVATIONS), ["temp", "pressure"])
    assert stored_trends(spark, root) == rows(expected) and len(whole) == expected.count()


def test_a_late_reading_rewrites_two_rows(spark, tmp_path, monkeypatch):
    root, written = str(tmp_path / "root"), []
    days = [datetime(2024, 1, 1), datetime(2024, 1, 20), datetime(2024, 3, 5)]
    make = lambda *times: spark.createDataFrame([observation("A", t, temp=float(t.day)) for t in times], OBSERVATION_SCHEMA)

    def step(df):
        upsert(df, jobs.table_path(root, OBSERVATIONS), OBSERVATIONS, [])
        jobs.refresh(spark, root, df)
        jobs.refresh_trends(spark, root, df, ["temp", "pressure"], TRENDS)

    step(make(*days))
    real = jobs.upsert
    monkeypatch.setattr(jobs, "upsert", lambda df, path, spec, **k: (spec is TRENDS and written.extend(rows(df, "datetime", "temp_delta"))) or real(df, path, spec, **k))
    step(make(datetime(2024, 1, 21, 5)))
    assert written == [(datetime(2024, 1, 21, 5), 1.0), (datetime(2024, 3, 5), -16.0)]


def test_refreshes_keep_no_frames(spark, tmp_path):
    """Frames left in the cache are listed and planned anew by every later write to a table they read."""
    root, kept = str(tmp_path / "root"), lambda: spark.sparkContext._jsc.getPersistentRDDs().size()
    before = kept()
    for day in (1, 20, 11):  # the last between the others, with neighbours in days that are looked up
        df = spark.createDataFrame([observation(c, datetime(2024, 1, day), temp=float(day)) for c in "AB"], OBSERVATION_SCHEMA)
        upsert(df, jobs.table_path(root, OBSERVATIONS), OBSERVATIONS, [])
        jobs.refresh(spark, root, df)
        jobs.refresh_trends(spark, root, df, ["temp", "pressure"], TRENDS)
    assert kept() == before
    assert [(c, t.day, d) for c, t, d in rows(read_stored(spark, jobs.table_path(root, TRENDS), TRENDS), "city", "datetime", "temp_delta")] == [
        (c, day, delta) for c in "AB" for day, delta in ((1, None), (11, 10.0), (20, 9.0))]


@pytest.mark.parametrize("few", [0, 10**9])
def test_neighbours_are_found_with_and_without_a_join_of_cities(spark, tmp_path, monkeypatch, few):
    monkeypatch.setattr(jobs, "FEW", few)
    test_trends_after_batches_out_of_order(spark, tmp_path, 2)


def test_hundreds_of_directories_are_listed_by_few_tasks(spark, tmp_path):
    path, times = str(tmp_path / "t"), [datetime(2024, 1, 1) + timedelta(hours=i) for i in range(100)]
    upsert(spark.createDataFrame([observation("A", t) for t in times], OBSERVATION_SCHEMA), path, OBSERVATIONS, [])
    spark.sparkContext.setJobGroup("listing", "listing")
    assert read_stored(spark, path, OBSERVATIONS).schema.names == OBSERVATIONS.columns
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [s for job in tracker.getJobIdsForGroup("listing") for s in tracker.getJobInfo(job).stageIds]
    assert 0 < sum(tracker.getStageInfo(s).numTasks for s in stages) <= 32


def files_and_rows(df):
    """Files opened and rows read by the scan, from its metrics; of the frame's first run."""
    found = len(df.collect())
    node = df._jdf.queryExecution().executedPlan()
    while not node.nodeName().startswith("Scan"):
        node = node.finalPhysicalPlan() if hasattr(node, "finalPhysicalPlan") and "Adaptive" in node.nodeName() else node.children().apply(0)
    metrics = node.metrics()
    return metrics.apply("numFiles").value(), metrics.apply("numOutputRows").value(), found


def test_a_city_reads_few_row_groups(spark, tmp_path):
    path = str(tmp_path / "t")
    spec = TableSpec("t", OBSERVATION_SCHEMA, KEY, "hour", bloom=("city",), group_bytes=64 << 10)
    hour = F.timestamp_seconds(F.lit(1704067200) + (F.col("id") % 3) * 3600)
    value = lambda f: {"city": F.concat(F.lit("C"), F.format_string("%06d", F.col("id") * 2)), "datetime": hour, "temp": F.rand(2)}.get(
        f.name, F.lit(None)).cast(f.dataType).alias(f.name)
    upsert(spark.range(90_000).select(*[value(f) for f in OBSERVATION_SCHEMA.fields]), path, spec, [])
    day = lambda hours: read_stored(spark, path, spec, datetime(2024, 1, 1), datetime(2024, 1, 1) + timedelta(hours=hours))
    found = of_city(day(24), "C060000").select("city", "temp")
    n_files, n_rows, n = files_and_rows(found)
    assert n == 1 and n_files == 3 and n_rows < 90_000 / 4  # of three directories, some row groups of one
    assert files_and_rows(of_city(day(1), "C060000").select("city", "temp"))[0] <= 2
    assert files_and_rows(of_city(day(24), "C060001").select("city", "temp"))[1] == 0  # inside the range, but in no filter


def test_sketches_hold_their_bound_and_merge(spark):
    obs = spark.range(60_000).select(
        F.concat(F.lit("C"), F.col("id") % 20_000).alias("city"),
        F.timestamp_seconds(F.lit(1704067200) + (F.col("id") % 60) * 86400).alias("datetime"))
    listed = spark.range(0, 30_000, 2).select(F.concat(F.lit("C"), "id").alias("city"))
    days = places.coverage_partials(listed, obs)
    exact = {r[0]: r[1] for r in obs.join(listed, "city", "left_semi").groupBy(F.date_trunc("month", "datetime")).agg(F.count_distinct("city")).collect()}
    merged = places.coverage_from_partials(days, "month").collect()
    assert {r.datetime for r in merged} == set(exact) and sum(r.n_readings for r in merged) == 60_000
    assert all(abs(r.n_covered / exact[r.datetime] - 1) < 3 * 0.8 / 2**7 for r in merged)
    per_day = places.coverage_partials(listed, obs).where("datetime = '2024-01-01'").first()
    assert per_day.n_covered == obs.where("datetime = '2024-01-01'").join(listed, "city", "left_semi").count()
    assert places.coverage_from_partials(days.limit(0), "month").count() == 0
    assert places.coverage_partials(listed.limit(0), obs).where("n_covered > 0").count() == 0


def test_bucketed_readings_are_not_shuffled(spark, tmp_path, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1")
    df = random_readings(spark, 4, days=20).select("city", "datetime", "temp", "pressure").cache()
    name = write_bucketed(df, "climate_b", "readings", str(tmp_path / "b"), 4)
    try:
        found = series.trend(spark.table(name), ["temp", "pressure"], day="day")
        assert close(rows(found), rows(series.trend(df, ["temp", "pressure"])))
        plan = found._jdf.queryExecution().executedPlan().toString()
        final = plan.split("Initial Plan")[0]
        readings, last = final.split("FileScan")[0], final.split("FileScan")[1]
        assert final.count("FileScan") == 2 and final.count("Bucketed: true") == 2
        assert "Exchange" not in readings  # only the last reading of each city and day moves
        assert last.index("Exchange") < last.index("Window [lag(_reading") and "NOT _followed" in last
    finally:
        spark.sql("DROP DATABASE climate_b CASCADE")


def test_open_payloads_equal_closed_ones(spark):
    texts = ['{"dt": 1704067200, "main": {"temp": 280.5, "humidity": 55.5, "odd": [1]}, "rain": {"1h": 0.5}, "new": {"a": 1}, "clouds": {"all": 7.0}}',
             '{"dt": 1704067201.0, "weather": [], "wind": {"speed": 2}, "visibility": 7.0, "main": {"humidity": 100000.25}}',
             '{"dt": 1704067202, "weather": [{"main": "x", "id": 3}], "snow": {"3h": 1}, "new": "text", "main": {"temp": "280"}}',
             '{"dt": 17', '[1, 2]', '{"main": {}}', '{"dt": 1e17}', "7", None, '{"dt": 1704067203, "rain": 3, "sys": 4}']
    landed = spark.createDataFrame([("C", t) for t in texts], "city string, raw string")
    strict = landed.where(F.col("raw").isNull() | ~F.col("raw").contains('"280"') & ~F.col("raw").contains('"sys": 4'))
    assert rows(payloads.parse_variants(strict)) == rows(payloads.parse_payloads(strict))
    odd = payloads.parse_variants(landed, keep_open=True)
    assert odd.count() == 4 and odd.where("payload IS NULL").count() == 0
    assert rows(payloads.unseen_keys(landed), "path", "n") == [("main.odd", 1), ("new", 1), ("new", 1)]
    assert {r.kind for r in payloads.unseen_keys(landed).where("path = 'new'").collect()} == {"STRING", "OBJECT<a: BIGINT>"}
    assert payloads.unseen_keys(landed.limit(0)).count() == 0


def test_lines_are_kept_or_listed(spark, tmp_path):
    folder = tmp_path / "csv"
    folder.mkdir()
    (folder / "a.csv").write_text('id,name,subregion,region\n1,One,s,r\n2,"Two, in all",s,r\nx,Three,s,r\n4,Four\n5,Five,s,r,more\n,Six,s,r\n7,,,\n')
    (folder / "b.csv").write_text("id,name,subregion,region\n8,Eight,s,r\n9.5,Nine,s,r\n")
    good, away = dimensions.read_with_rejects(spark, str(folder), COUNTRIES_SCHEMA)
    assert rows(good, "id", "name") == [(1, "One"), (2, "Two, in all"), (7, None), (8, "Eight")]
    found = {(r.file.rsplit("/", 1)[1], r.line, r.reason) for r in away.collect()}
    assert found == {
        ("a.csv", "x,Three,s,r", "value of another type"), ("a.csv", "4,Four", "too few fields"),
        ("a.csv", "5,Five,s,r,more", "too many fields"), ("a.csv", ",Six,s,r", "no value of id"),
        ("b.csv", "9.5,Nine,s,r", "value of another type")}
    assert good.count() + away.count() == 9 and good.select("name").count() == 4
    (folder / "a.csv").write_text("")
    (folder / "b.csv").write_text("id,name,subregion,region\n")
    assert [df.count() for df in dimensions.read_with_rejects(spark, str(folder), CITIES_SCHEMA)] == [0, 0]


def test_state_of_first_polls_expires(spark, tmp_path):
    source, path, states = str(tmp_path / "source"), str(tmp_path / "polls"), []
    when = lambda day, hour=0: datetime(2024, 1, day, hour)

    def run(*polls):
        spark.createDataFrame(polls, "city string, datetime timestamp, temp double").write.mode("append").parquet(source)
        stream = spark.readStream.schema("city string, datetime timestamp, temp double").parquet(source)
        query = keep_first_polls(stream, path, str(tmp_path / "cp"), "2 days")
        query.awaitTermination()
        states.append(json.loads(query.lastProgress.json)["stateOperators"][0]["numRowsTotal"])

    run(("A", when(1), 1.0), ("A", when(2), 2.0), ("A", when(2), 2.5))
    run(("A", when(2), 9.0), ("B", when(1), 3.0), ("A", when(8), 4.0))
    run(("A", when(8), 9.0), ("A", when(7), 5.0), ("B", when(2), 9.0), ("A", when(20), 6.0))
    found = rows(spark.read.parquet(path), "city", "datetime", "temp")
    assert sorted((c, d.day) for c, d, _ in found) == [("A", 1), ("A", 2), ("A", 7), ("A", 8), ("A", 20), ("B", 1)]
    assert not {9.0} & {t for *_, t in found}
    assert states[-1] == 1  # only the newest key is still held
