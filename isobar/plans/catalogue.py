"""Every operator as a query over the test tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from isobar.functions.readings import kelvin_to_celsius, timestamp_text
from isobar.functions.temporal import bucket, in_period, period_range
from isobar.operators import merging, places, rollups, series
from isobar.plans import jobs, views
from isobar.schemas import (
    CITIES, CITIES_SCHEMA, COUNTRIES_SCHEMA, DAY_SUMMARY, KEY, LATEST, OBSERVATIONS, PARTITION, PRECIPITATION_SCHEMA,
    PRECIPITATION_TOTALS, STATISTICS, TRENDS,
)
from isobar.session import scratch_path
from isobar.sinks import counters
from isobar.sinks.tables import create_table, write_bucketed, write_table
from isobar.sinks.upsert import read_stored, upsert
from isobar.sources import dimensions, payloads, tables
from isobar.streaming.ingest import ingest
from isobar.streaming.live import keep_first_polls, maintain_days

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

CITY = "CITY_7"
DAY = datetime(2024, 1, 5, 13, 30)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    """Sums and averages to nine places, since their order of addition is not fixed."""
    return df.withColumns({c: F.round(c, 9) for c in columns})


def spread(df: DataFrame) -> DataFrame:
    """Rain and snow as plain columns."""
    return df.select("*", "precipitation.rain", "precipitation.snow").drop("precipitation")


# -- scans, filters, projections ------------------------------------------------

@query
def scan_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chosen columns under a predicate on another one, both reaching the file scan."""
    return tables.read_table(spark, "sf", "events", ["user_id", "ts", "value"], "event_type = 'view'",
                             fmt="parquet", path=f"{sf_dir}/events.parquet")


@query
def scan_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(tables.of_city(views.observations(spark, sf_dir), CITY))


@query
def range_half_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = period_range("day", datetime(2024, 1, 5, 8), datetime(2024, 1, 9, 12))
    return in_period(views.observations(spark, sf_dir), start, end).select("city", "datetime", "temp", "pressure")


@query
def sql_param(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.run_sql(
        spark,
        "SELECT city, datetime, temp FROM {obs} WHERE city = :city AND temp >= :floor",
        {"city": CITY, "floor": -100.0}, obs=views.observations(spark, sf_dir),
    )


@query
def kelvin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.observations(spark, sf_dir).select(
        "city", "datetime", "temp_k", kelvin_to_celsius("temp_k").alias("celsius"))


# -- JSON -----------------------------------------------------------------------

@query
def json_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.flat_readings(payloads.parse_payloads(views.landed_payloads(spark, sf_dir)))


@query
def json_flatten_kelvin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat variant: Kelvin, epoch time, rain and snow an object or the number 0."""
    obs, k = views.observations(spark, sf_dir), F.col("humidity")
    epoch = F.unix_timestamp(F.col("datetime").cast("timestamp"))
    amount = lambda name: F.when(
        F.col(f"precipitation.{name}").isNotNull(),
        F.to_json(F.create_map(F.lit("1h"), F.col(f"precipitation.{name}")))).otherwise("0")
    body = F.to_json(F.struct(
        "city", epoch.alias("time"), "main", F.col("temp_k").alias("temp"), (F.col("temp_k") - 1).alias("feels_like"),
        (F.col("temp_k") - k / F.lit(10.0)).alias("temp_min"), (F.col("temp_k") + k / F.lit(10.0)).alias("temp_max"),
        "pressure", k.cast("double").alias("humidity"), epoch.cast("double").alias("sunrise"),
    ))
    document = F.concat(F.expr("left(body, length(body) - 1)"), F.lit(',"precipitation":{"rain":'), amount("rain"),
                        F.lit(',"snow":'), amount("snow"), F.lit("}}"))
    parsed = payloads.parse_flat_documents(obs.withColumn("body", body).select(document.alias("doc")))
    return views.flat_readings(parsed).select(
        "city", "datetime", "main", "temp", "feels_like", "temp_min", "temp_max", "pressure", "humidity",
        "rain", "snow", "sunrise", "sunset")


@query
def json_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Celsius documents with text times and a number sent as text, to table rows."""
    document = F.to_json(F.struct(
        "city", timestamp_text("datetime").alias("datetime"), "main", F.col("temp").cast("string").alias("temp"),
        "pressure", "humidity", "precipitation", F.struct(F.col("temp_k").alias("speed")).alias("wind"),
    ))
    documents = views.observations(spark, sf_dir).select(document.alias("doc"))
    return views.flat_readings(payloads.rows_from_documents(documents))


@query
def to_json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every column of a reading to a document and back."""
    obs = views.observations(spark, sf_dir)
    documents = payloads.to_documents(obs)
    part = lambda name, kind, path=None: F.get_json_object("doc", f"$.{path or name}").cast(kind).alias(name)
    return documents.select(
        *[part(f.name, f.dataType) for f in obs.schema if f.name != "precipitation"],
        part("rain", "double", "precipitation.rain"), part("snow", "double", "precipitation.snow"))


@query
def payload_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads as they come: readings kept and payloads turned away, with the reason."""
    landed = views.rough_payloads(spark, sf_dir)
    kept = views.flat_readings(payloads.parse_payloads(landed)).select(
        "city", "datetime", "humidity", "visibility", F.lit("kept").alias("outcome"))
    away = payloads.rejected_payloads(landed).select("city", F.col("reason").alias("outcome"))
    return merging.union_batches([kept, away])


# -- aggregates -----------------------------------------------------------------

AVERAGES = ("avg_pressure", "avg_temp")


@query
def agg_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rollups.statistics(views.observations_long(spark, sf_dir), "day"), *AVERAGES)


@query
def agg_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rollups.statistics(views.observations_long(spark, sf_dir), "month"), *AVERAGES)


@query
def agg_yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rollups.statistics(views.observations_long(spark, sf_dir), "year"), *AVERAGES)


@query
def agg_monthly_precip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rollups.precipitation(views.observations_long(spark, sf_dir), "month"), "sum_precipitation")


@query
def agg_yearly_precip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rollups.precipitation(views.observations_long(spark, sf_dir), "year"), "sum_precipitation")


@query
def agg_all_grains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In whole units of 1e-5, so that sums are exact whatever their order."""
    result = rollups.all_grains(views.in_units(views.observations_long(spark, sf_dir)))
    measures = [*AVERAGES, "temp_min", "temp_max", "sum_precipitation"]
    return result.withColumns({c: F.col(c) / F.lit(1e5) for c in measures})


@query
def rollup_from_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    partials = rollups.daily_partials(views.observations_long(spark, sf_dir))
    return rounded(rollups.statistics_from_partials(partials, "month"), *AVERAGES)


@query
def daily_stats_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rollups.daily_weather(views.observations(spark, sf_dir)), *AVERAGES)


@query
def daily_precip_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rollups.daily_precipitation(views.observations(spark, sf_dir)), "sum_precipitation")


@query
def process_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = period_range("day", DAY)
    summary = rollups.day_summary(views.observations(spark, sf_dir), start=start, end=end)
    return rounded(summary, *AVERAGES, "sum_precipitation")


@query
def geo_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    partials = rollups.daily_partials(views.observations(spark, sf_dir))
    result = places.regional_rollup(partials, views.cities(spark, sf_dir), views.countries(spark, sf_dir))
    return rounded(result, "avg_temp", "sum_precipitation")


@query
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = views.observations(spark, sf_dir)
    return rounded(places.coverage(views.listed_cities(spark, sf_dir), obs, bucket(obs, "day")), "coverage")


# -- newest, history, trend -----------------------------------------------------

@query
def latest_per_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(series.latest(views.observations(spark, sf_dir)))


@query
def recent_n_per_city(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.newest(views.observations(spark, sf_dir), 3).select("city", "datetime", "temp", "pressure")


@query
def history_desc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.history(views.observations(spark, sf_dir).select("city", "datetime", "temp"))


@query
def trend_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    wind = F.struct((F.col("temp_k") / 10).alias("speed"), F.col("humidity").cast("double").alias("deg"))
    obs = views.observations(spark, sf_dir).withColumn("wind", wind)
    changes = series.trend(obs, ["temp", "humidity", "wind.speed", "wind.deg"])
    return rounded(changes, "temp_delta", "wind_speed_delta")


# -- joins ----------------------------------------------------------------------

@query
def fk_city_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places.with_country(views.cities(spark, sf_dir), views.countries(spark, sf_dir))


@query
def observation_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = views.observations(spark, sf_dir).select("city", "datetime", "temp")
    return places.enrich(obs, views.cities(spark, sf_dir), salted=False)


@query
def observation_enriched_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = views.observations(spark, sf_dir).select("city", "datetime", "temp")
    return places.enrich(obs, views.cities(spark, sf_dir))


@query
def missing_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places.missing_cities(views.listed_cities(spark, sf_dir), views.observations(spark, sf_dir))


@query
def covered_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return places.covered_cities(views.listed_cities(spark, sf_dir), views.observations(spark, sf_dir))


@query
def city_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First match per city in a dimension that lists each city several times."""
    sites = views.observations(spark, sf_dir).select(
        "city", F.col("pressure").alias("lat"), F.col("temp").alias("lng"))
    requests = views.listed_cities(spark, sf_dir).select("city")
    return places.locate(requests, sites, ["lat", "lng"])


# -- merges ---------------------------------------------------------------------

def _batches(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    rows = views.observations_long(spark, sf_dir)
    return [rows.filter(F.col("batch") == b) for b in ("A", "N", "R")]


# Arrival order inside a batch; the measured values come last, so that even
# line items of equal place have one winner.
RANK = ("l_orderkey", "l_linenumber", "l_partkey", "temp", "pressure", "precipitation")


@query
def upsert_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches, later ones winning, in one pass: the batch is the leading rank."""
    rows = views.observations_long(spark, sf_dir)
    merged = merging.last_write(rows, OBSERVATIONS.keys, ("batch", *RANK))
    return spread(merged.select(*views.LONG_SCHEMA.fieldNames()))


@query
def upsert_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same three batches through a table on disk, the last one twice."""
    path = scratch_path(spark, "long_readings")
    batches = _batches(spark, sf_dir)
    for batch in [*batches, batches[-1]]:
        upsert(batch, path, views.LONG_READINGS, RANK)
    return spread(read_stored(spark, path, views.LONG_READINGS))


@query
def counter_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = [rollups.precipitation(b, "month") for b in _batches(spark, sf_dir)]
    merged = totals[0]
    for delta in totals[1:]:
        merged = merging.add_counters(merged, delta, OBSERVATIONS.keys, ["sum_precipitation"])
    return rounded(merged, "sum_precipitation")


@query
def union_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    obs = views.observations(spark, sf_dir).select("city", "datetime", "main", "temp", "humidity")
    wet = F.col("main").isin("view", "signup")
    return merging.union_batches([obs.filter(wet), obs.filter(~wet).drop("humidity")])


# -- files, tables, streams -----------------------------------------------------

@query
def csv_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Countries written as CSV and read back with their schema."""
    path = scratch_path(spark, "countries-csv")
    views.countries(spark, sf_dir).write.csv(path, header=True)
    return dimensions.require_rows(dimensions.read_dimension(spark, path, COUNTRIES_SCHEMA), "countries")


@query
def bulk_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities from a CSV with the loader's columns, by position, into a table."""
    path, table = scratch_path(spark, "cities-csv"), scratch_path(spark, "cities")
    views.numbered_cities(spark, sf_dir).select("country_id", "city_id", "city", "lat", "lng").write.csv(path, header=True)
    rows = dimensions.bulk_load(spark, path, ["country_id", "city_id", "name", "latitude", "longitude"], CITIES_SCHEMA)
    upsert(rows, table, CITIES, rank=["lat"])
    return read_stored(spark, table, CITIES)


@query
def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All payloads landed as files, streamed in several batches into the readings.

    Payloads carry whole seconds, so two readings may share a key; they land in one
    file, where the greater text wins.
    """
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "readings")
    second = F.get_json_object("raw", "$.dt").cast("long")
    for arrival in range(2):  # readings of even and odd seconds, landed and streamed one after the other
        half = views.landed_payloads(spark, sf_dir).where(second % 2 == arrival)
        half.repartition("city", second).write.mode("append").json(landing)
        ingest(spark, landing, path, f"{path}-offsets").awaitTermination()
    return views.flat_readings(read_stored(spark, path, OBSERVATIONS))


@query
def stream_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily tables kept by a stream of readings in several batches; days arrive in pieces."""
    landing, root = scratch_path(spark, "landing"), scratch_path(spark, "root")
    obs = views.observations(spark, sf_dir).select("city", "datetime", "temp", "pressure", "precipitation")
    for arrival in range(2):  # the second run goes on from the state of the first
        obs.where(F.second("datetime") % 2 == arrival).write.mode("append").parquet(landing)
        readings = spark.readStream.schema(obs.schema).parquet(landing)
        maintain_days(readings, root, f"{root}-offsets", delay="60 days").awaitTermination()
    return _daily(spark, root, DAY_SUMMARY)


def _daily(spark: SparkSession, root: str, statistics) -> DataFrame:
    """Both stored daily tables side by side."""
    weather, rain = (read_stored(spark, f"{root}/{spec.name}", spec)
                     for spec in (statistics, PRECIPITATION_TOTALS["day"]))
    both = weather.join(rain, ["city", "datetime"])
    both = both.withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))
    return rounded(both, *AVERAGES, "sum_precipitation")


def _stored_readings(spark: SparkSession, sf_dir: str, where=None) -> str:
    """The month's readings in a table below a new root."""
    root = scratch_path(spark, "root")
    obs = views.observations(spark, sf_dir)
    whole = views.as_observations(obs if where is None else obs.where(where))
    upsert(whole, jobs.table_path(root, OBSERVATIONS), OBSERVATIONS, rank=["temp", "pressure"])
    return root


@query
def process_day_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One day's two results, computed from stored readings and written to their tables."""
    root = _stored_readings(spark, sf_dir)
    jobs.process_day(spark, root, DAY)
    return _daily(spark, root, DAY_SUMMARY)


@query
def refresh_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All six aggregate tables after a roll-up and a refresh by a later batch."""
    late = F.pmod(F.crc32(F.encode("city", "UTF-8")), F.lit(5)) == 0
    root = _stored_readings(spark, sf_dir, ~late)
    jobs.rollup(spark, root)
    batch = views.as_observations(views.observations(spark, sf_dir).where(late))
    upsert(batch, jobs.table_path(root, OBSERVATIONS), OBSERVATIONS, rank=["temp", "pressure"])
    jobs.refresh(spark, root, batch)
    grains = []
    for grain in STATISTICS:
        weather, rain = (read_stored(spark, jobs.table_path(root, spec), spec)
                         for spec in (STATISTICS[grain], PRECIPITATION_TOTALS[grain]))
        grains.append(weather.join(rain, ["city", "datetime"]).withColumn("grain", F.lit(grain)))
    both = merging.union_batches(grains).withColumn("datetime", F.col("datetime").cast("timestamp_ntz"))
    return rounded(both, *AVERAGES, "sum_precipitation")


@query
def document_insert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents parsed and upserted into the readings, then read back."""
    obs = views.observations(spark, sf_dir)
    document = F.to_json(F.struct("city", timestamp_text("datetime").alias("datetime"), "main",
                                  F.col("temp").cast("string").alias("temp"), "pressure"))
    root = scratch_path(spark, "root")
    documents = obs.select(document.alias("doc"), F.struct("temp", "pressure", "main").alias("arrival"))
    jobs.insert_documents(documents, root, rank=["arrival"])
    stored = read_stored(spark, jobs.table_path(root, OBSERVATIONS), OBSERVATIONS)
    return stored.select("city", F.col("datetime").cast("timestamp_ntz").alias("datetime"), "main", "temp", "pressure")


@query
def table_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog table over an upserted path, read after a second upsert brought new directories."""
    path, database = scratch_path(spark, "catalog"), f"roundtrip_{uuid.uuid4().hex[:8]}"
    batches = _batches(spark, sf_dir)
    name = create_table(spark, database, views.LONG_READINGS, path)
    for batch in batches:
        upsert(batch, path, views.LONG_READINGS, RANK, table=name)
    copy = tables.read_table(spark, database, views.LONG_READINGS.name)
    write_table(copy, database, "copy", "overwrite", path=f"{path}-copy", compression="zstd")
    return spread(tables.read_table(spark, database, "copy").select(*views.LONG_SCHEMA.fieldNames()))


# -- stored results kept up by batches ---------------------------------------------

def _landed_in_turn(spark: SparkSession, sf_dir: str, arrival, run: Callable[[str], None]) -> None:
    """All payloads landed in turns, 0 first; copies of a key land in one file, and ``run`` takes each turn's files."""
    landing, second = scratch_path(spark, "landing"), F.get_json_object("raw", "$.dt").cast("long")
    landed = views.landed_payloads(spark, sf_dir).withColumn("_second", second).withColumn("_day", F.timestamp_seconds("_second"))
    for turn in range(3):
        part = landed.where(arrival == turn)
        part.repartition("city", "_second").drop("_second", "_day").write.mode("append").json(landing)
        run(landing)


def _far_late():
    """Readings of the month in two turns; a seventh of the first days', by city, comes last of all."""
    late = (F.pmod(F.crc32(F.encode("city", "UTF-8")), F.lit(7)) == 0) & (F.dayofmonth("_day") <= 3)
    return F.when(late, 2).otherwise((F.dayofmonth("_day") > 25).cast("int"))


@query
def stream_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each hour's directory of the readings holds after three streamed batches, the last of them weeks late."""
    path = scratch_path(spark, "readings")
    _landed_in_turn(spark, sf_dir, _far_late(), lambda landing: ingest(spark, landing, path, f"{path}-offsets").awaitTermination())
    stored = read_stored(spark, path, OBSERVATIONS, with_partition=True)
    return rounded(stored.groupBy(PARTITION).agg(
        F.count("*").alias("n_readings"), F.count_distinct("city").alias("n_cities"), F.avg("temp").alias("avg_temp")), "avg_temp")


@query
def stream_late_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily tables after readings weeks behind were ingested: each batch corrects the days it touches."""
    root = scratch_path(spark, "root")
    _landed_in_turn(spark, sf_dir, _far_late(),
                    lambda landing: jobs.run_ingest(spark, landing, root, f"{root}-offsets").awaitTermination())
    return _daily(spark, root, DAY_SUMMARY)


@query
def latest_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Current conditions kept by conditional upserts, in an order of batches that has nothing to do with time, one of them twice."""
    root, obs = scratch_path(spark, "root"), views.observations(spark, sf_dir)
    for turn in (2, 0, 1, 2):
        jobs.store_latest(views.as_observations(obs.where(F.pmod("humidity", F.lit(3)) == turn)), root)
    stored = read_stored(spark, jobs.table_path(root, LATEST), LATEST)
    return spread(stored.select("city", F.col("datetime").cast("timestamp_ntz").alias("datetime"), "main", "temp", "pressure", "precipitation"))


@query
def counter_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly precipitation counted batch by batch into a ledger; two batches come again, one after it was folded."""
    path, counted = scratch_path(spark, "counters"), ["sum_precipitation"]
    deltas = [rollups.precipitation(b, "month").withColumn("datetime", F.col("datetime").cast("timestamp")) for b in _batches(spark, sf_dir)]
    for number in (0, 1, 1):
        counters.add(deltas[number], path, number, KEY, counted)
    counters.fold(spark, path, 0, PRECIPITATION_SCHEMA, KEY, counted)
    for number in (0, 2):
        counters.add(deltas[number], path, number, KEY, counted)
    totals = counters.totals(spark, path, PRECIPITATION_SCHEMA, KEY, counted)
    return rounded(totals.withColumn("datetime", F.col("datetime").cast("timestamp_ntz")), *counted)


@query
def stream_first_poll(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First polls of a stream with repeats inside and outside the delay, which carry other values, and rows that are late."""
    landing, path = scratch_path(spark, "landing"), scratch_path(spark, "polls")
    obs = views.observations(spark, sf_dir).select("city", "datetime", "temp")
    day, tenth = F.dayofmonth("datetime"), F.expr("substr(city, 6)").cast("int") % 10
    held = F.when((tenth == 0) & (day <= 10), 2).when((tenth == 1) & (day == 20), 2)  # too late, and just in time
    turn = F.coalesce(held, F.when(day <= 10, 0).when(day <= 20, 1).otherwise(2))
    again = obs.withColumn("temp", F.col("temp") + 1000)
    for arrival in range(3):
        rows = obs.where(turn == arrival)
        if arrival:  # of all that came before, recent and long past
            rows = rows.unionByName(again.where(turn < arrival))
        rows.write.mode("append").parquet(landing)
        keep_first_polls(spark.readStream.schema(obs.schema).parquet(landing), path, f"{path}-offsets", "2 days").awaitTermination()
    return spark.read.parquet(path).select("city", F.col("datetime").cast("timestamp_ntz").alias("datetime"), "temp")


@query
def trend_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored trends after batches out of order: a late reading changes its own row and its successor's."""
    root, obs = scratch_path(spark, "root"), views.observations(spark, sf_dir)
    day = F.dayofmonth("datetime")
    late = (F.pmod(F.xxhash64("city", "datetime"), F.lit(3)) == 0) & day.between(10, 12)
    turn = F.when(late, 1).otherwise(F.when(day <= 2, 2).otherwise(0))  # some between others, then some before all others
    for arrival in range(3):
        batch = views.as_observations(obs.where(turn == arrival)).cache()
        upsert(batch, jobs.table_path(root, OBSERVATIONS), OBSERVATIONS, rank=["temp", "pressure"])
        jobs.refresh(spark, root, batch)
        jobs.refresh_trends(spark, root, batch, ["temp", "pressure"], TRENDS)
        batch.unpersist()
    stored = read_stored(spark, jobs.table_path(root, TRENDS), TRENDS)
    return rounded(stored.withColumn("datetime", F.col("datetime").cast("timestamp_ntz")), "temp_delta", "pressure_delta")


@query
def scan_city_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One city's days from the stored readings: directories by time, row groups by the city's filter and order."""
    root = _stored_readings(spark, sf_dir)
    start, end = period_range("day", datetime(2024, 1, 5), datetime(2024, 1, 8))
    stored = read_stored(spark, jobs.table_path(root, OBSERVATIONS), OBSERVATIONS, start, end)
    return tables.of_city(stored, CITY).select("city", F.col("datetime").cast("timestamp_ntz").alias("datetime"), "main", "temp", "pressure")


@query
def coverage_from_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly coverage merged from the days' sketches, without readings; these few cities come out exact."""
    days = places.coverage_partials(views.listed_cities(spark, sf_dir), views.observations(spark, sf_dir))
    return places.coverage_from_partials(days, "month")


@query
def json_variant(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads read as open objects: the rows are those of the closed form."""
    return views.flat_readings(payloads.parse_variants(views.landed_payloads(spark, sf_dir)))


@query
def json_unseen_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that payloads carry beyond the schema, with their types and counts."""
    landed = views.landed_payloads(spark, sf_dir)
    second = F.get_json_object("raw", "$.dt").cast("long")
    extra = (F.when(second % 3 == 0, F.concat(F.lit('"uvi":'), (second % 11).cast("string"), F.lit(',"base":"stations",')))
             .when(second % 3 == 1, F.lit('"alert":{"level":2},')).otherwise(""))
    opened = landed.withColumn("raw", F.concat(F.lit("{"), extra, F.expr("substr(raw, 2)")))
    return payloads.unseen_keys(opened.withColumn("raw", F.regexp_replace("raw", '"wind":\\{', '"wind":{"dir":"N",')))


@query
def trend_bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trends over readings bucketed and sorted by city and day: the readings are not shuffled again."""
    database = f"bucketed_{uuid.uuid4().hex[:8]}"
    obs = views.observations(spark, sf_dir).select("city", "datetime", "temp", "pressure")
    name = write_bucketed(obs, database, "readings", scratch_path(spark, "bucketed"), 8)
    changes = series.trend(spark.table(name), ["temp", "pressure"], day="day")
    return rounded(changes, "temp_delta", "pressure_delta")


@query
def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good rows of a CSV of cities, and the lines turned away with the reason."""
    path = scratch_path(spark, "cities-csv")
    city = views.numbered_cities(spark, sf_dir)
    value = lambda c: F.col(c).cast("string")
    kind = F.col("city_id") % 5
    line = (F.when(kind == 0, F.concat_ws(",", "city", value("lat"), value("lng")))
            .when(kind == 1, F.concat_ws(",", "city", value("lat"), F.lit("east"), value("country_id"), value("city_id")))
            .when(kind == 2, F.concat_ws(",", F.lit(""), value("lat"), value("lng"), value("country_id"), value("city_id")))
            .when(kind == 3, F.concat_ws(",", "city", value("lat"), value("lng"), value("country_id"), value("city_id"), F.lit("x")))
            .otherwise(F.concat_ws(",", F.concat(F.lit('"'), "city", F.lit(', in all"')), value("lat"), value("lng"), value("country_id"), value("city_id"))))
    # One column whose name is the header; separator and quote stand in no line, so lines are written as they are.
    city.select(line.alias(",".join(CITIES_SCHEMA.fieldNames()))).write.csv(path, header=True, sep="\x01", quote="\x02")
    good, away = dimensions.read_with_rejects(spark, path, CITIES_SCHEMA)
    return merging.union_batches([good.select("city", "city_id", F.lit("kept").alias("outcome")), away.select(F.col("reason").alias("outcome"), "line")])
