"""The test tables shaped as readings, cities, countries and payloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import TimestampNTZType

from isobar.schemas import DOUBLE, KEY, OBSERVATION_SCHEMA, PRECIPITATION, TEXT, TableSpec, columns

LONG_SCHEMA = columns(
    KEY, city=TEXT, datetime=TimestampNTZType(), temp=DOUBLE, temp_min=DOUBLE, temp_max=DOUBLE,
    pressure=DOUBLE, precipitation=PRECIPITATION,
)
LONG_READINGS = TableSpec("long_readings", LONG_SCHEMA, KEY, "year")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def place(key: str) -> Column:
    return F.concat(F.lit("CITY_"), F.col(key))


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of one month, (city, datetime) unique, from ``events``."""
    k = F.get_json_object("props", "$.k").cast("int")
    temp = F.round(F.col("value") - 273.15, 2)
    amount = lambda kind: F.when(F.col("event_type") == kind, F.col("value") / 100)
    return table(spark, sf_dir, "events").select(
        place("user_id").alias("city"),
        F.col("ts").alias("datetime"),
        F.col("event_type").alias("main"),
        F.col("value").alias("temp_k"),
        temp.alias("temp"),
        (temp - k / F.lit(10.0)).alias("temp_min"),
        (temp + k / F.lit(10.0)).alias("temp_max"),
        (F.lit(950.0) + k).cast("double").alias("pressure"),
        k.alias("humidity"),
        F.struct(amount("view").alias("rain"), amount("signup").alias("snow")).alias("precipitation"),
    )


def observations_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Readings of seven years with repeated keys, in three batches, from ``lineitem``."""
    temp = F.col("l_extendedprice") / 1000
    return table(spark, sf_dir, "lineitem").select(
        place("l_suppkey").alias("city"),
        F.col("l_shipdate").alias("datetime"),
        temp.alias("temp"),
        (temp - F.col("l_quantity")).alias("temp_min"),
        (temp + F.col("l_quantity")).alias("temp_max"),
        F.col("l_quantity").alias("pressure"),
        F.struct(F.col("l_discount").alias("rain"), F.col("l_tax").alias("snow")).alias("precipitation"),
        F.col("l_returnflag").alias("batch"), "l_orderkey", "l_linenumber", "l_partkey",
    )


def in_units(readings: DataFrame) -> DataFrame:
    """Measures as whole numbers of 1e-5."""
    units = lambda c: F.round(F.col(c) * 1e5)
    return readings.withColumns({
        **{c: units(c).cast("long") for c in ("temp", "temp_min", "temp_max", "pressure")},
        "precipitation": F.struct(*[units(f"precipitation.{c}").alias(c) for c in ("rain", "snow")]),
    })


def cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities that readings come from."""
    return table(spark, sf_dir, "events").select("user_id").distinct().select(
        place("user_id").alias("city"),
        (F.col("user_id") - 75).cast("double").alias("lat"),
        (F.col("user_id") * 2 - 150).cast("double").alias("lng"),
        (F.col("user_id") % 25).cast("int").alias("country_id"),
    )


def numbered_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cities(spark, sf_dir).withColumn("city_id", (F.col("lat") + 1075).cast("long"))


def as_observations(obs: DataFrame) -> DataFrame:
    """Readings with every column of the stored table; what the fixture lacks is null."""
    value = lambda f: F.col(f.name) if f.name in obs.columns else F.lit(None)
    return obs.select(*[value(f).cast(f.dataType).alias(f.name) for f in OBSERVATION_SCHEMA])


def listed_cities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longer list of cities to be polled; many have no readings."""
    return table(spark, sf_dir, "customer").select(
        place("c_custkey").alias("city"), F.col("c_nationkey").alias("country_id"),
    )


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, nation.n_regionkey == region.r_regionkey).select(
        F.col("n_nationkey").alias("id"),
        F.col("n_name").alias("name"),
        F.concat("r_name", F.lit("_"), (F.col("n_nationkey") % 3).cast("string")).alias("subregion"),
        F.col("r_name").alias("region"),
    )


def landed_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every reading as (city, raw payload text)."""
    obs = observations(spark, sf_dir)
    k, kelvin = F.col("humidity"), F.col("temp_k")
    day = F.unix_timestamp(F.date_trunc("day", "datetime"))
    hourly = lambda name: F.when(
        F.col(f"precipitation.{name}").isNotNull(),
        F.create_map(F.lit("1h"), F.col(f"precipitation.{name}")))
    entry = F.struct(F.col("main").alias("main"), F.concat(F.lit("it's "), "main").alias("description"))
    payload = F.struct(
        F.unix_timestamp(F.col("datetime").cast("timestamp")).alias("dt"),
        F.when(F.col("main") == "error", F.array().cast("array<struct<main:string,description:string>>"))
         .otherwise(F.array(entry)).alias("weather"),
        F.struct(
            kelvin.alias("temp"),
            (kelvin - k / F.lit(10.0)).alias("temp_min"),
            (kelvin + k / F.lit(10.0)).alias("temp_max"),
            F.col("pressure").alias("pressure"),
            k.cast("double").alias("humidity"),
        ).alias("main"),
        (k * 100).alias("visibility"),
        F.struct((kelvin / 10).alias("speed"), k.cast("double").alias("deg")).alias("wind"),
        hourly("rain").alias("rain"),
        hourly("snow").alias("snow"),
        F.struct(k.alias("all")).alias("clouds"),
        F.struct((day + 21600).alias("sunrise"), (day + 64800).alias("sunset")).alias("sys"),
    )
    return obs.select("city", F.to_json(payload).alias("raw"))


def rough_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Payloads as a service may send them: some missing, broken, without or with odd times and numbers."""
    k, second = F.col("humidity"), F.unix_timestamp(F.col("datetime").cast("timestamp"))
    decimal = F.concat(second.cast("string"), F.lit(".0"))
    text = lambda dt, humidity, rest="": F.concat(
        F.lit('{"dt":'), dt, F.lit(',"main":{"humidity":'), humidity, F.lit('},"visibility":'), k.cast("string"), F.lit(".0}"))
    raw = (
        F.when(k % 7 == 0, F.lit(None).cast("string"))
        .when(k % 7 == 1, F.lit('{"dt": 17'))
        .when(k % 7 == 2, F.lit('{"main": {"humidity": 5}}'))
        .when(k % 7 == 3, text(F.lit("100000000000000000"), F.lit("5")))
        .when(k % 7 == 4, text(decimal, F.lit("100000.25")))
        .otherwise(text(decimal, F.lit("55.126")))
    )
    return observations(spark, sf_dir).select("city", raw.alias("raw"))


def flat_readings(observed: DataFrame) -> DataFrame:
    """Typed readings with structs spread and zone-free times, for comparison."""
    nested = {"wind": ("speed", "deg", "gust"), "precipitation": ("rain", "snow")}
    ntz = ("datetime", "sunrise", "sunset")
    columns = []
    for name in observed.columns:
        if name in nested:
            prefix = "wind_" if name == "wind" else ""
            columns += [F.col(f"{name}.{f}").alias(prefix + f) for f in nested[name]]
        elif name in ntz:
            columns.append(F.col(name).cast("timestamp_ntz").alias(name))
        elif name == "humidity":
            columns.append(F.col(name).cast("double").alias(name))
        else:
            columns.append(F.col(name))
    return observed.select(*columns)
