"""JSON readings to typed rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructField, StructType

from isobar.functions.readings import (
    EPOCH_RANGE, epoch_to_timestamp, first_field, hourly_amount, kelvin_to_celsius,
)
from isobar.schemas import FLAT_SCHEMA, LANDED_SCHEMA, OBSERVATION_SCHEMA, PAYLOAD_SCHEMA

KELVIN_FIELDS = ("temp", "feels_like", "temp_min", "temp_max")


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """Landed files: JSON lines of ``city`` and the raw payload text."""
    return spark.read.schema(LANDED_SCHEMA).json(path)


def parse_payloads(landed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """One typed row per payload that has a time; see ``rejected_payloads`` for the others.

    Each text is parsed once: a filter on a field of ``from_json`` would be pushed
    below the projection and parse the text again, but does not cross the generator.
    A number that does not fit its column is null, the row stays.
    """
    parsed = _parsed(landed, keep).filter(F.col("dt").between(*EPOCH_RANGE))
    values = {
        "city": F.col("_city"),
        "datetime": epoch_to_timestamp("dt"),
        "main": first_field("weather", "main"),
        "description": first_field("weather", "description"),
        **{name: kelvin_to_celsius(f"main.{name}") for name in KELVIN_FIELDS},
        **{name: F.col(f"main.{name}") for name in ("pressure", "humidity", "sea_level", "grnd_level")},
        "precipitation": F.struct(hourly_amount("rain").alias("rain"), hourly_amount("snow").alias("snow")),
        "wind": F.struct("wind.speed", "wind.deg", "wind.gust"),
        "clouds": F.col("clouds.all"),
        "sunrise": epoch_to_timestamp("sys.sunrise"),
        "sunset": epoch_to_timestamp("sys.sunset"),
    }
    return _observations(parsed, values, keep)


def rejected_payloads(landed: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """city, raw and the reason of every payload that gives no reading."""
    time = F.col("dt")
    reason = (
        F.when(F.col("_raw").isNull(), "no payload")
        .when(F.get_json_object("_raw", "$").isNull(), "broken text")
        .when(time.isNull(), "no time")
        .when(~time.between(*EPOCH_RANGE), "time out of range")
    )
    return _parsed(landed, keep).select(F.col("_city").alias("city"), F.col("_raw").alias("raw"), *keep, reason.alias("reason")).filter(
        F.col("reason").isNotNull())


def _variants(landed: DataFrame) -> DataFrame:
    return landed.select(F.col("city").alias("_city"), F.inline(F.array(F.struct(F.try_parse_json("raw").alias("v")))))


def parse_variants(landed: DataFrame, keep_open: bool = False) -> DataFrame:
    """The rows of :func:`parse_payloads`, read from open objects: with ``keep_open`` each carries its whole payload as ``payload``.

    A value of another type than its column's is null, as is a number that doesn't fit.
    """
    at = lambda path, kind: F.try_variant_get("v", path, kind)
    amount = lambda name: F.coalesce(at(f"$.{name}['1h']", "double"), F.lit(0.0)).alias(name)
    timed = _variants(landed).withColumn("dt", at("$.dt", "double")).filter(F.col("dt").between(*EPOCH_RANGE))
    epoch = lambda path: epoch_to_timestamp(at(path, "double"))
    values = {
        "city": F.col("_city"),
        "datetime": epoch_to_timestamp("dt"),
        "main": at("$.weather[0].main", "string"),
        "description": at("$.weather[0].description", "string"),
        **{name: kelvin_to_celsius(at(f"$.main.{name}", "double")) for name in KELVIN_FIELDS},
        **{name: at(f"$.main.{name}", "double") for name in ("pressure", "humidity", "sea_level", "grnd_level")},
        "visibility": at("$.visibility", "double"),
        "precipitation": F.struct(amount("rain"), amount("snow")),
        "wind": F.struct(*[at(f"$.wind.{name}", "double").alias(name) for name in ("speed", "deg", "gust")]),
        "clouds": at("$.clouds.all", "double"),
        "sunrise": epoch("$.sys.sunrise"),
        "sunset": epoch("$.sys.sunset"),
    }
    columns = [values[f.name].try_cast(f.dataType).alias(f.name) for f in OBSERVATION_SCHEMA.fields]
    return timed.select(*columns, *([F.col("v").alias("payload")] if keep_open else []))


def unseen_keys(landed: DataFrame) -> DataFrame:
    """path, kind (type of its values) and n of every key that the payload's schema lacks, at the top or one level down."""
    spark, known = landed.sparkSession, {f.name: f.dataType for f in PAYLOAD_SCHEMA.fields}
    objects = [n for n, kind in known.items() if isinstance(kind, StructType)]
    within = [f"{n}.{f}" for n in objects for f in known[n].fieldNames()]
    v = _variants(landed).select("v").where("v IS NOT NULL AND startswith(schema_of_variant(v), 'OBJECT')")
    return spark.sql("""
        WITH tops AS (SELECT t.key AS path, t.value AS value FROM {v}, LATERAL variant_explode(v) t),
             nested AS (SELECT concat(tops.path, '.', t.key) AS path, t.value AS value
                        FROM tops, LATERAL variant_explode(tops.value) t
                        WHERE array_contains(:objects, tops.path) AND startswith(schema_of_variant(tops.value), 'OBJECT'))
        SELECT path, schema_of_variant(value) AS kind, count(*) AS n
        FROM (SELECT * FROM tops WHERE NOT array_contains(:tops, path) UNION ALL
              SELECT * FROM nested WHERE NOT array_contains(:within, path))
        GROUP BY path, schema_of_variant(value)""",
        args={"objects": objects, "tops": list(known), "within": within}, v=v)


def _parsed(landed: DataFrame, keep: Sequence[str]) -> DataFrame:
    return landed.select(
        F.col("city").alias("_city"), F.col("raw").alias("_raw"), *[c for c in keep if c != "raw"],
        *([F.col("raw")] if "raw" in keep else []), F.inline(F.array(F.from_json("raw", PAYLOAD_SCHEMA))))


def parse_flat_documents(documents: DataFrame, column: str = "doc", keep: Sequence[str] = ()) -> DataFrame:
    """The flat Kelvin variant with epoch ``time``, brought to the same typed rows."""
    parsed = documents.select(
        *keep, F.inline(F.array(F.from_json(column, FLAT_SCHEMA)))
    ).filter(F.col("time").between(*EPOCH_RANGE))
    amount = lambda name: hourly_amount(F.from_json(f"precipitation.{name}", "map<string, double>"))
    values = {
        "datetime": epoch_to_timestamp("time"),
        **{name: kelvin_to_celsius(name) for name in KELVIN_FIELDS},
        "precipitation": F.struct(amount("rain").alias("rain"), amount("snow").alias("snow")),
        "sunrise": epoch_to_timestamp("sunrise"),
        "sunset": epoch_to_timestamp("sunset"),
    }
    return _observations(parsed, values, keep)


def rows_from_documents(documents: DataFrame, schema: StructType = OBSERVATION_SCHEMA,
                        column: str = "doc", strict: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """One row of ``schema`` per JSON document, whatever JSON type a value came in.

    Absent keys become null and text is cast to the column's type. A value that
    cannot be cast fails the query; with ``strict=False`` it becomes null.
    """
    parsed = documents.select(
        *[F.col(c).alias(f"_keep_{c}") for c in keep],
        F.inline(F.array(F.from_json(column, _as_text(schema)))),
    )
    cast = lambda f: F.col(f.name).cast(f.dataType) if strict else F.col(f.name).try_cast(f.dataType)
    return parsed.select(
        *[F.col(f"_keep_{c}").alias(c) for c in keep],
        *[cast(f).alias(f.name) for f in schema.fields],
    )


def to_documents(df: DataFrame, column: str = "doc", keep: Sequence[str] = ()) -> DataFrame:
    """Each row as one JSON document."""
    return df.select(*keep, F.to_json(F.struct(*df.columns)).alias(column))


def _observations(parsed: DataFrame, values: dict[str, Column], keep: Sequence[str]) -> DataFrame:
    return parsed.select(*keep, *[
        values.get(f.name, F.col(f.name)).try_cast(f.dataType).alias(f.name)
        for f in OBSERVATION_SCHEMA.fields
    ])


def _as_text(kind: DataType) -> DataType:
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, _as_text(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(_as_text(kind.elementType))
    return StringType()
