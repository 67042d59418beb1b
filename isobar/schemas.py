"""Column types, keys and physical layout of every table."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import (
    ArrayType, DataType, DateType, DecimalType, DoubleType, IntegerType, LongType, MapType,
    StringType, StructField, StructType, TimestampType,
)

from isobar.functions.temporal import DIRECTORY_GRAINS, bucket, floor_to

PARTITION = "part"

TEXT, DOUBLE, INT, LONG, TIME = StringType(), DoubleType(), IntegerType(), LongType(), TimestampType()


def columns(required: tuple[str, ...] = (), /, **kinds: DataType) -> StructType:
    return StructType([StructField(name, kind, name not in required) for name, kind in kinds.items()])


KEY = ("city", "datetime")

# Names and types of the data model.
WIND = columns(speed=DOUBLE, deg=DOUBLE, gust=DOUBLE)
PRECIPITATION = columns(rain=DOUBLE, snow=DOUBLE)
OBSERVATION_SCHEMA = columns(
    KEY, city=TEXT, datetime=TIME, main=TEXT, description=TEXT,
    temp=DOUBLE, feels_like=DOUBLE, temp_min=DOUBLE, temp_max=DOUBLE, pressure=DOUBLE,
    humidity=DecimalType(38, 18), sea_level=DOUBLE, grnd_level=DOUBLE, visibility=INT,
    wind=WIND, precipitation=PRECIPITATION, clouds=INT, sunrise=TIME, sunset=TIME,
)
STATISTICS_SCHEMA = columns(
    KEY, city=TEXT, datetime=TIME, avg_pressure=DOUBLE, avg_temp=DOUBLE, temp_min=DOUBLE, temp_max=DOUBLE,
)
PRECIPITATION_SCHEMA = columns(KEY, city=TEXT, datetime=TIME, sum_precipitation=DOUBLE)
PARTIALS_SCHEMA = columns(
    KEY, city=TEXT, datetime=TIME, n=LONG, temp_sum=DOUBLE, temp_count=LONG,
    pressure_sum=DOUBLE, pressure_count=LONG, temp_min=DOUBLE, temp_max=DOUBLE, low=DOUBLE, high=DOUBLE,
    sum_precipitation=DOUBLE,
)
TRENDS_SCHEMA = columns(
    KEY, city=TEXT, datetime=TIME, temp=DOUBLE, pressure=DOUBLE, temp_delta=DOUBLE, pressure_delta=DOUBLE,
)
CITIES_SCHEMA = columns(("city",), city=TEXT, lat=DOUBLE, lng=DOUBLE, country_id=INT, city_id=LONG)
COUNTRIES_SCHEMA = columns(("id",), id=INT, name=TEXT, subregion=TEXT, region=TEXT)

# Raw reading as delivered: Kelvin, epoch seconds, amounts per hour under '1h'. Whole
# numbers may come with a decimal point, so they are read as doubles and cast.
PAYLOAD_SCHEMA = columns(
    dt=DOUBLE,
    weather=ArrayType(columns(main=TEXT, description=TEXT)),
    main=columns(temp=DOUBLE, feels_like=DOUBLE, temp_min=DOUBLE, temp_max=DOUBLE,
                 pressure=DOUBLE, humidity=DOUBLE, sea_level=DOUBLE, grnd_level=DOUBLE),
    visibility=DOUBLE, wind=WIND, rain=MapType(TEXT, DOUBLE), snow=MapType(TEXT, DOUBLE),
    clouds=columns(all=DOUBLE), sys=columns(sunrise=DOUBLE, sunset=DOUBLE),
)
# The same reading already flattened, with Kelvin, epoch ``time`` and rain/snow
# either a whole object or the number 0, hence text.
FLAT_SCHEMA = columns(
    city=TEXT, time=DOUBLE, main=TEXT, description=TEXT, temp=DOUBLE, feels_like=DOUBLE,
    temp_min=DOUBLE, temp_max=DOUBLE, pressure=DOUBLE, humidity=DOUBLE, sea_level=DOUBLE,
    grnd_level=DOUBLE, visibility=DOUBLE, wind=WIND, precipitation=columns(rain=TEXT, snow=TEXT),
    clouds=DOUBLE, sunrise=DOUBLE, sunset=DOUBLE,
)
LANDED_SCHEMA = columns(city=TEXT, raw=TEXT)


@dataclass(frozen=True)
class TableSpec:
    """A keyed table and its file layout.

    ``grain`` names the calendar period one directory holds. Tables without a
    time key leave it None and are spread over ``buckets`` hashed directories.
    Directories never follow ``city``: that would be one small file per city, and
    a third of the table behind a hot one. ``bloom`` columns get a filter in each row group,
    which lookups of a single value are answered by.
    """

    name: str
    schema: StructType
    keys: tuple[str, ...]
    grain: str | None = None
    buckets: int = 1
    bloom: tuple[str, ...] = ()
    group_bytes: int | None = None

    def __post_init__(self):
        if self.grain is not None and self.grain not in DIRECTORY_GRAINS:
            raise ValueError(f"unknown grain {self.grain}")

    @property
    def file_options(self) -> dict[str, str]:
        """Writer options: bloom filters, and row groups small enough for them and the sort to skip by."""
        options = {f"parquet.bloom.filter.enabled#{c}": "true" for c in self.bloom}
        options |= {f"parquet.bloom.filter.candidates.number#{c}": "12" for c in self.bloom}
        if self.bloom:  # as large as the row group's values need, from 1 KB up; else each would take 1 MB
            options["parquet.bloom.filter.adaptive.enabled"] = "true"
        return options | ({"parquet.block.size": str(self.group_bytes)} if self.group_bytes else {})

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def stored_schema(self) -> StructType:
        kind = TEXT if self.grain == "hour" else DateType() if self.grain else INT
        return StructType(self.schema.fields + [StructField(PARTITION, kind)])

    def partition(self, df: DataFrame) -> Column:
        if self.grain == "hour":
            return F.date_format(bucket(df, "hour"), "yyyy-MM-dd-HH")
        if self.grain:
            return bucket(df, self.grain).cast("date")
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def part(self, instant: datetime) -> date | str:
        """The directory that holds an instant, as a value of the partition column; such values sort by time."""
        start = floor_to(self.grain, instant)
        return f"{start:%Y-%m-%d-%H}" if self.grain == "hour" else start.date()

    def sort_columns(self) -> list[Column]:
        """Stored order: newest first within a city, otherwise by key."""
        return [F.desc(k) if k == "datetime" else F.asc(k) for k in self.keys]


# A directory is rewritten whole, so each table's holds no longer a period than a batch of fresh readings touches.
OBSERVATIONS = TableSpec("realtime_weather", OBSERVATION_SCHEMA, KEY, "hour", bloom=("city",), group_bytes=16 << 20)
LATEST = TableSpec("latest_weather", OBSERVATION_SCHEMA, ("city",), buckets=16)
TRENDS = TableSpec("weather_trend", TRENDS_SCHEMA, KEY, "hour")
HOURLY_PARTIALS = TableSpec("hourly_partials", PARTIALS_SCHEMA, KEY, "hour")
DAILY_PARTIALS = TableSpec("daily_partials", PARTIALS_SCHEMA, KEY, "day")
MONTHLY_PARTIALS = TableSpec("monthly_partials", PARTIALS_SCHEMA, KEY, "month")
# Daily extremes of ``temp`` itself; those of STATISTICS are of the readings' own temp_min and temp_max.
DAY_SUMMARY = TableSpec("daily_summary", STATISTICS_SCHEMA, KEY, "day")
CITIES = TableSpec("cities", CITIES_SCHEMA, ("city",), buckets=4)
COUNTRIES = TableSpec("countries", COUNTRIES_SCHEMA, ("id",), buckets=1)

STATISTICS = {
    "day": TableSpec("daily_aggregate", STATISTICS_SCHEMA, KEY, "day"),
    "month": TableSpec("monthly_aggregate", STATISTICS_SCHEMA, KEY, "month"),
    "year": TableSpec("yearly_aggregate", STATISTICS_SCHEMA, KEY, "year"),
}
PRECIPITATION_TOTALS = {
    "day": TableSpec("daily_precipitation_aggregate", PRECIPITATION_SCHEMA, KEY, "day"),
    "month": TableSpec("monthly_precipitation_aggregate", PRECIPITATION_SCHEMA, KEY, "month"),
    "year": TableSpec("yearly_precipitation_aggregate", PRECIPITATION_SCHEMA, KEY, "year"),
}
TABLES = {
    spec.name: spec
    for spec in (OBSERVATIONS, LATEST, TRENDS, HOURLY_PARTIALS, DAILY_PARTIALS, MONTHLY_PARTIALS, DAY_SUMMARY, CITIES, COUNTRIES,
                 *STATISTICS.values(), *PRECIPITATION_TOTALS.values())
}


def columns_ddl(schema: StructType) -> str:
    """Column list of a CREATE TABLE statement."""
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
