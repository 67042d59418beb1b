"""Catalog tables and plain writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from isobar.functions.temporal import bucket
from isobar.schemas import PARTITION, TableSpec, columns_ddl
from isobar.sinks.files import Folder

MODES = ("append", "overwrite", "ignore")
# Formats that a catalog table can hold; any other name is a connector.
CATALOG_FORMATS = ("parquet", "orc", "json", "csv", "text")


def create_table(spark: SparkSession, database: str, spec: TableSpec, location: str | None = None) -> str:
    """Create the database and table where absent; with ``location``, over an upserted path."""
    name = f"`{database}`.`{spec.name}`"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    at = "LOCATION '" + location.replace("'", "\\'") + "'" if location else ""
    spark.sql(f"""
        CREATE TABLE IF NOT EXISTS {name} ({columns_ddl(spec.stored_schema)})
        USING parquet PARTITIONED BY ({PARTITION}) {at}
        TBLPROPERTIES ('key' = '{",".join(spec.keys)}', 'layout' = '{spec.grain or spec.buckets}')
    """)
    known = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if known.get("layout") != f"{spec.grain or spec.buckets}":
        raise ValueError(f"{name} is laid out by {known.get('layout')}, not {spec.grain or spec.buckets}")
    if location and Folder(spark, location).has(""):
        spark.sql(f"MSCK REPAIR TABLE {name}")
        spark.catalog.refreshTable(name)
    return name


def write_bucketed(df: DataFrame, database: str, table: str, location: str, buckets: int, day: str = "day") -> str:
    """Readings as a table of one file for each bucket of (city, day), each sorted: joins and windows by both need no shuffle.

    A city is spread over its days, so a hot one fills no bucket.
    """
    name = f"`{database}`.`{table}`"
    df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS `{database}`")
    keyed = df.withColumn(day, bucket(df, "day"))
    (keyed.repartition(buckets, "city", day).write.mode("overwrite").option("path", location)
        .bucketBy(buckets, "city", day).sortBy("city", day, "datetime").saveAsTable(name))
    return name


def write_table(df: DataFrame, database: str, table: str, mode: str = "append", fmt: str = "parquet",
                partition_by: Sequence[str] = (), names: tuple[str, str] = ("keyspace", "table"), **options: str) -> None:
    """Write to a catalog table with the format's options, or through a connector.

    A connector is any format that is not a built-in file format; it gets the database
    and table as the options called ``names``.

    This is the plain write: ``append`` does not look at keys, see
    :func:`isobar.sinks.upsert.upsert` for that.
    """
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}, not {mode}")
    writer = df.write.format(fmt).mode(mode).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt in CATALOG_FORMATS:
        writer.saveAsTable(f"`{database}`.`{table}`")
    else:
        writer.options(**dict(zip(names, (database, table)))).save()
