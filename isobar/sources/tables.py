"""Keyed table scans and SQL with bound parameters."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, database: str, table: str,
               columns: Sequence[str] | None = None, where: Column | str | None = None,
               fmt: str | None = None, names: tuple[str, str] = ("keyspace", "table"), **options: str) -> DataFrame:
    """Scan a catalog table, or a connector's when its format is given.

    Reader options apply to either; a connector gets the database and table as the options
    called ``names``. A built-in file format is read by its ``path`` option.

    The predicate is applied before the projection, so it may use columns that
    are not selected; both reach the scan.
    """
    reader = spark.read.options(**options)
    if fmt is None:
        df = reader.table(f"`{database}`.`{table}`")
    elif "path" in options:
        df = reader.format(fmt).load()
    else:
        df = reader.format(fmt).options(**dict(zip(names, (database, table)))).load()
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df


def of_city(df: DataFrame, city: str) -> DataFrame:
    """Readings of one city."""
    return df.filter(F.col("city") == city)


LISTED_CITIES = 200  # a longer list is a table of its own, not a predicate


def of_cities(df: DataFrame, cities: DataFrame | Sequence[str]) -> DataFrame:
    """Readings of many cities: a list, or a frame with a ``city`` column."""
    if not isinstance(cities, DataFrame) and len(cities) > LISTED_CITIES:
        cities = df.sparkSession.createDataFrame([(c,) for c in cities], "city string")
    if isinstance(cities, DataFrame):
        return df.join(cities.select("city"), "city", "left_semi")
    return df.filter(F.col("city").isin(list(cities)))


def run_sql(spark: SparkSession, query: str, params: dict[str, Any] | None = None,
            **frames: DataFrame) -> DataFrame:
    """Run SQL with ``:name`` parameters bound as literals and ``{name}`` frames as tables."""
    return spark.sql(query, args=params, **frames)
