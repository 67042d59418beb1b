from __future__ import annotations

import dataclasses

import pytest
from pyspark.sql.types import StructType

from isobar.operators.merging import union_batches
from isobar.schemas import CITIES, OBSERVATIONS, columns_ddl
from isobar.sinks.tables import create_table, write_table
from isobar.sinks.upsert import replace, upsert
from isobar.sources.tables import of_cities, of_city, read_table, run_sql


@pytest.fixture
def database(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS climate")
    yield "climate"
    spark.sql("DROP DATABASE climate CASCADE")


def test_create_table(spark, database):
    for _ in range(2):
        create_table(spark, database, OBSERVATIONS)
    table = spark.table("climate.realtime_weather")
    assert [(f.name, f.dataType) for f in table.schema] == [
        (f.name, f.dataType) for f in OBSERVATIONS.stored_schema]
    properties = dict(tuple(r) for r in spark.sql("SHOW TBLPROPERTIES climate.realtime_weather").collect())
    assert properties["key"] == "city,datetime"


def test_ddl_of_types(spark):
    ddl = columns_ddl(OBSERVATIONS.schema)
    assert "`humidity` decimal(38,18)" in ddl and "`wind` struct<speed:double,deg:double,gust:double>" in ddl
    assert StructType.fromDDL(ddl).fieldNames() == OBSERVATIONS.columns


def test_catalog_table_over_an_upserted_path(spark, database, tmp_path):
    path = str(tmp_path / "cities")
    upsert(spark.createDataFrame([("A", 1.0, 2.0, 3, 4)], CITIES.schema), path, CITIES, [])
    name = create_table(spark, database, CITIES, path)
    assert spark.table(name).select("city", "country_id").collect() == [("A", 3)]
    more = spark.createDataFrame([(c, 1.0, 2.0, 5, 6) for c in "BCDEFGHIJK"], CITIES.schema)
    upsert(more, path, CITIES, [], table=name)
    assert spark.table(name).count() == 11
    replace(more.where("city < 'D'"), path, CITIES, table=name)
    assert {r.city for r in spark.table(name).collect()} == {"B", "C"}
    with pytest.raises(ValueError, match="laid out"):
        create_table(spark, database, dataclasses.replace(CITIES, buckets=8), path)


def test_write_modes(spark, database):
    one = spark.createDataFrame([("A", 1)], "city string, v int")
    two = spark.createDataFrame([("B", 2)], "city string, v int")
    write_table(one, database, "t", partition_by=["city"])
    write_table(two, database, "t", partition_by=["city"])
    assert spark.table("climate.t").count() == 2
    write_table(one, database, "t", mode="ignore")
    assert spark.table("climate.t").count() == 2
    write_table(two, database, "t", mode="overwrite")
    assert spark.table("climate.t").collect() == [("B", 2)]
    with pytest.raises(ValueError):
        write_table(two, database, "t", mode="replace")


def test_connector_format(spark, database, tmp_path):
    path = str(tmp_path / "t")
    df = spark.createDataFrame([("A", 1), ("B", 2)], "city string, v int")
    write_table(df, database, "t", fmt="orc", path=path, compression="zlib")
    assert read_table(spark, database, "t", ["v"], "city = 'B'").collect() == [(2,)]
    assert read_table(spark, database, "t", ["v"], "city = 'B'", fmt="orc", path=path).collect() == [(2,)]
    # A connector gets the names as options; this one takes one of them as its path.
    write_table(df, path, "t", fmt="org.apache.spark.sql.execution.datasources.orc.OrcFileFormat", mode="overwrite", names=("path", "table"))
    assert spark.read.orc(path).count() == 2


def test_scan_pushes_predicate_and_columns(spark, database):
    write_table(spark.createDataFrame([("A", 1, 2.0), ("B", 2, 3.0)], "city string, v int, w double"), database, "s")
    found = read_table(spark, database, "s", ["v"], "city = 'B'")
    assert found.collect() == [(2,)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(city,B)" in plan and "ReadSchema: struct<city:string,v:int>" in plan


def test_city_filters(spark):
    df = spark.createDataFrame([("A",), ("B",), ("C",)], "city string")
    assert of_city(df, "B").collect() == [("B",)]
    assert of_cities(df, ["A", "C"]).count() == 2
    assert of_cities(df, spark.createDataFrame([("A",), ("A",), ("Z",)], "city string")).collect() == [("A",)]
    many = of_cities(df, ["A", "B", *(f"X{i}" for i in range(1000))])
    assert many.count() == 2 and "LeftSemi" in many._jdf.queryExecution().executedPlan().toString()


def test_bound_parameters(spark):
    df = spark.createDataFrame([("it's",), ("B",)], "city string")
    assert run_sql(spark, "SELECT * FROM {t} WHERE city = :c", {"c": "it's"}, t=df).count() == 1
    assert run_sql(spark, "SELECT * FROM {t} WHERE city = :c", {"c": "x' OR '1'='1"}, t=df).count() == 0


def test_union_fills_missing_columns(spark):
    a = spark.createDataFrame([("A", 1)], "city string, v int")
    b = spark.createDataFrame([("B",)], "city string")
    assert sorted(union_batches([a, b]).collect()) == [("A", 1), ("B", None)]
