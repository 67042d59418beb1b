from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from isobar.functions.temporal import bucket
from isobar.operators import places, rollups
from readings import close, frame, random_readings, reading, rows

T = datetime(2024, 1, 1, 6)


@pytest.fixture
def cities(spark):
    return spark.createDataFrame(
        [("A", 1.0, 2.0, 1), ("B", 3.0, 4.0, 2), ("C", 5.0, 6.0, 9), ("HOT", 0.0, 0.0, 1)],
        "city string, lat double, lng double, country_id int")


@pytest.fixture
def countries(spark):
    return spark.createDataFrame([(1, "One", "S1", "R"), (2, "Two", "S2", "R"), (3, "Three", "S2", "R")],
                                 "id int, name string, subregion string, region string")


def test_foreign_key(cities, countries):
    found = places.with_country(cities, countries)
    assert found.columns == ["city", "lat", "lng", "country_id", "name", "subregion", "region"]
    assert rows(found, "city", "name") == [("A", "One"), ("B", "Two"), ("HOT", "One")]


def test_enrich_drops_unlisted_cities(spark, cities):
    df = frame(spark, [reading("A", T), reading("elsewhere", T)])
    assert rows(places.enrich(df, cities), "city", "lat") == [("A", 1.0)]


def test_covered_and_missing_split_the_list(spark, cities):
    df = frame(spark, [reading("A", T), reading("A", datetime(2024, 1, 2)), reading("elsewhere", T)])
    covered, missing = places.covered_cities(cities, df), places.missing_cities(cities, df)
    assert rows(covered, "city") == [("A",)]
    assert rows(missing, "city") == [("B",), ("C",), ("HOT",)]
    assert rows(covered.unionByName(missing)) == rows(cities)


def test_lookup_takes_the_first_match(spark):
    requests = spark.createDataFrame([("A",), ("A",), ("Z",)], "city string")
    sites = spark.createDataFrame([("A", 2.0), ("A", 1.0), ("B", 3.0)], "city string, lat double")
    assert rows(places.locate(requests, sites, ["lat"])) == [("A", 1.0), ("A", 1.0), ("Z", None)]
    assert rows(places.locate(requests, sites, [F.desc("lat")])) == [("A", 2.0), ("A", 2.0), ("Z", None)]


def test_coverage_counts_copies_once(spark, cities):
    df = frame(spark, [reading("A", T)] * 5 + [reading("B", T), reading("elsewhere", T),
                                               reading("A", datetime(2024, 1, 2, 3))])
    found = rows(places.coverage(cities, df, bucket(df, "day")))
    assert found == [(datetime(2024, 1, 1), 7, 3, 2, 4, 0.5), (datetime(2024, 1, 2), 1, 1, 1, 4, 0.25)]


@pytest.mark.parametrize("threshold", ["10m", "-1"])
def test_regional_rollup(spark, conf, cities, countries, threshold):
    conf(spark__sql__autoBroadcastJoinThreshold=threshold)
    df = frame(spark, [reading("A", T, 1.0, rain=1.0), reading("HOT", T, 4.0), reading("HOT", datetime(2024, 1, 3), 7.0),
                       reading("C", T, 100.0)])
    found = places.regional_rollup(rollups.daily_partials(df), cities, countries)
    by_level = {(r.level, r.region, r.subregion, r.name): r for r in found.collect()}
    total = by_level[(7, None, None, None)]
    assert (total.n_cities, total.n_readings, total.avg_temp, total.sum_precipitation) == (3, 3, 4.0, 1.0)
    one, two = by_level[(0, "R", "S1", "One")], by_level[(0, "R", "S2", "Two")]
    assert (one.n_cities, one.n_readings, one.temp_min, one.temp_max) == (2, 3, -0.5, 8.5)
    assert (two.n_cities, two.n_readings, two.avg_temp) == (1, 0, None)
    assert len(by_level) == 1 + 1 + 2 + 2


def skewed(spark, n=200000):
    return spark.range(0, n, numPartitions=16).select(
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("X"), F.col("id") % 997)).alias("city"),
        F.timestamp_seconds("id").alias("datetime"), F.col("id").cast("double").alias("temp"))


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_adaptive_execution_splits_a_hot_city(spark, conf, tmp_path):
    conf(spark__sql__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__autoBroadcastJoinThreshold="-1",
         spark__sql__adaptive__advisoryPartitionSizeInBytes="32k",
         spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="64k",
         spark__sql__adaptive__skewJoin__skewedPartitionFactor="2")
    skewed(spark).select("city").distinct().withColumn("lat", F.lit(1.0)).write.parquet(str(tmp_path / "cities"))
    found = places.enrich(skewed(spark), spark.read.parquet(str(tmp_path / "cities")), salted=False).agg(F.sum("lat"), F.count("temp"))
    assert tuple(found.collect()[0]) == (200000.0, 200000)
    assert "skew=true" in final_plan(found)


@pytest.mark.parametrize("threshold", ["10m", "-1"])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_salted_join_equals_the_plain_one(spark, conf, threshold, how):
    conf(spark__sql__autoBroadcastJoinThreshold=threshold)
    facts = skewed(spark, 3000).unionByName(
        spark.createDataFrame([(None, None, 1.0), ("unlisted", None, 2.0)], "city string, datetime timestamp, temp double"))
    dimension = facts.filter("city <> 'unlisted'").select("city").distinct().withColumn("lat", F.length("city"))
    salted = places.salted_join(facts, dimension, "city", how, ["datetime"], share=0.1)
    assert salted.columns == ["city", "datetime", "temp", "lat"]
    assert rows(salted) == rows(facts.join(dimension, "city", how))


def test_salting_spreads_only_the_hot_city(spark, conf):
    conf(spark__sql__autoBroadcastJoinThreshold="-1", spark__sql__adaptive__enabled="false",
         spark__sql__shuffle__partitions="16")
    facts = skewed(spark, 30000)
    dimension = facts.select("city").distinct().withColumn("lat", F.lit(1.0))
    largest = lambda df: max(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())
    joined = places.salted_join(facts, dimension, "city", "inner", ["datetime"], share=0.02)
    assert largest(places.enrich(facts, dimension, salted=False)) > 10000 > 5000 > largest(joined)


def test_salted_lookup(spark):
    requests = spark.createDataFrame([("A", 1), ("A", 2), ("Z", 3)], "city string, id int")
    sites = spark.createDataFrame([("A", 2.0), ("A", 1.0), ("B", 3.0)], "city string, lat double")
    assert rows(places.locate(requests, sites, ["lat"])) == rows(places.locate(requests, sites, ["lat"], salted=False))
    with pytest.raises(ValueError, match="share"):
        places.salted_join(requests, sites, "city", "left", ["id"], share=0)
