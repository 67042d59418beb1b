"""Readings joined with the city and country dimensions.

No dimension is hinted as broadcast. Spark measures it against
``spark.sql.autoBroadcastJoinThreshold``, at planning and again at run time, and
beyond it sort-merges. Adaptive execution then splits a hot city's partition, but
only where both sides come straight from their shuffle, as stored tables do; for
derived dimensions the salted form of the join, which finds hot cities itself, is the default.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from isobar.functions.temporal import bucket
from isobar.operators.series import first_row


def with_country(cities: DataFrame, countries: DataFrame) -> DataFrame:
    """Each city with its country, subregion and region."""
    return cities.join(countries.withColumnRenamed("id", "country_id"), "country_id").select(
        *cities.columns, *[c for c in countries.columns if c != "id"]
    )


def enrich(observations: DataFrame, cities: DataFrame, salted: bool = True) -> DataFrame:
    """Readings with the attributes of their city; readings of unlisted cities vanish.

    ``salted=False`` spares counting the cities where the dimension is stored or known to be small.
    """
    if salted:
        return salted_join(observations, cities, "city", "inner", spread=["datetime"])
    return observations.join(cities, "city")


def covered_cities(cities: DataFrame, observations: DataFrame) -> DataFrame:
    """Listed cities that have readings."""
    return cities.join(_seen(observations), "city", "left_semi")


def missing_cities(cities: DataFrame, observations: DataFrame) -> DataFrame:
    """Listed cities that have none."""
    return cities.join(_seen(observations), "city", "left_anti")


def locate(requests: DataFrame, dimension: DataFrame, order: Sequence[Column | str],
           salted: bool | None = None) -> DataFrame:
    """Look every request's city up: its first match in the declared order, or nulls.

    Salted by default where requests have more columns than the city: that form spreads by the requests' other columns, so they need some that
    tell a city's requests apart.
    """
    first = first_row(dimension, ["city"], order)
    if salted or salted is None and len(requests.columns) > 1:
        return salted_join(requests, first, "city", "left", spread=[c for c in requests.columns if c != "city"])
    return requests.join(first, "city", "left")


def salted_join(facts: DataFrame, dimension: DataFrame, key: str, how: str, spread: Sequence[str],
                share: float = 0.001) -> DataFrame:
    """Inner or left join in which keys above ``share`` of the facts meet in many tasks.

    At most ``1 / share`` keys can be that frequent, which bounds what is broadcast
    to mark them. Each is cut into pieces of about that share by a hash of the ``spread``
    columns, and its dimension rows are repeated for each piece; all other rows, and
    the result, are those of the plain join.
    """
    if not 0 < share <= 1:
        raise ValueError("share must lie above 0 and not above 1")
    counts = facts.groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    limit = F.lit(share) * counts.agg(F.sum("_n")).scalar()
    hot = F.broadcast(
        counts.where((F.col("_n") > limit) & F.col(key).isNotNull())
        .select(key, F.ceil(F.col("_n") / limit).cast("int").alias("_pieces")))
    piece = lambda n: F.pmod(F.xxhash64(*spread), n).cast("int")
    marked = facts.join(hot, key, "left").withColumn(
        "_piece", F.when(F.col("_pieces").isNotNull(), piece(F.col("_pieces")))
        .when(F.col(key).isNull(), piece(F.lit(math.ceil(1 / share)))).otherwise(0)).drop("_pieces")
    repeated = dimension.join(hot, key, "left").withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_pieces"), F.lit(1)) - 1))).drop("_pieces")
    return marked.join(repeated, [key, "_piece"], how).drop("_piece")


def coverage(cities: DataFrame, observations: DataFrame, run: Column) -> DataFrame:
    """Per run: records fetched, distinct (city, datetime) loaded, and listed cities covered.

    Copies are counted per key and keys per city before cities are joined, so
    neither a hot key nor a hot city reaches one task as rows.
    """
    per_city = (
        observations.groupBy(run.alias("run"), "city", "datetime")
        .agg(F.count(F.lit(1)).alias("copies"))
        .groupBy("run", "city")
        .agg(F.sum("copies").alias("fetched"), F.count(F.lit(1)).alias("loaded"))
    )
    listed = cities.select("city", F.lit(1).alias("listed"))
    return (
        per_city.join(listed, "city", "left")
        .groupBy("run")
        .agg(
            F.sum("fetched").alias("n_fetched"),
            F.sum("loaded").alias("n_loaded"),
            F.count("listed").alias("n_covered"),
        )
        .withColumn("n_cities", cities.agg(F.count(F.lit(1))).scalar())
        .withColumn("coverage", F.try_divide("n_covered", "n_cities"))
    )


def coverage_partials(cities: DataFrame, observations: DataFrame, grain: str = "day", lg_k: int = 14) -> DataFrame:
    """Per period: readings, exact distinct listed cities, and a mergeable sketch of them.

    One row for each city and period meets the list, so neither a hot city nor a hot day reaches a task as rows.
    The sketch's standard error is about 0.8 / sqrt(2^lg_k): 0.65 % by default; small counts come out exact.
    """
    polled = observations.where(F.col("datetime").isNotNull()).groupBy("city", bucket(observations, grain).alias("datetime")).agg(
        F.count(F.lit(1)).alias("n"))
    listed = cities.select("city").distinct().withColumn("_listed", F.lit(True))
    return polled.join(listed, "city", "left").groupBy("datetime").agg(
        F.sum("n").alias("n_readings"), F.count("_listed").alias("n_covered"),
        F.hll_sketch_agg(F.when(F.col("_listed"), F.col("city")), F.lit(lg_k)).alias("sketch"))


def coverage_from_partials(partials: DataFrame, grain: str) -> DataFrame:
    """Coverage of coarser periods from sketches alone: readings, and distinct cities as estimated; counts of days can't be added."""
    return partials.groupBy(bucket(partials, grain).alias("datetime")).agg(
        F.sum("n_readings").alias("n_readings"), F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_covered"))


def regional_rollup(partials: DataFrame, cities: DataFrame, countries: DataFrame) -> DataFrame:
    """Region, subregion and country totals of cities and readings, from day partials.

    Partials shrink to one row per city before they meet a dimension. ``level`` is
    0 for a country, 1 for a subregion, 3 for a region and 7 for the grand total.
    """
    per_city = partials.groupBy("city").agg(
        *[F.sum(c).alias(c) for c in ("n", "temp_sum", "temp_count", "sum_precipitation")],
        F.min("temp_min").alias("temp_min"),
        F.max("temp_max").alias("temp_max"),
    )
    placed = with_country(cities, countries).join(per_city, "city", "left")
    return placed.rollup("region", "subregion", "name").agg(
        F.grouping_id().cast("int").alias("level"),
        F.count(F.lit(1)).alias("n_cities"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_readings"),
        F.try_divide(F.sum("temp_sum"), F.sum("temp_count")).alias("avg_temp"),
        F.min("temp_min").alias("temp_min"),
        F.max("temp_max").alias("temp_max"),
        F.sum("sum_precipitation").alias("sum_precipitation"),
    )


def _seen(observations: DataFrame) -> DataFrame:
    return observations.select("city").distinct()
