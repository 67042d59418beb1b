"""DuckDB twins of the query catalogue."""

from __future__ import annotations

# The fixture views, written as in ``views``.
OBS = """
obs AS (
  SELECT concat('CITY_', user_id) AS city, ts AS datetime, event_type AS main, value AS temp_k,
         round(value - 273.15::DOUBLE, 2) AS temp,
         round(value - 273.15::DOUBLE, 2) - k / 10.0::DOUBLE AS temp_min,
         round(value - 273.15::DOUBLE, 2) + k / 10.0::DOUBLE AS temp_max,
         950.0::DOUBLE + k AS pressure, k AS humidity,
         CASE WHEN event_type = 'view' THEN value / 100 END AS rain,
         CASE WHEN event_type = 'signup' THEN value / 100 END AS snow
  FROM (SELECT *, json_extract_string(props, '$.k')::INT AS k FROM events)
)"""
LONG = """
long AS (
  SELECT concat('CITY_', l_suppkey) AS city, l_shipdate AS datetime,
         l_extendedprice / 1000 AS temp,
         l_extendedprice / 1000 - l_quantity AS temp_min,
         l_extendedprice / 1000 + l_quantity AS temp_max,
         l_quantity AS pressure, l_discount AS rain, l_tax AS snow,
         l_returnflag AS batch, l_orderkey, l_linenumber, l_partkey
  FROM lineitem
)"""
CITIES = """
cities AS (
  SELECT concat('CITY_', user_id) AS city, (user_id - 75)::DOUBLE AS lat,
         (2 * user_id - 150)::DOUBLE AS lng, (user_id % 25)::INT AS country_id
  FROM (SELECT DISTINCT user_id FROM events)
)"""
LISTED = """
listed AS (SELECT concat('CITY_', c_custkey) AS city, c_nationkey AS country_id FROM customer)"""
COUNTRIES = """
countries AS (
  SELECT n_nationkey AS id, n_name AS name,
         concat(r_name, '_', n_nationkey % 3) AS subregion, r_name AS region
  FROM nation JOIN region ON n_regionkey = r_regionkey
)"""


def _with(*views: str, query: str) -> str:
    return f"WITH {','.join(views)}\n{query}"


def _statistics(grain: str) -> str:
    return f"""
SELECT city, date_trunc('{grain}', datetime)::TIMESTAMP AS datetime,
       round(avg(pressure), 9) AS avg_pressure, round(avg(temp), 9) AS avg_temp,
       min(temp_min) AS temp_min, max(temp_max) AS temp_max
FROM long GROUP BY 1, 2"""


def _precipitation(grain: str) -> str:
    return f"""
SELECT city, date_trunc('{grain}', datetime)::TIMESTAMP AS datetime,
       round(sum(coalesce(rain, 0) + coalesce(snow, 0)), 9) AS sum_precipitation
FROM long GROUP BY 1, 2"""


def _grain(grain: str) -> str:
    return f"""
SELECT '{grain}' AS grain, city, date_trunc('{grain}', datetime)::TIMESTAMP AS datetime,
       round(avg(pressure), 9) AS avg_pressure, round(avg(temp), 9) AS avg_temp,
       min(temp_min) AS temp_min, max(temp_max) AS temp_max,
       round(sum(coalesce(rain, 0) + coalesce(snow, 0)), 9) AS sum_precipitation
FROM long GROUP BY 2, 3"""


def _exact(grain: str) -> str:
    return f"""
SELECT '{grain}' AS grain, city, date_trunc('{grain}', datetime)::TIMESTAMP AS datetime,
       sum(pressure)::DOUBLE / count(pressure) / 1e5::DOUBLE AS avg_pressure,
       sum(temp)::DOUBLE / count(temp) / 1e5::DOUBLE AS avg_temp,
       min(temp_min)::DOUBLE / 1e5::DOUBLE AS temp_min, max(temp_max)::DOUBLE / 1e5::DOUBLE AS temp_max,
       sum(coalesce(rain, 0) + coalesce(snow, 0)) / 1e5::DOUBLE AS sum_precipitation
FROM units GROUP BY 2, 3"""


DAY_SUMMARY = """
SELECT city, date_trunc('day', datetime)::TIMESTAMP AS datetime,
       round(avg(pressure), 9) AS avg_pressure, round(avg(temp), 9) AS avg_temp,
       min(temp) AS temp_min, max(temp) AS temp_max,
       round(sum(coalesce(rain, 0) + coalesce(snow, 0)), 9) AS sum_precipitation
FROM obs {where} GROUP BY 1, 2"""

WINNERS = _with(LONG, query="""
SELECT city, datetime, temp, temp_min, temp_max, pressure, rain, snow
FROM long
QUALIFY row_number() OVER (
  PARTITION BY city, datetime
  ORDER BY batch DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC,
           temp DESC, pressure DESC, rain DESC, snow DESC) = 1""")

FLATTENED = _with(OBS, query="""
SELECT city, date_trunc('second', datetime)::TIMESTAMP AS datetime,
       CASE WHEN main <> 'error' THEN main END AS main,
       CASE WHEN main <> 'error' THEN concat('it''s ', main) END AS description,
       round(temp_k - 273.15::DOUBLE, 2) AS temp,
       NULL::DOUBLE AS feels_like,
       round(temp_k - humidity / 10.0::DOUBLE - 273.15::DOUBLE, 2) AS temp_min,
       round(temp_k + humidity / 10.0::DOUBLE - 273.15::DOUBLE, 2) AS temp_max,
       pressure, humidity::DOUBLE AS humidity,
       NULL::DOUBLE AS sea_level, NULL::DOUBLE AS grnd_level,
       (humidity * 100)::INT AS visibility,
       temp_k / 10 AS wind_speed, humidity::DOUBLE AS wind_deg, NULL::DOUBLE AS wind_gust,
       coalesce(rain, 0) AS rain, coalesce(snow, 0) AS snow, humidity AS clouds,
       (date_trunc('day', datetime) + INTERVAL 6 HOUR)::TIMESTAMP AS sunrise,
       (date_trunc('day', datetime) + INTERVAL 18 HOUR)::TIMESTAMP AS sunset
FROM obs""")

ENRICHED = _with(OBS, CITIES, query="""
SELECT obs.city, datetime, temp, lat, lng, country_id FROM obs JOIN cities ON obs.city = cities.city""")

TREND = """
SELECT city, datetime, temp, pressure, round(temp - lag(temp) OVER w, 9) AS temp_delta,
       round(pressure - lag(pressure) OVER w, 9) AS pressure_delta
FROM obs WINDOW w AS (PARTITION BY city ORDER BY datetime)"""

# Of two readings in one second the greater payload text wins: an empty
# condition list sorts below a filled one, then the condition and Kelvin text.
NEWEST_TEXT = """
QUALIFY row_number() OVER (
  PARTITION BY city, date_trunc('second', datetime)
  ORDER BY main <> 'error' DESC, main DESC, temp_k::VARCHAR DESC) = 1"""

ORACLE: dict[str, str] = {
    "scan_project": "SELECT user_id, ts, value FROM events WHERE event_type = 'view'",
    "scan_city": _with(OBS, query="SELECT * FROM obs WHERE city = 'CITY_7'"),
    "range_half_open": _with(OBS, query="""
SELECT city, datetime, temp, pressure FROM obs
WHERE datetime >= TIMESTAMP '2024-01-05' AND datetime < TIMESTAMP '2024-01-10'"""),
    "sql_param": _with(OBS, query="""
SELECT city, datetime, temp FROM obs WHERE city = 'CITY_7' AND temp >= -100"""),
    "kelvin": _with(OBS, query="""
SELECT city, datetime, temp_k, round(temp_k - 273.15::DOUBLE, 2) AS celsius FROM obs"""),
    "json_flatten": FLATTENED,
    "json_flatten_kelvin": _with(OBS, query="""
SELECT city, date_trunc('second', datetime)::TIMESTAMP AS datetime, main,
       round(temp_k - 273.15::DOUBLE, 2) AS temp, round(temp_k - 1 - 273.15::DOUBLE, 2) AS feels_like,
       round(temp_k - humidity / 10.0::DOUBLE - 273.15::DOUBLE, 2) AS temp_min,
       round(temp_k + humidity / 10.0::DOUBLE - 273.15::DOUBLE, 2) AS temp_max,
       pressure, humidity::DOUBLE AS humidity, coalesce(rain, 0) AS rain, coalesce(snow, 0) AS snow,
       date_trunc('second', datetime)::TIMESTAMP AS sunrise, NULL::TIMESTAMP AS sunset
FROM obs"""),
    "json_insert": _with(OBS, query="""
SELECT city, date_trunc('second', datetime)::TIMESTAMP AS datetime, main, NULL::VARCHAR AS description,
       temp, NULL::DOUBLE AS feels_like, NULL::DOUBLE AS temp_min, NULL::DOUBLE AS temp_max,
       pressure, humidity::DOUBLE AS humidity, NULL::DOUBLE AS sea_level, NULL::DOUBLE AS grnd_level,
       NULL::INT AS visibility, temp_k AS wind_speed, NULL::DOUBLE AS wind_deg, NULL::DOUBLE AS wind_gust,
       rain, snow, NULL::INT AS clouds, NULL::TIMESTAMP AS sunrise, NULL::TIMESTAMP AS sunset
FROM obs"""),
    "to_json_rows": _with(OBS, query="""
SELECT * REPLACE (date_trunc('millisecond', datetime)::TIMESTAMP AS datetime) FROM obs"""),
    "payload_rejects": _with(OBS, query="""
SELECT city, CASE WHEN humidity % 7 > 3 THEN date_trunc('second', datetime)::TIMESTAMP END AS datetime,
       CASE WHEN humidity % 7 = 4 THEN 100000.25::DOUBLE WHEN humidity % 7 > 4 THEN 55.126::DOUBLE END AS humidity,
       CASE WHEN humidity % 7 > 3 THEN humidity END AS visibility,
       ['no payload', 'broken text', 'no time', 'time out of range', 'kept', 'kept', 'kept'][humidity % 7 + 1] AS outcome
FROM obs"""),
    "agg_daily": _with(LONG, query=_statistics("day")),
    "agg_monthly": _with(LONG, query=_statistics("month")),
    "agg_yearly": _with(LONG, query=_statistics("year")),
    "rollup_from_daily": _with(LONG, query=_statistics("month")),
    "agg_monthly_precip": _with(LONG, query=_precipitation("month")),
    "agg_yearly_precip": _with(LONG, query=_precipitation("year")),
    "agg_all_grains": _with(LONG, query=f"""
, units AS (
  SELECT city, datetime, CAST(round(temp * 1e5) AS BIGINT) AS temp, CAST(round(temp_min * 1e5) AS BIGINT) AS temp_min,
         CAST(round(temp_max * 1e5) AS BIGINT) AS temp_max, CAST(round(pressure * 1e5) AS BIGINT) AS pressure,
         round(rain * 1e5) AS rain, round(snow * 1e5) AS snow FROM long)
{" UNION ALL ".join(_exact(g) for g in ("day", "month", "year"))}"""),
    "counter_merge": _with(LONG, query=_precipitation("month")),
    "daily_stats_window": _with(OBS, query=f"""
SELECT city, datetime, avg_pressure, avg_temp, temp_min, temp_max FROM ({DAY_SUMMARY.format(where='')})"""),
    "daily_precip_window": _with(OBS, query=f"""
SELECT city, datetime, sum_precipitation FROM ({DAY_SUMMARY.format(where='')})"""),
    "process_day": _with(OBS, query=DAY_SUMMARY.format(
        where="WHERE datetime >= TIMESTAMP '2024-01-05' AND datetime < TIMESTAMP '2024-01-06'")),
    "geo_rollup": _with(OBS, CITIES, COUNTRIES, query="""
, per_city AS (
  SELECT city, count(*) AS n, sum(temp) AS temp_sum, count(temp) AS temp_count,
         min(temp_min) AS temp_min, max(temp_max) AS temp_max,
         sum(coalesce(rain, 0) + coalesce(snow, 0)) AS precipitation
  FROM obs GROUP BY city)
SELECT region, subregion, name, grouping(region, subregion, name)::INT AS level,
       count(*) AS n_cities, coalesce(sum(n), 0)::BIGINT AS n_readings,
       round(sum(temp_sum) / sum(temp_count), 9) AS avg_temp,
       min(temp_min) AS temp_min, max(temp_max) AS temp_max,
       round(sum(precipitation), 9) AS sum_precipitation
FROM cities JOIN countries ON country_id = id LEFT JOIN per_city USING (city)
GROUP BY ROLLUP (region, subregion, name)"""),
    "coverage": _with(OBS, LISTED, query="""
SELECT date_trunc('day', datetime)::TIMESTAMP AS run, count(*) AS n_fetched,
       count(DISTINCT (obs.city, datetime)) AS n_loaded, count(DISTINCT listed.city) AS n_covered,
       (SELECT count(*) FROM listed) AS n_cities,
       round(count(DISTINCT listed.city)::DOUBLE / (SELECT count(*) FROM listed), 9) AS coverage
FROM obs LEFT JOIN listed ON obs.city = listed.city GROUP BY 1"""),
    "latest_per_city": _with(OBS, query="""
SELECT * FROM obs QUALIFY row_number() OVER (PARTITION BY city ORDER BY datetime DESC) = 1"""),
    "recent_n_per_city": _with(OBS, query="""
SELECT city, datetime, temp, pressure FROM obs
QUALIFY row_number() OVER (PARTITION BY city ORDER BY datetime DESC) <= 3"""),
    "history_desc": _with(OBS, query="SELECT city, datetime, temp FROM obs ORDER BY city, datetime DESC"),
    "trend_delta": _with(OBS, query="""
SELECT city, datetime, temp, humidity, temp_k / 10 AS wind_speed, humidity::DOUBLE AS wind_deg,
       round(temp - lag(temp) OVER w, 9) AS temp_delta, humidity - lag(humidity) OVER w AS humidity_delta,
       round(temp_k / 10 - lag(temp_k / 10) OVER w, 9) AS wind_speed_delta,
       humidity::DOUBLE - lag(humidity::DOUBLE) OVER w AS wind_deg_delta
FROM obs WINDOW w AS (PARTITION BY city ORDER BY datetime)"""),
    "fk_city_country": _with(CITIES, COUNTRIES, query="""
SELECT city, lat, lng, country_id, name, subregion, region FROM cities JOIN countries ON country_id = id"""),
    "observation_enriched": ENRICHED,
    "observation_enriched_salted": ENRICHED,
    "missing_cities": _with(OBS, LISTED, query="""
SELECT * FROM listed ANTI JOIN obs ON listed.city = obs.city"""),
    "covered_cities": _with(OBS, LISTED, query="""
SELECT * FROM listed SEMI JOIN obs ON listed.city = obs.city"""),
    "city_lookup": _with(OBS, LISTED, query="""
, first_site AS (
  SELECT city, pressure AS lat, temp AS lng FROM obs
  QUALIFY row_number() OVER (PARTITION BY city ORDER BY pressure, temp) = 1)
SELECT listed.city, lat, lng FROM listed LEFT JOIN first_site ON listed.city = first_site.city"""),
    "upsert_observations": WINNERS,
    "upsert_stored": WINNERS,
    "union_batches": _with(OBS, query="""
SELECT city, datetime, main, temp, CASE WHEN main IN ('view', 'signup') THEN humidity END AS humidity FROM obs"""),
    "csv_dimension": _with(COUNTRIES, query="SELECT * FROM countries"),
    "bulk_load": _with(CITIES, query="SELECT *, (lat + 1075)::BIGINT AS city_id FROM cities"),
    "table_roundtrip": WINNERS,
    "process_day_stored": _with(OBS, query=DAY_SUMMARY.format(
        where="WHERE datetime >= TIMESTAMP '2024-01-05' AND datetime < TIMESTAMP '2024-01-06'")),
    "refresh_stored": _with(OBS, query="\nUNION ALL".join(_grain(g).replace("FROM long", "FROM obs") for g in ("day", "month", "year"))),
    "document_insert": _with(OBS, query="""
SELECT city, date_trunc('second', datetime)::TIMESTAMP AS datetime, main, temp, pressure FROM obs
QUALIFY row_number() OVER (
  PARTITION BY city, date_trunc('second', datetime) ORDER BY temp DESC, pressure DESC, main DESC) = 1"""),
    "stream_ingest": FLATTENED + NEWEST_TEXT,
    "stream_daily": _with(OBS, query=DAY_SUMMARY.format(where="")),
    "stream_hourly": f"""
WITH stored AS ({FLATTENED} {NEWEST_TEXT})
SELECT strftime(datetime, '%Y-%m-%d-%H') AS part, count(*) AS n_readings, count(DISTINCT city) AS n_cities,
       round(avg(temp), 9) AS avg_temp FROM stored GROUP BY 1""",
    "stream_late_days": f"""
WITH obs AS ({FLATTENED} {NEWEST_TEXT}) {DAY_SUMMARY.format(where='')}""",
    "latest_stored": _with(OBS, query="""
SELECT city, datetime, main, temp, pressure, rain, snow FROM obs
QUALIFY row_number() OVER (PARTITION BY city ORDER BY datetime DESC) = 1"""),
    "counter_stored": _with(LONG, query=_precipitation("month")),
    "trend_refresh": _with(OBS, query=TREND),
    "trend_bucketed": _with(OBS, query=TREND),
    "scan_city_stored": _with(OBS, query="""
SELECT city, datetime, main, temp, pressure FROM obs
WHERE city = 'CITY_7' AND datetime >= TIMESTAMP '2024-01-05' AND datetime < TIMESTAMP '2024-01-08'"""),
    "coverage_from_partials": _with(OBS, LISTED, query="""
SELECT date_trunc('month', datetime)::TIMESTAMP AS datetime, count(*) AS n_readings, count(DISTINCT listed.city) AS n_covered
FROM obs LEFT JOIN listed ON obs.city = listed.city GROUP BY 1"""),
    "json_variant": FLATTENED,
    "json_unseen_keys": _with(OBS, query="""
, third AS (SELECT epoch(date_trunc('second', datetime))::BIGINT % 3 AS k FROM obs)
SELECT 'uvi' AS path, 'BIGINT' AS kind, count(*) AS n FROM third WHERE k = 0 HAVING count(*) > 0
UNION ALL SELECT 'base', 'STRING', count(*) FROM third WHERE k = 0 HAVING count(*) > 0
UNION ALL SELECT 'alert', 'OBJECT<level: BIGINT>', count(*) FROM third WHERE k = 1 HAVING count(*) > 0
UNION ALL SELECT 'wind.dir', 'STRING', count(*) FROM third HAVING count(*) > 0"""),
    "csv_rejects": _with(CITIES, query="""
, numbered AS (SELECT *, (lat + 1075)::BIGINT AS city_id, ((lat + 1075)::BIGINT) % 5 AS kind FROM cities),
texts AS (SELECT *, concat_ws(',', lat::VARCHAR, lng::VARCHAR) AS place, concat_ws(',', country_id, city_id) AS ids FROM numbered)
SELECT CASE WHEN kind = 4 THEN concat(city, ', in all') END AS city, CASE WHEN kind = 4 THEN city_id END AS city_id,
       ['too few fields', 'value of another type', 'no value of city', 'too many fields', 'kept'][kind + 1] AS outcome,
       CASE kind WHEN 0 THEN concat(city, ',', place) WHEN 1 THEN concat(city, ',', lat, ',east,', ids)
            WHEN 2 THEN concat(',', place, ',', ids) WHEN 3 THEN concat(city, ',', place, ',', ids, ',x') END AS line
FROM texts"""),
    # Every reading is kept once, but for those that first arrive far behind the watermark.
    "stream_first_poll": _with(OBS, query="""
SELECT city, datetime, temp FROM obs WHERE NOT (day(datetime) <= 10 AND substr(city, 6)::INT % 10 = 0)"""),
}
