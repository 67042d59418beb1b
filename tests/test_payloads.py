from __future__ import annotations

import json
from datetime import datetime
from decimal import Decimal

import pytest

from isobar.schemas import OBSERVATION_SCHEMA
from isobar.sources.payloads import (
    parse_flat_documents, parse_payloads, read_landed, rows_from_documents, to_documents,
)

FULL = {
    "dt": 1704067200, "weather": [{"main": "Rain", "description": "it's \"wet\""}, {"main": "Mist"}],
    "main": {"temp": 300.15, "feels_like": 301.275, "temp_min": 299.15, "temp_max": 302,
             "pressure": 1012, "humidity": 84, "sea_level": 1012, "grnd_level": 1001},
    "visibility": 9000, "wind": {"speed": 4.1, "deg": 250}, "rain": {"1h": 0.6, "3h": 2},
    "clouds": {"all": 75}, "sys": {"sunrise": 1704064000, "sunset": 1704104000, "country": "XX"},
}


def parsed(spark, *payloads):
    texts = [(f"C{i}", p if isinstance(p, str) or p is None else json.dumps(p)) for i, p in enumerate(payloads)]
    result = parse_payloads(spark.createDataFrame(texts, "city string, raw string"))
    assert [(f.name, f.dataType) for f in result.schema] == [(f.name, f.dataType) for f in OBSERVATION_SCHEMA]
    return {r.city: r for r in result.collect()}


def without(*path):
    copy = json.loads(json.dumps(FULL))
    target = copy
    for key in path[:-1]:
        target = target[key]
    del target[path[-1]]
    return copy


def test_full_payload(spark):
    row = parsed(spark, FULL)["C0"]
    assert (row.main, row.description) == ("Rain", "it's \"wet\"")
    assert (row.temp, row.feels_like, row.temp_min, row.temp_max) == (27.0, 28.13, 26.0, 28.85)
    assert (row.pressure, row.humidity, row.visibility, row.clouds) == (1012.0, Decimal("84.00"), 9000, 75)
    assert row.wind.asDict() == {"speed": 4.1, "deg": 250.0, "gust": None}
    assert row.precipitation.asDict() == {"rain": 0.6, "snow": 0.0}
    assert row.datetime.timestamp() == 1704067200 and row.sunset.timestamp() == 1704104000


@pytest.mark.parametrize("payload", [without("weather"), {**FULL, "weather": []}])
def test_no_conditions(spark, payload):
    row = parsed(spark, payload)["C0"]
    assert (row.main, row.description, row.temp) == (None, None, 27.0)


def test_missing_parts_become_null_and_the_row_stays(spark):
    rows = parsed(spark, without("main", "temp"), without("main"), without("sys"), without("rain"),
                  without("wind"), {**FULL, "rain": 0, "visibility": "far"})
    assert rows["C0"].temp is None and rows["C0"].temp_min == 26.0
    assert rows["C1"].pressure is None and rows["C1"].main == "Rain"
    assert rows["C2"].sunrise is None
    assert rows["C3"].precipitation.asDict() == {"rain": 0.0, "snow": 0.0}
    assert rows["C4"].wind.asDict() == {"speed": None, "deg": None, "gust": None}
    assert rows["C5"].visibility is None and rows["C5"].precipitation.rain == 0.0 and rows["C5"].temp == 27.0


def test_payloads_without_time_are_dropped(spark):
    assert parsed(spark, "{broken", None, "", without("dt"), "[]", FULL).keys() == {"C5"}


def test_each_text_is_parsed_once(spark):
    df = spark.createDataFrame([("C", json.dumps(FULL))], "city string, raw string")
    plan = parse_payloads(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == 1


def test_landed_files(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"city": "A", "raw": json.dumps(FULL)}) + "\n")
    (tmp_path / "b.json").write_text(json.dumps({"raw": "x", "city": "B"}) + "\n")
    assert {r.city for r in parse_payloads(read_landed(spark, str(tmp_path))).collect()} == {"A"}


def test_flat_variant(spark):
    flat = {"city": "A", "time": 1704067200, "main": "Rain", "temp": 300.15, "humidity": 84,
            "wind": {"speed": 1}, "precipitation": {"rain": {"1h": 0.6}, "snow": 0}, "sunrise": 1704064000}
    documents = [(json.dumps(flat),), (json.dumps({**flat, "time": None}),),
                 (json.dumps({**flat, "city": "B", "precipitation": {"rain": 0, "snow": {"3h": 1}}}),)]
    result = {r.city: r for r in parse_flat_documents(spark.createDataFrame(documents, "doc string")).collect()}
    assert result.keys() == {"A", "B"}
    assert result["A"].temp == 27.0 and result["A"].precipitation.asDict() == {"rain": 0.6, "snow": 0.0}
    assert result["B"].precipitation.asDict() == {"rain": 0.0, "snow": 0.0}
    assert result["A"].datetime.timestamp() == 1704067200 and result["A"].sunset is None


def test_documents_to_rows(spark):
    documents = [(json.dumps(d),) for d in (
        {"city": "A", "datetime": "2024-01-01 06:00:00", "temp": "12.5", "visibility": "10", "humidity": 84,
         "wind": {"speed": "3", "deg": 10}, "description": "it's"},
        {"city": "B", "datetime": "2024-01-01 06:00:00.25", "unknown": 1},
    )]
    rows = {r.city: r for r in rows_from_documents(spark.createDataFrame(documents, "doc string")).collect()}
    a, b = rows["A"], rows["B"]
    assert (a.datetime, a.temp, a.visibility, a.humidity, a.description) == (
        datetime(2024, 1, 1, 6), 12.5, 10, Decimal("84.00"), "it's")
    assert a.wind.asDict() == {"speed": 3.0, "deg": 10.0, "gust": None} and a.precipitation is None
    assert b.datetime == datetime(2024, 1, 1, 6, 0, 0, 250000) and b.temp is None


def test_bad_values_fail_or_become_null(spark):
    documents = spark.createDataFrame([('{"city": "A", "temp": "warm"}',)], "doc string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        rows_from_documents(documents).collect()
    assert rows_from_documents(documents, strict=False).first().temp is None


def test_document_round_trip(spark):
    row = parse_payloads(spark.createDataFrame([("C", json.dumps(FULL))], "city string, raw string"))
    back = rows_from_documents(to_documents(row))
    assert back.collect() == row.collect()
