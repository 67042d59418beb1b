from __future__ import annotations

import pytest

from isobar.schemas import CITIES_SCHEMA, COUNTRIES_SCHEMA
from isobar.sources.dimensions import bulk_load, harmonise, read_dimension, require_rows


def written(tmp_path, text):
    path = tmp_path / "d.csv"
    path.write_text(text)
    return str(path)


def test_header_in_order(spark, tmp_path):
    path = written(tmp_path, 'id,name,subregion,region\n1,"Avalon, the isle",Mist,West\n2,O\'Hara,,\n')
    assert [tuple(r) for r in read_dimension(spark, path, COUNTRIES_SCHEMA).orderBy("id").collect()] == [
        (1, "Avalon, the isle", "Mist", "West"), (2, "O'Hara", None, None)]


def test_reordered_header_is_an_error(spark, tmp_path):
    path = written(tmp_path, "id,subregion,name,region\n1,a,b,c\n")
    with pytest.raises(Exception):
        read_dimension(spark, path, COUNTRIES_SCHEMA).collect()


def test_bulk_load_binds_by_position(spark, tmp_path):
    path = written(tmp_path, "w,x,y,z,extra\n7,100,Avalon,1.5,-2.25\n")
    loaded = bulk_load(spark, path, ["country_id", "city_id", "name", "latitude", "longitude"], CITIES_SCHEMA)
    assert [tuple(r) for r in loaded.collect()] == [("Avalon", 1.5, -2.25, 7, 100)]
    countries = bulk_load(spark, written(tmp_path, "a,b,c,d\n1,France,W,E\n"), ["id", "name", "subregion", "region"], COUNTRIES_SCHEMA)
    assert [tuple(r) for r in countries.collect()] == [(1, "France", "W", "E")]


def test_spellings(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3)], "lattitude double, longtitude double, time int")
    assert harmonise(df).columns == ["lat", "lng", "datetime"]
    kept = spark.createDataFrame([(1.0, 2.0)], "lat double, latitude double")
    assert harmonise(kept).columns == ["lat", "latitude"]


def test_empty_dimension(spark, tmp_path):
    path = written(tmp_path, "id,name,subregion,region\n")
    with pytest.raises(ValueError, match="countries"):
        require_rows(read_dimension(spark, path, COUNTRIES_SCHEMA), "countries")
