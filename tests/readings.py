"""Small hand-made readings."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

from isobar.schemas import OBSERVATION_SCHEMA

SCHEMA = """city string, datetime timestamp_ntz, temp double, temp_min double, temp_max double,
            pressure double, precipitation struct<rain: double, snow: double>"""


def reading(city, when, temp=10.0, pressure=1000.0, rain=None, snow=None):
    spread = 1.5 if temp is not None else None
    return (city, when, temp, None if temp is None else temp - spread, None if temp is None else temp + spread,
            pressure, (rain, snow))


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def random_readings(spark, seed, n=400, cities=5, days=800, hot=True):
    """Unique (city, datetime) readings, a third of them of one city, some values missing."""
    rng = random.Random(seed)
    rows, seen = [], set()
    while len(rows) < n:
        city = "HOT" if hot and rng.random() < 1 / 3 else f"C{rng.randrange(cities)}"
        when = datetime(2022, 12, 28) + timedelta(minutes=10 * rng.randrange(days * 144))
        if (city, when) in seen:
            continue
        seen.add((city, when))
        rows.append(reading(
            city, when,
            None if rng.random() < 0.1 else rng.randrange(-300, 400) / 10,
            None if rng.random() < 0.1 else rng.randrange(9500, 10500) / 10,
            rng.randrange(100) / 10 if rng.random() < 0.3 else None,
            rng.randrange(100) / 10 if rng.random() < 0.2 else None,
        ))
    return frame(spark, rows)


def observation(city, when, **values):
    """A full row of the stored readings."""
    row = dict.fromkeys(OBSERVATION_SCHEMA.fieldNames())
    row.update(city=city, datetime=when, precipitation=(0.0, 0.0), **values)
    return tuple(row[name] for name in OBSERVATION_SCHEMA.fieldNames())


def rows(df, *columns):
    return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)


def close(left, right, places=9):
    """Equal rows, floats up to ``places``."""
    shape = lambda r: tuple(round(v, places) + 0.0 if isinstance(v, float) else v for v in r)
    return [shape(r) for r in left] == [shape(r) for r in right]
