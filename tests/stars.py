"""Small stars for tests."""

from __future__ import annotations

from datetime import datetime

from airstrata.config import CITY_REFERENCE
from airstrata.operators.dimensions import (
    dim_date,
    dim_time,
    merge_city,
    merge_station,
    station_candidates,
)
from airstrata.operators.fact import build_fact
from airstrata.operators.marts import Star
from airstrata.schemas import CITY_REFERENCE as REFERENCE_SCHEMA
from airstrata.schemas import MEASUREMENT_COLUMNS
from airstrata.session import materialize

LOAD = datetime(2026, 2, 1)
SLUGS = [row[0] for row in CITY_REFERENCE]

_TYPES = {
    "waqi_idx": "int",
    "station_name": "string",
    "url": "string",
    "city_slug": "string",
    "source": "string",
    "measured_at": "timestamp_ntz",
    "dominant_pollutant": "string",
    "ingested_at": "timestamp_ntz",
}
SCHEMA = ", ".join(f"{c} {_TYPES.get(c, 'double')}" for c in MEASUREMENT_COLUMNS)


def measurement(**values) -> tuple:
    row = dict.fromkeys(MEASUREMENT_COLUMNS)
    row.update(
        waqi_idx=1,
        station_name="s",
        city_slug="ha-noi",
        source="api",
        measured_at=datetime(2026, 1, 1, 8),
        aqi=10.0,
        pm25=1.0,
        pm10=2.0,
        ingested_at=LOAD,
    )
    row.update(values)
    return tuple(row[c] for c in MEASUREMENT_COLUMNS)


def reference(spark):
    return spark.createDataFrame(CITY_REFERENCE, REFERENCE_SCHEMA)


def star_of(spark, rows) -> Star:
    measurements = materialize(spark.createDataFrame(rows, SCHEMA), "m")
    cities = materialize(merge_city(None, reference(spark)), "c")
    stations = materialize(
        merge_station(None, station_candidates(measurements, cities), LOAD), "s"
    )
    dates, times = materialize(dim_date(spark), "d"), materialize(dim_time(spark), "t")
    fact = materialize(build_fact(measurements, dates, times, cities, stations), "f")
    return Star(dates, times, cities, stations, fact)


def full_rows(per_city: int = 3) -> list[tuple]:
    """Readings in every reference city: passes every check."""
    return [
        measurement(
            waqi_idx=i,
            city_slug=slug,
            source="api" if i % 2 else "kaggle",
            measured_at=datetime(2026, 1 + i % 3, 1 + i % 5, (8, 14, 20)[i % 3]),
            aqi=20.0 + 37 * i % 480,
            pm25=float(i),
            pm10=i * 1.6,
            humidity=float(60 + i),
            dominant_pollutant=("pm25", "o3", None)[i % 3],
        )
        for slug in SLUGS
        for i in range(per_city)
    ]
