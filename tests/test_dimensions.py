from __future__ import annotations

from datetime import date, datetime

import pytest

from airstrata.config import CITY_REFERENCE
from airstrata.operators.dimensions import (
    dim_date,
    dim_time,
    merge_city,
    merge_station,
    station_candidates,
)
from airstrata.operators.fact import build_fact, fact_outcomes
from airstrata.operators.upsert import allocate_keys
from airstrata.schemas import CITY_REFERENCE as REFERENCE_SCHEMA
from airstrata.schemas import MEASUREMENT_COLUMNS
from airstrata.session import materialize

T1, T2, T3 = datetime(2026, 1, 1, 8), datetime(2026, 1, 2, 8), datetime(2026, 1, 3, 14)
LOAD1, LOAD2 = datetime(2026, 2, 1), datetime(2026, 2, 2)

TYPES = {
    "waqi_idx": "int",
    "station_name": "string",
    "url": "string",
    "city_slug": "string",
    "source": "string",
    "measured_at": "timestamp_ntz",
    "dominant_pollutant": "string",
    "ingested_at": "timestamp_ntz",
}
SCHEMA = ", ".join(f"{c} {TYPES.get(c, 'double')}" for c in MEASUREMENT_COLUMNS)


def measurement(**values):
    row = dict.fromkeys(MEASUREMENT_COLUMNS)
    row.update(
        waqi_idx=1,
        station_name="s",
        city_slug="ha-noi",
        source="api",
        measured_at=T1,
        aqi=10.0,
        ingested_at=T1,
    )
    row.update(values)
    return tuple(row[c] for c in MEASUREMENT_COLUMNS)


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


@pytest.fixture(scope="module")
def reference(spark):
    return spark.createDataFrame(CITY_REFERENCE, REFERENCE_SCHEMA)


@pytest.fixture(scope="module")
def cities(spark, reference):
    return materialize(merge_city(None, reference), "cities")


def test_calendar(spark):
    days = dim_date(spark)
    assert days.count() == 4383
    row = days.filter("date_key = 20240229").first()
    assert row["full_date"] == date(2024, 2, 29)
    assert (row["month_name"], row["day_name"], row["day_of_week"]) == ("Feb", "Thu", 4)
    assert (row["quarter"], row["week_of_year"], row["is_weekend"], row["season"]) == (
        1,
        9,
        False,
        "Dry",
    )
    wet = {r["month"] for r in days.filter("season = 'Rainy'").select("month").distinct().collect()}
    assert wet == {5, 6, 7, 8, 9, 10}


def test_hours(spark):
    bands = {r["hour"]: (r["time_key"], r["time_of_day"]) for r in dim_time(spark).collect()}
    assert len(bands) == 24
    assert [bands[h][1] for h in (4, 5, 11, 12, 17, 18, 22, 23)] == [
        "Night",
        "Morning",
        "Morning",
        "Afternoon",
        "Afternoon",
        "Evening",
        "Evening",
        "Night",
    ]
    assert bands[14][0] == 1400


def test_city_merge_keeps_keys_and_takes_attributes(spark, reference, cities):
    more = spark.createDataFrame(
        [("a-new", "New", "North", None, None), ("ha-noi", "Ha Noi!", "N", 1.0, 2.0)],
        REFERENCE_SCHEMA,
    )
    merged = {r["city_slug"]: r for r in merge_city(cities, more).collect()}
    old = {r["city_slug"]: r["city_key"] for r in cities.collect()}
    assert sorted(old.values()) == [1, 2, 3, 4, 5]
    assert merged["a-new"]["city_key"] == 6
    assert merged["ha-noi"]["city_key"] == old["ha-noi"]
    assert merged["ha-noi"]["city_name"] == "Ha Noi!"
    assert merged["da-nang"]["city_name"] == "Da Nang"
    assert len(merged) == 6


def test_duplicate_reference_is_refused(spark, reference):
    with pytest.raises(ValueError):
        merge_city(None, reference.union(reference))


def test_api_row_wins_over_a_later_record(spark, cities):
    rows = frame(
        spark,
        measurement(source="api", lat=1.0, measured_at=T1),
        measurement(source="kaggle", station_name="csv", measured_at=T3),
    )
    best = station_candidates(rows, cities).collect()
    assert len(best) == 1
    assert (best[0]["station_name"], best[0]["lat"]) == ("s", 1.0)
    assert (best[0]["first_seen"], best[0]["last_seen"]) == (T1, T3)


def test_a_missing_time_counts_as_latest(spark, cities):
    rows = frame(
        spark,
        measurement(station_name="timed", measured_at=T3),
        measurement(station_name="untimed", measured_at=None),
    )
    row = station_candidates(rows, cities).first()
    assert (row["station_name"], row["last_seen"]) == ("untimed", T3)


def test_unmapped_city_makes_no_station(spark, cities):
    assert station_candidates(frame(spark, measurement(city_slug="hue")), cities).count() == 0


def test_station_upsert_rules(spark, cities):
    first = merge_station(
        None,
        station_candidates(
            frame(
                spark,
                measurement(lat=1.0, url="u", measured_at=T2),
                measurement(waqi_idx=7, measured_at=T1),
            ),
            cities,
        ),
        LOAD1,
    )
    first = materialize(first, "stations")
    later = frame(
        spark,
        measurement(source="kaggle", station_name="renamed", measured_at=T1),
        measurement(waqi_idx=3, measured_at=None),
    )
    merged = {r["waqi_idx"]: r for r in merge_station(first, station_candidates(later, cities), LOAD2).collect()}
    known = merged[1]
    assert (known["station_key"], known["lat"], known["url"]) == (1, 1.0, "u")
    assert (known["station_name"], known["source"]) == ("renamed", "kaggle")
    assert (known["first_seen"], known["last_seen"]) == (T2, T1)  # replaced, not widened
    assert known["loaded_at"] == LOAD2
    assert merged[7]["loaded_at"] == LOAD1 and merged[7]["station_key"] == 2
    assert merged[3]["station_key"] == 3 and merged[3]["first_seen"] is None


def test_fact_rows_and_what_drops(spark, cities):
    rows = frame(
        spark,
        measurement(aqi=None),
        measurement(measured_at=datetime(2026, 1, 1, 8, 30)),
        measurement(measured_at=datetime(2018, 12, 31, 8)),
        measurement(measured_at=datetime(2031, 1, 1, 8)),
        measurement(measured_at=None),
        measurement(city_slug="hue"),
    )
    dates, times = dim_date(spark), dim_time(spark)
    stations = materialize(merge_station(None, station_candidates(rows, cities), LOAD1), "stations")
    fact = build_fact(rows, dates, times, cities, stations).collect()
    assert len(fact) == 1
    row = fact[0]
    assert (row["date_key"], row["time_key"], row["station_key"]) == (20260101, 800, 1)
    assert row["pollution_level"] == "Hazardous"
    outcomes = fact_outcomes(rows, dates, times, cities, stations).collect()
    assert {r["outcome"]: r["n_rows"] for r in outcomes} == {
        "kept": 1,
        "time_not_on_the_hour": 1,
        "date_outside_calendar": 2,
        "no_timestamp": 1,
        "unknown_city": 1,
    }


def test_minutes_of_the_day(spark):
    rows = dim_time(spark, minutes=True).collect()
    assert len(rows) == 1440
    at = {r["time_key"]: (r["hour"], r["minute"], r["time_of_day"]) for r in rows}
    assert at[0] == (0, 0, "Night") and at[1259] == (12, 59, "Afternoon") and at[2359] == (23, 59, "Night")


def test_keys_go_past_32_bits(spark):
    rows = spark.createDataFrame([(5,), (4,)], "n int")
    keyed = allocate_keys(rows, ["n"], "key", 2**31)
    assert sorted(map(tuple, keyed.collect())) == [(2**31, 4), (2**31 + 1, 5)]


def test_order_free_stations(spark, cities):
    batches = [
        frame(spark, measurement(measured_at=T2, station_name="b", lat=1.0, lon=1.0)),
        frame(spark, measurement(measured_at=T1, station_name="a"), measurement(measured_at=T3, station_name="h", source="kaggle")),
        frame(spark, measurement(measured_at=T3, station_name="c", source="kaggle")),
    ]
    found = set()
    for order in ((0, 1, 2), (2, 1, 0), (1, 2, 0)):
        now = None
        for k in order:
            now = materialize(
                merge_station(now, materialize(station_candidates(batches[k], cities), "c"), LOAD1, order_free=True), "s"
            )
        row = now.first()
        found.add((row["station_name"], row["source"], row["lat"], row["first_seen"], row["last_seen"]))
    assert found == {("c", "api", 1.0, T1, T3)}


def test_dedup_keeps_the_row_loaded_last(spark, cities, reference):
    rows = [measurement(aqi=a, ingested_at=t) for a, t in ((1.0, T2), (2.0, T3), (9.0, T1))]
    given = frame(spark, *rows, measurement(source="kaggle", aqi=4.0))
    stations = materialize(merge_station(None, station_candidates(given, cities), LOAD1), "stations")
    fact = build_fact(given, dim_date(spark), dim_time(spark), cities, stations, dedup=True)
    assert sorted((r["source"], r["aqi"]) for r in fact.collect()) == [("api", 2.0), ("kaggle", 4.0)]
    assert build_fact(given, dim_date(spark), dim_time(spark), cities, stations).count() == 4
