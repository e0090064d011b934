from __future__ import annotations

from datetime import date, datetime

import pytest

from airstrata.operators import marts
from airstrata.operators.marts import Partials, Star
from tests.stars import full_rows, measurement, star_of


def _at(day, hour=8, month=1):
    return datetime(2026, month, day, hour)


def test_daily_figures(spark):
    star = star_of(
        spark,
        [
            measurement(aqi=40.0, dominant_pollutant="o3"),
            measurement(aqi=160.0, waqi_idx=2, dominant_pollutant="pm25", pm25=None),
            measurement(aqi=None, measured_at=_at(1, 14)),
        ],
    )
    rows = marts.daily_summary(star).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row["queried_city"], row["region"], row["date"]) == ("ha-noi", "North", date(2026, 1, 1))
    assert (row["avg_aqi"], row["max_aqi"], row["min_aqi"]) == (100.0, 160.0, 40.0)
    assert (row["avg_pm25"], row["avg_humidity"]) == (1.0, None)
    assert (row["station_count"], row["record_count"]) == (2, 3)
    assert row["dominant_pollutant"] == "o3"  # a tie goes to the lowest label
    assert row["pollution_level"] == "Unhealthy"


@pytest.mark.parametrize(
    "labels,expected",
    [(["b", "a", "b"], "b"), (["b", "a"], "a"), ([None, None, "z"], "z"), ([None], None)],
)
def test_most_frequent_label(spark, labels, expected):
    star = star_of(spark, [measurement(dominant_pollutant=label) for label in labels])
    assert marts.daily_summary(star).first()["dominant_pollutant"] == expected


def test_a_day_without_values_is_hazardous(spark):
    star = star_of(spark, [measurement(aqi=None)])
    row = marts.daily_summary(star).first()
    assert (row["avg_aqi"], row["max_aqi"], row["pollution_level"]) == (None, None, "Hazardous")


def test_ranking_averages_days_and_ranks_everything(spark):
    star = star_of(
        spark,
        [
            # two readings on one day weigh as one day
            measurement(aqi=10.0, measured_at=_at(1, 8)),
            measurement(aqi=30.0, measured_at=_at(1, 14)),
            measurement(aqi=60.0, measured_at=_at(2)),
            measurement(aqi=40.0, city_slug="da-nang"),
            measurement(aqi=300.0, city_slug="gia-lai"),
            measurement(aqi=None, city_slug="cao-bang", pm25=None),
        ],
    )
    rows = {r["queried_city"]: r for r in marts.city_ranking(star).collect()}
    assert rows["ha-noi"]["avg_aqi"] == 40.0
    assert (rows["ha-noi"]["record_count"], rows["ha-noi"]["days_good"]) == (2, 1)
    assert rows["ha-noi"]["days_moderate"] == 1
    assert {c: r["aqi_rank"] for c, r in rows.items()} == {
        "cao-bang": 1,  # no average ranks on top
        "gia-lai": 2,
        "ha-noi": 3,
        "da-nang": 3,
    }
    assert rows["cao-bang"]["days_hazardous"] == 1 and rows["cao-bang"]["pm25_rank"] == 1
    assert rows["ha-noi"]["pm25_rank"] == rows["da-nang"]["pm25_rank"] == 2


def test_station_ranks_have_no_gaps(spark):
    values = {1: 50.0, 2: 50.0, 3: 10.0, 4: None}
    star = star_of(spark, [measurement(waqi_idx=i, aqi=v) for i, v in values.items()])
    ranks = {r["waqi_idx"]: r["rank_in_city"] for r in marts.station_summary(star).collect()}
    assert ranks == {4: 1, 1: 2, 2: 2, 3: 3}


def test_seasons_pool_both_ends_of_a_year(spark):
    star = star_of(
        spark, [measurement(aqi=v, measured_at=_at(1, 8, m)) for m, v in ((1, 10.0), (7, 99.0), (12, 30.0))]
    )
    rows = {r["season"]: (r["avg_aqi"], r["record_count"]) for r in marts.seasonal_summary(star).collect()}
    assert rows == {"Dry": (20.0, 2), "Rainy": (99.0, 1)}


def test_hours_and_slice(spark):
    star = star_of(spark, [measurement(aqi=v, measured_at=_at(d, h)) for d, h, v in ((1, 8, 10.0), (2, 8, 10.1), (1, 20, 5.0))])
    hours = {r["hour"]: (r["time_of_day"], r["record_count"]) for r in marts.hourly_pattern(star).collect()}
    assert hours == {8: ("Morning", 2), 20: ("Evening", 1)}
    cut = [tuple(r) for r in marts.star_slice(star).collect()]
    assert cut == [("Ha Noi", "Dry", "Evening", 5.0), ("Ha Noi", "Dry", "Morning", 10.1)]


def _all(written):
    return {name: sorted(map(tuple, df.collect()), key=str) for name, df in written.items()}


def test_marts_from_stored_partials_equal_a_full_refresh(spark, store):
    star = star_of(spark, full_rows(12))
    full = _all(marts.build_marts(star, store, 1, 5, at=datetime(2026, 2, 1)))
    for batch, part in ((1, "station_key % 2 = 0"), (2, "station_key % 2 = 1")):
        piece = Star(star.dates, star.times, star.cities, star.stations, star.fact.filter(part))
        folded = Partials.of(piece, 5).advance(store, batch)
    merged = _all(marts.build_marts(star, store, 2, 5, folded, datetime(2026, 2, 1)))
    assert merged == full
    assert all(full.values())


def test_state_is_one_version_whatever_the_batches(spark, store):
    star = star_of(spark, full_rows(6))
    for batch in range(1, 7):
        piece = Star(star.dates, star.times, star.cities, star.stations, star.fact.filter(f"station_key % 6 = {batch - 1}"))
        Partials.of(piece, 5).advance(store, batch)
    for name in Partials.KEYS:
        assert store.versions(f"gold_state/{name}") == [5, 6]
    day = store.current("gold_state/day")
    assert day.count() == Partials.of(star, 5).day.count()
    assert day.agg({"n": "sum"}).first()[0] == star.fact.count()


def test_monthly_averages_are_not_rounded(spark):
    rows = [measurement(aqi=v, measured_at=_at(1, h)) for h, v in ((8, 50.0), (9, 50.0000000008))]
    ranked = marts.city_ranking(star_of(spark, rows), 1).first()
    assert ranked["avg_aqi"] > 50 and ranked["pollution_level"] == "Moderate"


def test_marts_say_when_they_were_built(spark, store):
    at = datetime(2026, 2, 1, 3)
    for mart in marts.build_marts(star_of(spark, full_rows(3)), store, 1, 5, at=at).values():
        assert {r["aggregated_at"] for r in mart.collect()} == {at}


def test_coverage_counts_months(spark):
    star = star_of(spark, full_rows(6))
    rows = marts.ranking_coverage(marts.city_ranking(star)).collect()
    assert len(rows) == 5 and {r["n_rows"] for r in rows} == {3}
