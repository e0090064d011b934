from __future__ import annotations

from dataclasses import replace
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from airstrata.config import GateConfig
from airstrata.operators import quality
from tests.stars import LOAD, full_rows, reference, star_of


@pytest.fixture(scope="module")
def good(spark):
    return star_of(spark, full_rows(4))


def outcome(spark, star, as_of=LOAD, config=GateConfig()):
    rows = quality.gate_results(star, reference(spark), config, as_of).collect()
    assert len(rows) == 7
    return {r["check_name"]: (r["passed"], r["detail"]) for r in rows}


def failed(results):
    return [name for name, (passed, _) in results.items() if not passed]


def test_a_good_star_passes(spark, good):
    results = outcome(spark, good)
    assert failed(results) == []
    assert results["row_count"][1] == "rows=20"
    assert results["null_pct"][1] == "worst null%=0"
    assert results["city_coverage"][1] == "all reference cities present"
    assert results["freshness"][1] == "fresh rows=20"


def _with(star, **columns):
    return replace(
        star, fact=star.fact.withColumns({c: F.expr(sql) for c, sql in columns.items()})
    )


CITY = "city_key = 1"
ROW = "city_key = 1 AND station_key = 1"


@pytest.mark.parametrize(
    "check,change,detail",
    [
        ("null_pct", {"pm25": f"if({CITY}, null, pm25)"}, "worst null%=20 (max 5%)"),
        ("aqi_range", {"aqi": f"if({ROW}, 500.1D, aqi)"}, "violations=1"),
        ("city_coverage", {"city_key": f"if({CITY}, 2, city_key)"}, "missing=1"),
        ("source_validity", {"source": f"if({ROW}, 'x', source)"}, "invalid=1"),
        (
            "freshness",
            {"ingested_at": "ingested_at - INTERVAL 49 HOURS"},
            "no rows loaded within 48h",
        ),
        ("fk_integrity", {"station_key": f"if({ROW}, 999, station_key)"}, "orphan fact rows=1"),
        (
            "fk_integrity",
            {"date_key": f"if({ROW}, 1, date_key)", "time_key": f"if({CITY}, 1, time_key)"},
            "orphan fact rows=4",
        ),
    ],
)
def test_each_fault_fails_its_check_only(spark, good, check, change, detail):
    results = outcome(spark, _with(good, **change))
    assert failed(results) == [check]
    assert results[check][1] == detail


@pytest.mark.parametrize("rows,passes", [(9, False), (10, True)])
def test_row_count_bound(spark, good, rows, passes):
    star = replace(good, fact=good.fact.limit(rows))
    assert outcome(spark, star)["row_count"] == (
        (True, "rows=10") if passes else (False, "rows=9 (min 10)")
    )


def test_null_share_of_exactly_the_limit_passes(spark, good):
    star = _with(good, pm25=f"if({ROW}, null, pm25)")
    assert outcome(spark, star)["null_pct"] == (True, "worst null%=5")


def test_range_bounds_are_allowed(spark, good):
    star = _with(good, aqi=f"if({CITY}, 500.0D, 0.0D)")
    assert outcome(spark, star)["aqi_range"][0]


def test_freshness_bound(spark, good):
    assert outcome(spark, good, LOAD + timedelta(hours=48))["freshness"][0]
    assert not outcome(spark, good, LOAD + timedelta(hours=48, seconds=1))["freshness"][0]


def test_unknown_source_is_not_counted(spark, good):
    star = _with(good, source=f"if({ROW}, null, source)")
    assert outcome(spark, star)["source_validity"][0]


def test_an_empty_fact(spark, good):
    results = outcome(spark, replace(good, fact=good.fact.limit(0)))
    assert sorted(failed(results)) == ["city_coverage", "freshness", "row_count"]
    assert results["null_pct"] == (True, "worst null%=0")
    assert results["city_coverage"][1] == "missing=5"


def test_results_are_logged_before_the_stop(spark, good, store):
    star = _with(good, aqi="-1.0D")
    with pytest.raises(quality.QualityGateError) as error:
        quality.run_gate(star, reference(spark), store, 3, LOAD)
    assert error.value.failed == ["aqi_range"]
    logged = store.appended("control/dq_results")
    assert logged.count() == 7
    assert {r["run_id"] for r in logged.collect()} == {"run-3"}
