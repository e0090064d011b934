"""Guards on the physical plans."""

from __future__ import annotations

import pytest

from airstrata.config import GateConfig
from airstrata.operators import marts, quality
from airstrata.plans import catalog

SF = "/root/testdata/sf0.001"

MARTS = {
    "daily_summary": marts.daily_summary,
    "seasonal_summary": marts.seasonal_summary,
    "hourly_pattern": marts.hourly_pattern,
}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def silver(spark):
    return catalog.silver(spark, SF)


@pytest.mark.parametrize("name", MARTS)
def test_marts_have_no_python_and_no_single_partition(silver, name):
    text = plan(MARTS[name](silver, 5))
    assert "SinglePartition" not in text
    assert "Python" not in text and "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_marts_aggregate_before_the_exchange_and_read_few_columns(silver):
    text = plan(marts.hourly_pattern(silver, 5))
    scan = next(line for line in text.splitlines() if "FileScan" in line and "aqi" in line)
    schema = scan.split("ReadSchema: ")[1]
    assert schema.count(":") == 5  # two keys and three readings
    assert "partial_count" in text


def test_ranks_use_no_global_window_and_gather_no_column(silver):
    text = plan(marts.city_ranking(silver, 5))
    assert "Window" not in text
    assert "Exchange hashpartitioning(coalesce(_column" not in text


def test_the_gate_scans_the_fact_once(silver):
    text = plan(quality.profile(silver, GateConfig()))
    scans = [line for line in text.splitlines() if "FileScan" in line and "pm25" in line]
    assert len(scans) == 1
    assert "SinglePartition" not in text


def test_conform_walks_each_document_once(spark):
    text = plan(catalog.query_conform_api(spark, SF))
    assert text.count("StructField(dominentpol") <= 4
    assert "Python" not in text


def test_fact_joins_do_not_shuffle_the_measurements(spark, silver):
    from airstrata.operators.fact import build_fact

    rows = spark.read.parquet(catalog.silver_store(spark, SF).path("silver/measurement"))
    text = plan(build_fact(rows, silver.dates, silver.times, silver.cities, silver.stations))
    assert "Exchange hashpartitioning" not in text


def test_filters_on_load_time_reach_the_scan(silver):
    from datetime import datetime

    from airstrata.operators import snapshots

    text = plan(snapshots.as_of(silver.fact, datetime(2024, 1, 16)))
    assert "LessThanOrEqual(ingested_at" in text
    recent = silver.fact.filter("aqi > 0").filter(
        snapshots.F.col("ingested_at") >= quality._oldest(GateConfig(), datetime(2024, 1, 16))
    )
    assert "GreaterThanOrEqual(ingested_at" in plan(recent)


def test_station_candidates_shrink_before_the_exchange(spark, silver):
    from airstrata.operators.dimensions import station_candidates

    rows = spark.read.parquet(
        catalog.silver_store(spark, SF).path("silver/measurement")
    )
    text = plan(station_candidates(rows, silver.cities))
    first = text[: text.index("FileScan")]
    assert first.rindex("partial_max(measured_at") > first.rindex("Exchange hashpartitioning")
    assert "Window" not in text
