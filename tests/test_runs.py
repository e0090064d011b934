from __future__ import annotations

import json
from dataclasses import replace
from datetime import datetime, timedelta

import pytest

from airstrata.config import GateConfig, RunConfig
from airstrata.operators import quality
from airstrata.operators.quality import QualityGateError
from airstrata.plans.medallion import load_silver, quarantine, run_medallion, setup, star
from airstrata.schemas import CSV_COLUMNS
from airstrata.sources.store import Store
from airstrata.streaming import jobs
from tests.stars import SLUGS
from tests.test_documents import wrapped
from tests.test_history import record

LOAD = datetime(2026, 2, 1)
CONFIG = RunConfig(decimals=2)
NAMES = {
    "ha-noi": "Ha Noi",
    "ho-chi-minh-city": "Ho Chi Minh",
    "da-nang": "Da Nang",
    "gia-lai": "Gia Lai",
    "cao-bang": "Cao Bang",
}


def land(root, tag, days, bad=False):
    """One document per file, several cities; the records in one CSV file."""
    api = root / "api"
    for i, slug in enumerate(SLUGS):
        folder = api / slug
        folder.mkdir(parents=True, exist_ok=True)
        for day in days:
            at = datetime(2026, 1, day, 8)
            doc = wrapped(
                aqi=30.5 + 10 * i + day,
                idx=100 + i,
                time={"iso": at.strftime("%Y-%m-%dT%H:%M:%SZ")},
                iaqi={"pm25": {"v": day}, "pm10": {"v": day * 1.5}},
                _queried_city=slug,
            )
            (folder / f"{slug}_{tag}_{day}.json").write_text(json.dumps(doc, indent=2))
    if bad:
        (api / "cut.json").write_text('{"status": "ok", "data": {')
    lines = [",".join(CSV_COLUMNS)]
    for slug in SLUGS:
        for day in days:
            at = datetime(2021, 1, day, 14)
            row = record(
                station_id="500",
                aqi_index="80.5",
                location=NAMES[slug],
                data_time_s=at.strftime("%Y-%m-%d %H:%M:%S"),
            )
            lines.append(",".join(row[c] for c in CSV_COLUMNS))
    (root / f"history_{tag}.csv").write_text("\n".join(lines) + "\n")


def rows(df, *drop):
    return sorted(map(str, df.drop(*drop).collect()))


def test_batch_runs_load_each_file_once(spark, store, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a", [1, 2], bad=True)
    setup(store, CONFIG)
    assert run_medallion(store, str(landing), 1, LOAD, CONFIG).code == 0
    assert star(store).fact.count() == 20
    refused = {(r["layer"], r["reject_reason"], r["n_rows"]) for r in quarantine(store).collect()}
    assert refused == {("bronze", "malformed_json", 1)}
    assert store.current("gold/city_ranking").count() == 10
    land(landing, "b", [3])
    assert run_medallion(store, str(landing), 2, LOAD, CONFIG).code == 0
    assert star(store).fact.count() == 30
    assert run_medallion(store, str(landing), 3, LOAD, CONFIG).code == 0
    assert star(store).fact.count() == 30
    assert store.current("silver/dim_station").count() == 10


def test_a_replayed_batch_changes_nothing(spark, store, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a", [1, 2])
    setup(store, CONFIG)
    run_medallion(store, str(landing), 1, LOAD, CONFIG)
    land(landing, "b", [3])
    run_medallion(store, str(landing), 2, LOAD, CONFIG)
    tables = ["silver/dim_station", "gold/daily_summary", "gold/station_summary"]
    before = [rows(store.current(t)) for t in tables] + [rows(star(store).fact)]
    run_medallion(store, str(landing), 2, LOAD, CONFIG)
    after = [rows(store.current(t)) for t in tables] + [rows(star(store).fact)]
    assert after == before


def test_gold_is_not_touched_when_the_gate_fails(spark, store, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a", [1])
    setup(store, CONFIG)
    strict = replace(CONFIG, gate=GateConfig(min_rows=11))
    status = run_medallion(store, str(landing), 1, LOAD, strict)
    assert (status.code, status.failed_checks) == (1, ("row_count",))
    assert store.current("gold/daily_summary") is None
    assert star(store).fact.count() == 10  # silver stays
    assert store.appended("control/dq_results").filter("not passed").count() == 1


def test_an_incomplete_version_is_not_read(spark, store):
    one = spark.range(1)
    store.replace("t", one, 1)
    spark.conf.set("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
    spark.range(5).write.parquet(store.path("t") + "/v=2")  # as if the writer died at the end
    spark.conf.unset("mapreduce.fileoutputcommitter.marksuccessfuljobs")
    assert store.current("t").count() == 1
    assert store.current_version("t", before=1) is None


def test_stream_equals_batch_and_rests_without_new_files(spark, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a", [1, 2], bad=True)
    batch, stream = (Store(spark, str(tmp_path / name)) for name in ("batch", "stream"))
    for store in (batch, stream):
        setup(store, CONFIG)
    run_medallion(batch, str(landing), 1, LOAD, CONFIG)
    jobs.run_once(stream, str(landing), LOAD, CONFIG, files_per_batch=3)
    keys = ["station_key"]
    assert rows(star(stream).fact, *keys) == rows(star(batch).fact, *keys)
    for mart in ("daily_summary", "city_ranking", "station_summary", "hourly_pattern", "seasonal_summary"):
        assert rows(stream.current(f"gold/{mart}")) == rows(batch.current(f"gold/{mart}"))
    version = stream.current_version("gold/daily_summary")
    jobs.run_once(stream, str(landing), LOAD, CONFIG)
    assert stream.current_version("gold/daily_summary") == version
    land(landing, "b", [5])
    run_medallion(batch, str(landing), 2, LOAD, CONFIG)
    jobs.run_once(stream, str(landing), LOAD, CONFIG)
    assert stream.current_version("gold/daily_summary") > version
    for mart in ("daily_summary", "station_summary"):
        assert rows(stream.current(f"gold/{mart}")) == rows(batch.current(f"gold/{mart}"))


def test_stream_can_stop_at_the_gate(spark, store, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a", [1])
    setup(store, CONFIG)
    for query in jobs.stream_bronze(store, str(landing)):
        query.awaitTermination()
    strict = replace(CONFIG, gate=GateConfig(min_rows=11))
    query = jobs.stream_gold(store, LOAD, strict, stop_on_failure=True)
    with pytest.raises(Exception, match="row_count"):
        query.awaitTermination()
    assert store.current("gold/daily_summary") is None


def test_a_micro_batch_processed_twice_gives_the_same_tables(spark, store):
    from tests.stars import SCHEMA, full_rows

    setup(store, CONFIG)
    whole = full_rows(6)
    first, second = (spark.createDataFrame(part, SCHEMA) for part in (whole[::2], whole[1::2]))
    relaxed = replace(CONFIG, gate=GateConfig(max_null_pct=100), keep_versions=2)
    load = datetime(2026, 2, 1) + timedelta(hours=1)
    jobs.process_batch(store, first, 1, load, relaxed)
    jobs.process_batch(store, second, 2, load, relaxed)
    before = rows(store.current("gold/daily_summary")), rows(store.current("silver/dim_station"))
    jobs.process_batch(store, second, 2, load, relaxed)
    after = rows(store.current("gold/daily_summary")), rows(store.current("silver/dim_station"))
    assert after == before
    assert load_silver(store, second, 2, load).fact.count() == len(whole)
    # counters merged over the batches say what a scan of the whole fact says
    silver, reference = star(store), store.current("control/city_reference")
    counted = quality.stored_profile(store, silver, 2, relaxed.gate, load)
    merged = quality.gate_results(silver, reference, relaxed.gate, load, counted)
    assert rows(merged) == rows(quality.gate_results(silver, reference, relaxed.gate, load))
    jobs.process_batch(store, second, 3, load, relaxed)
    assert store.current_version("gold/daily_summary", before=2) is None
    assert store.current_version("gold/daily_summary", before=3) == 2


def test_files_of_any_name_are_loaded_once(spark, store, tmp_path):
    from airstrata.plans.medallion import load_bronze

    landing = tmp_path / "odd names"
    landing.mkdir()
    for name in ("a[1].json", "d{x}.json", "p q%20.json", "s*t?.json"):
        (landing / name).write_text('{"status": "ok", "data": {"aqi": 1}}')
    assert load_bronze(store, str(landing), 1, LOAD) == 4
    assert load_bronze(store, str(landing), 2, LOAD) == 0
    assert store.appended("bronze/api_raw").count() == 4
