"""Partitioned tables: only what a batch touches is written anew."""

from __future__ import annotations

from dataclasses import replace
from datetime import datetime, timedelta

import pytest

from airstrata.config import GateConfig, RunConfig
from airstrata.functions.exact import with_exact
from airstrata.operators import marts, rollups
from airstrata.operators.marts import Partials
from airstrata.plans import surface
from airstrata.plans.medallion import as_of, gold, run_medallion, setup, star
from airstrata.session import glob_paths
from airstrata.streaming import jobs
from tests.stars import SCHEMA, full_rows, measurement, star_of
from tests.test_runs import CONFIG, LOAD, land, rows

ANY = replace(CONFIG, gate=GateConfig(stop_on=()))


def table(spark, values):
    return spark.createDataFrame(values, "k int, p int")


def files(store, name):
    return sorted(p.split(name)[-1] for p in glob_paths(store.spark, f"{store.path(name)}/v=*/part=*"))


def test_parts_are_replaced_one_by_one(spark, store):
    name = "gold_state/monthly"
    store.patch(name, table(spark, [(1, 1), (2, 2), (3, 3)]), 1, "p")
    store.patch(name, table(spark, [(20, 2), (4, 4)]), 2, "p", {2, 3, 4})
    assert rows(store.current(name)) == rows(table(spark, [(1, 1), (20, 2), (4, 4)]))
    assert rows(store.current(name, before=2)) == rows(table(spark, [(1, 1), (2, 2), (3, 3)]))
    assert rows(store.read_parts(name, {1, 2})) == rows(table(spark, [(1, 1), (20, 2)]))
    # a replay of the second batch starts from the first
    store.patch(name, table(spark, [(21, 2)]), 2, "p", {2})
    assert rows(store.current(name)) == rows(table(spark, [(1, 1), (21, 2), (3, 3)]))
    store.expire(name, 2)
    assert files(store, name) == ["/v=1/part=1", "/v=1/part=3", "/v=2/part=2"]
    assert store.versions(name) == [2] and store.current(name).count() == 3
    store.patch(name, table(spark, [(5, 5)]), 3, "p")
    assert rows(store.current(name)) == rows(table(spark, [(5, 5)]))


def test_a_patch_counts_once_its_list_of_parts_is_written(spark, store):
    name = "gold_state/monthly"
    store.patch(name, table(spark, [(1, 1)]), 1, "p")
    store.path(name)
    table(spark, [(9, 1)]).withColumnRenamed("p", "part").write.partitionBy("part").parquet(f"{store.path(name)}/v=2")
    assert store.current(name).first()["k"] == 1


def months(day_rows, *numbers):
    return [measurement(measured_at=datetime(2026, m, d, 8), city_slug=c, waqi_idx=i, aqi=float(d + m)) for m in numbers for d, c, i in day_rows]


DAYS = [(1, "ha-noi", 1), (2, "da-nang", 2), (3, "gia-lai", 3)]


def test_a_micro_batch_rewrites_only_its_months(spark, store):
    setup(store, ANY)
    frame = lambda values: spark.createDataFrame(values, SCHEMA)
    jobs.process_batch(store, frame(months(DAYS, 1, 2, 3)), 1, LOAD, ANY)
    before = {n: files(store, f"gold/{n}") for n in marts.MART_PARTS}
    jobs.process_batch(store, frame(months(DAYS[:1], 2)), 2, LOAD, ANY)
    for name, parts in before.items():
        fresh = set(files(store, f"gold/{name}")) - set(parts)
        year = name == "seasonal_summary"
        assert fresh == {"/v=2/part=2026" if year else "/v=2/part=202602"}
        assert store.parts(f"gold/{name}") == ({2026: 2} if year else {202601: 1, 202602: 2, 202603: 1})
    assert len(set(store.parts("silver/dim_station").values())) == 2
    # the marts are those of a full refresh
    full = marts.build_marts(star(store), store, 9, 2, at=LOAD)
    for name, mart in full.items():
        assert rows(mart) == rows(gold(store, name, before=9)), name


def test_renamed_stations_and_gates_that_held_back_reach_older_months(spark, store):
    setup(store, ANY)
    frame = lambda values: spark.createDataFrame(values, SCHEMA)
    jobs.process_batch(store, frame(months(DAYS, 1, 2)), 1, LOAD, ANY)
    strict = replace(CONFIG, gate=GateConfig(min_rows=10**6))
    assert jobs.process_batch(store, frame(months(DAYS, 3)), 2, LOAD, strict).code == 1
    assert sorted(store.parts("gold/daily_summary")) == [202601, 202602]
    renamed = [measurement(measured_at=datetime(2026, 4, 1, 8), waqi_idx=1, station_name="new")]
    jobs.process_batch(store, frame(renamed), 3, LOAD, ANY)
    assert store.parts("gold/daily_summary") == {202601: 3, 202602: 3, 202603: 3, 202604: 3}
    full = marts.build_marts(star(store), store, 9, 2, at=LOAD)
    for name, mart in full.items():
        assert rows(mart) == rows(gold(store, name, before=9)), name


def test_one_scan_gives_the_partials_of_separate_scans(spark):
    small = star_of(spark, full_rows(8))
    one, many = Partials.scanned(small, 5), Partials.of(small, 5)
    for name in Partials.KEYS:
        left, right = getattr(one, name), getattr(many, name)
        assert sorted(left.columns) == sorted(right.columns)
        assert rows(left.select(*right.columns)) == rows(right)


def test_station_grains_are_dealt_in_tasks_of_bounded_size(spark, store, monkeypatch):
    small = star_of(spark, full_rows(8))
    want = {name: rows(getattr(Partials.of(small, 5), name)) for name in Partials.KEYS}
    marts_then = {name: rows(m) for name, m in marts.build_marts(small, store, 1, 5, at=LOAD).items()}
    monkeypatch.setattr(rollups, "MERGED_ROWS", 3)
    asked, repartition = [], type(small.fact).repartition
    monkeypatch.setattr(type(small.fact), "repartition", lambda f, *a: asked.append(a[0]) or repartition(f, *a))
    many = Partials.scanned(small, 5)
    for name, found in want.items():
        columns = getattr(Partials.of(small, 5), name).columns
        assert rows(getattr(many, name).select(*columns)) == found, name
    # months and days of stations: no task merges more than its share
    assert len(asked) == 2 and min(asked) >= small.fact.count() / 3
    assert many.rows == len(want["station_month"])
    assert {n: rows(m) for n, m in marts.build_marts(small, store, 2, 5, many, LOAD).items()} == marts_then


def test_all_marts_read_the_fact_once(spark):
    small = star_of(spark, full_rows(4))
    fine = Partials.scanned(small, 5)
    for part in (fine.day, fine.station_day, fine.station_month, fine.hour):
        text = part._jdf.queryExecution().executedPlan().toString()
        assert "grains" in text and "measured_at" not in text
    # and the decimals are worked out in a projection of their own
    text = with_exact(small.fact, ["aqi"], 5).groupBy("city_key").agg({"exact_aqi": "sum"})
    assert "exact_aqi" in text._jdf.queryExecution().optimizedPlan().toString()


def test_odd_readings_stop_no_run_whose_gate_only_logs_them(spark, store, tmp_path):
    landing = tmp_path / "landing"
    land(landing, "a", [1, 2])
    path = landing / "history_a.csv"
    lines = path.read_text().splitlines()
    for at, odd in ((1, "NaN"), (2, "Infinity"), (3, "1e15")):
        lines[at] = lines[at].replace("80.5", odd)
    path.write_text("\n".join(lines) + "\n")
    setup(store, CONFIG)
    assert run_medallion(store, str(landing), 1, LOAD, CONFIG).failed_checks == ("aqi_range",)
    assert gold(store, "daily_summary").count() == 0  # empty, with its columns
    others = ("row_count", "null_pct", "city_coverage", "source_validity", "freshness", "fk_integrity")
    logged = replace(CONFIG, gate=GateConfig(stop_on=others))
    assert run_medallion(store, str(landing), 2, LOAD, logged).code == 0
    failed = store.appended("control/dq_results").filter("not passed and run_id = 'run-2'").collect()
    assert [r["check_name"] for r in failed] == ["aqi_range"]
    assert gold(store, "daily_summary").count() == 20


def test_a_stream_tells_how_it_ended(spark, store, tmp_path):
    land(tmp_path / "landing", "a", [1])
    setup(store, CONFIG)
    strict = replace(CONFIG, gate=GateConfig(min_rows=11))
    status = jobs.run_once(store, str(tmp_path / "landing"), LOAD, strict)
    assert (status.code, status.failed_checks) == (1, ("row_count",))
    assert jobs.run_once(store, str(tmp_path / "landing"), LOAD, strict).code == 0  # nothing new


def test_all_layers_as_of_a_moment_and_the_report(spark, store, tmp_path):
    landing = tmp_path / "landing"
    setup(store, CONFIG)
    land(landing, "a", [1, 2], bad=True)
    run_medallion(store, str(landing), 1, LOAD, CONFIG)
    land(landing, "b", [3])
    run_medallion(store, str(landing), 2, LOAD + timedelta(hours=2), CONFIG)
    assert as_of(store, LOAD - timedelta(hours=1)) is None
    then, now = as_of(store, LOAD + timedelta(hours=1)), as_of(store, datetime(2027, 1, 1))
    assert (then.batch, now.batch) == (1, 2)
    assert (then.star.fact.count(), now.star.fact.count()) == (20, 30)
    assert (then.marts["daily_summary"].count(), now.marts["daily_summary"].count()) == (20, 30)
    report = {(r["step"], r["metric"]): r["n_rows"] for r in store.appended("control/run_report").filter("n_rows > 0").collect()}
    assert report[("fact", "kept")] in (20, 10) and report[("conform", "rows")] in (20, 10)
    surface.register(store, then)
    assert spark.sql("SELECT count(*) FROM daily_summary").first()[0] == 20


def test_sql_names_show_the_current_state_without_python(spark, store, tmp_path):
    setup(store, CONFIG)
    land(tmp_path / "landing", "a", [1])
    run_medallion(store, str(tmp_path / "landing"), 1, LOAD, CONFIG)
    surface.register(store)
    query = spark.sql("SELECT aqi_category(aqi) AS level, count(*) AS n FROM fact_aqi GROUP BY 1")
    assert {(r["level"], r["n"]) for r in query.collect()} == {
        (r["pollution_level"], r["count"]) for r in star(store).fact.groupBy("pollution_level").count().collect()
    }
    assert "Python" not in query._jdf.queryExecution().executedPlan().toString()
    for view in ("dim_date", "dim_time", "dim_city", "dim_station", *marts.LAYOUT):
        spark.table(view).first()
    assert spark.sql("SELECT aqi_category(NULL)").first()[0] == "Hazardous"
