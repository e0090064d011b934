from __future__ import annotations

import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from airstrata.config import RunConfig
from airstrata.plans import medallion
from airstrata.plans.medallion import load_bronze, quarantine
from airstrata.schemas import CSV_COLUMNS
from airstrata.sources import documents, history, ledger
from airstrata.sources.landing import landing_roots
from airstrata.sources.store import Store
from airstrata.streaming import jobs

LOAD = datetime(2026, 2, 1)


def doc(folder, name, **fields):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(json.dumps({"status": "ok", "data": {"aqi": 1, **fields}}))


def test_folders_in_a_fixed_order_and_none_in_another():
    assert landing_roots(["/b/", "/a", "/b"]) == ["/a", "/b"]
    assert landing_roots(["/a", "/ab"]) == ["/a", "/ab"]
    with pytest.raises(ValueError):
        landing_roots(["/a", "/a/b"])


def test_a_stream_loads_all_its_folders_once(spark, store, tmp_path):
    roots = [str(tmp_path / r) for r in ("one", "two")]
    for i, root in enumerate(("one", "two")):
        doc(tmp_path / root, "a.json", _queried_city=f"c{i}")
    for _ in range(2):
        for query in jobs.stream_bronze(store, roots, F.lit(LOAD)):
            query.awaitTermination()
    doc(tmp_path / "one", "b.json", _queried_city="c2")
    for query in jobs.stream_bronze(store, roots[::-1], F.lit(LOAD)):
        query.awaitTermination()
    rows = spark.read.parquet(store.path(jobs.API_BRONZE))
    assert sorted(r["queried_city"] for r in rows.collect()) == ["c0", "c1", "c2"]
    with pytest.raises(ValueError):
        jobs.stream_bronze(store, [*roots, str(tmp_path / "three")])


def test_a_load_that_died_is_loaded_once_by_a_later_batch(spark, store, tmp_path, monkeypatch):
    landing = tmp_path / "landing"
    doc(landing, "a.json", _queried_city="x")
    append = Store.append

    def dies(self, name, *args):
        if name == ledger.LEDGER_TABLE:
            raise OSError("lost")
        return append(self, name, *args)

    monkeypatch.setattr(Store, "append", dies)
    with pytest.raises(Exception, match="lost"):
        load_bronze(store, str(landing), 1, LOAD)
    monkeypatch.undo()
    doc(landing, "b.json", _queried_city="y")
    assert load_bronze(store, str(landing), 2, LOAD) == 2
    assert sorted(r["queried_city"] for r in store.appended("bronze/api_raw").collect()) == ["x", "y"]
    names = store.appended(ledger.LEDGER_TABLE).select("file_name").collect()
    assert sorted(r["file_name"].split("/")[-1] for r in names) == ["a.json", "b.json"]


def test_a_completed_batch_takes_no_later_files(spark, store, tmp_path):
    doc(tmp_path / "in", "a.json", _queried_city="x")
    assert load_bronze(store, str(tmp_path / "in"), 1, LOAD) == 1
    doc(tmp_path / "in", "b.json", _queried_city="y")
    assert load_bronze(store, str(tmp_path / "in"), 1, LOAD) == 1
    assert load_bronze(store, str(tmp_path / "in"), 2, LOAD) == 1


def test_the_folder_names_the_city_on_request(spark, tmp_path):
    doc(tmp_path / "hue", "a.json")
    assert documents.ingest_api(spark, str(tmp_path), LOAD).first()["reject_reason"] == "no_queried_city"
    texts = documents.scan_text(spark, str(tmp_path))
    row = documents.tag_api(documents.parse_documents(texts), LOAD, city_from_folder=True).first()
    assert (row["queried_city"], row["reject_reason"]) == ("hue", None)


def csv(root, *lines):
    root.mkdir(parents=True, exist_ok=True)
    (root / "in.csv").write_text("\n".join([",".join(CSV_COLUMNS), *lines]) + "\n")


def test_runs_pass_the_settings_of_the_landing_on(spark, store, tmp_path):
    fields = ["1", "5", "Hue", '"two\nlines"', *["1"] * (len(CSV_COLUMNS) - 4)]
    csv(tmp_path / "in", ",".join(fields))
    doc(tmp_path / "in" / "hue", "a.json")
    load_bronze(store, str(tmp_path / "in"), 1, LOAD, config=RunConfig(multi_line=True, city_from_folder=True))
    assert store.appended("bronze/historical_csv").first()["station_name"] == "two\nlines"
    assert store.appended("bronze/api_raw").first()["reject_reason"] is None


def test_cut_and_padded_records_are_counted_with_their_text(spark, store, tmp_path):
    full = [str(i) for i in range(len(CSV_COLUMNS))]
    odd = ['"a, ""b"", c"', *full[1:]]
    csv(tmp_path / "in", ",".join(full), ",".join(odd), ",".join(odd[:5]), ",".join([*odd, "x", '"y,z"']))
    load_bronze(store, str(tmp_path / "in"), 1, LOAD)
    rows = store.appended("bronze/historical_csv")
    shapes = {(r["record_shape"], r["raw_record"]) for r in rows.collect()}
    assert shapes == {(None, None), ("padded", ",".join(odd[:5])), ("cut", ",".join([*odd, "x", '"y,z"']))}
    # also where only a column or two of the file is asked for
    raw = history.ingest_csv(spark, str(tmp_path / "in"), LOAD)
    assert {(r["record_shape"], r["n_rows"]) for r in history.shape_counts(raw).collect()} == {("padded", 1), ("cut", 1)}
    found = {(r["layer"], r["reject_reason"], r["n_rows"]) for r in quarantine(store).collect()}
    assert {("bronze", "record_cut", 1), ("bronze", "record_padded", 1)} <= found


def test_entries_of_objects_and_arrays_at_any_depth(spark):
    text = '{"a": {"b": [1, {"c": null}], "d": "x"}, "e": []}'
    docs = documents.parse_documents(spark.createDataFrame([(text, 7), ("5", 8), ("bad", 9)], "value string, id int"))
    docs = docs.select("id", "raw_payload")
    top = {(r["id"], r["path"], r["key"], r["index"]) for r in documents.flatten(docs).collect()}
    assert top == {(7, "$.a", "a", None), (7, "$.e", "e", None)}
    deep = {(r["path"], r["key"], r["index"]) for r in documents.flatten(docs, deep=True).collect()}
    assert deep == {
        ("$.a", "a", None),
        ("$.e", "e", None),
        ("$.a.b", "b", None),
        ("$.a.d", "d", None),
        ("$.a.b[0]", None, 0),
        ("$.a.b[1]", None, 1),
        ("$.a.b[1].c", "c", None),
    }


def test_no_file_list_reaches_the_driver():
    import inspect

    assert "toLocalIterator" not in inspect.getsource(ledger) + inspect.getsource(medallion)
