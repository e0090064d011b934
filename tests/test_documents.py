from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import functions as F

from airstrata.operators.conform import conform_api, tagged_api, unread_api_values
from airstrata.sources import documents

NOW = datetime(2026, 1, 1)


def body(**changes):
    data = {
        "aqi": 42.5,
        "idx": 10221,
        "dominentpol": "pm25",
        "time": {"iso": "2026-01-01T08:00:00+07:00"},
        "city": {"name": "Center", "url": "u", "geo": [21.0, 105.5]},
        "iaqi": {"pm25": {"v": 40}, "h": {"v": 70.5}},
        "_queried_city": "ha-noi",
    }
    data.update(changes)
    return data


def wrapped(**changes):
    return {"status": "ok", "data": body(**changes)}


def land(tmp_path, files):
    for name, content in files.items():
        path = tmp_path / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(content if isinstance(content, str) else json.dumps(content, indent=2))
    return str(tmp_path)


def test_files_of_every_shape(spark, tmp_path):
    root = land(
        tmp_path,
        {
            "api/ha-noi/one.json": wrapped(),
            "api/ha-noi/bare.json": body(aqi=1),
            "api/da-nang/two.json": [wrapped(aqi=2), wrapped(aqi=3)],
            "api/empty.json": "[]",
            "api/double.json": '{"status":"ok","data":{"aqi":1,"aqi":2,"_queried_city":"x"}}',
            "api/cut.json": json.dumps(wrapped())[:-5],
            "api/error.json": {"status": "error", "data": "Unknown station"},
            "api/nowhere.json": {"status": "ok", "data": {"aqi": 3}},
            "api/notes.txt": "not for us",
        },
    )
    raw = documents.ingest_api(spark, root, NOW)
    rows = raw.select(
        F.element_at(F.split("source_file", "/"), -1).alias("file"), "reject_reason", "ingested_at"
    ).collect()
    found = sorted((r["file"], r["reject_reason"] or "") for r in rows)
    assert found == [
        ("bare.json", ""),
        ("cut.json", "malformed_json"),
        ("double.json", "malformed_json"),
        ("error.json", "status_not_ok"),
        ("nowhere.json", "no_queried_city"),
        ("one.json", ""),
        ("two.json", ""),
        ("two.json", ""),
    ]
    assert {r["ingested_at"] for r in rows} == {NOW}


def test_a_nested_key_given_twice_is_malformed(spark):
    texts = spark.createDataFrame([('{"data":{"x":{"a":1,"a":2}}}',)], "value string")
    assert documents.parse_documents(texts).first()["raw_payload"] is None


def test_lines_layout_reads_one_document_per_line(spark, tmp_path):
    root = land(tmp_path, {"bulk.json": "\n".join(json.dumps(wrapped(aqi=i)) for i in range(5))})
    raw = documents.ingest_api(spark, root, NOW, whole_files=False)
    assert raw.filter("reject_reason is null").count() == 5


def test_city_falls_back_to_the_folder(spark):
    texts = spark.createDataFrame(
        [(json.dumps({"aqi": 1}), "file:/x/api/da-nang/a.json")], "value string, source_file string"
    )
    parsed = documents.parse_documents(texts)
    assert documents.envelope_gate(parsed).first()["queried_city"] is None
    assert documents.envelope_gate(parsed, True).first()["queried_city"] == "da-nang"


def _raw(spark, docs):
    texts = spark.createDataFrame([(json.dumps(d),) for d in docs], "value string")
    return documents.parse_documents(texts).select(
        documents.queried_city().alias("queried_city"),
        "raw_payload",
        F.lit(NOW).cast("timestamp_ntz").alias("ingested_at"),
    )


def test_typed_columns(spark):
    row = conform_api(_raw(spark, [wrapped()])).first()
    assert (row["waqi_idx"], row["aqi"], row["lat"], row["lon"]) == (10221, 42.5, 21.0, 105.5)
    assert row["measured_at"] == datetime(2026, 1, 1, 8)  # the zone is cut off
    assert (row["pm25"], row["humidity"], row["pm10"]) == (40.0, 70.5, None)
    assert (row["source"], row["city_slug"]) == ("api", "ha-noi")


def test_both_shapes_give_the_same_row(spark):
    rows = conform_api(_raw(spark, [wrapped(), body()])).collect()
    assert rows[0] == rows[1]


def test_index_missing_null_text_and_not_a_number(spark):
    without = body()
    del without["aqi"]
    docs = [without, body(aqi=None), body(aqi="-"), body(aqi="17"), wrapped(aqi=None)]
    tagged = tagged_api(_raw(spark, docs)).select("aqi", "reject_reason").collect()
    assert sorted((r[0] or 0, r[1] or "") for r in tagged) == [(0, "aqi_not_numeric"), (17.0, "")]


def test_the_sentinel_label_is_null(spark):
    rows = conform_api(_raw(spark, [body(dominentpol="aqi"), body(dominentpol=None)])).collect()
    assert [r["dominant_pollutant"] for r in rows] == [None, None]


def test_wrong_types_inside_do_not_lose_the_document(spark):
    doc = body(iaqi={"pm25": {"v": "bad"}, "pm10": 5, "co": {"v": "4.5"}}, time="yesterday")
    row = conform_api(_raw(spark, [doc])).first()
    assert (row["pm25"], row["pm10"], row["co"], row["measured_at"]) == (None, None, 4.5, None)


def test_station_without_name_is_rejected(spark):
    tagged = tagged_api(_raw(spark, [body(city={"geo": [1, 2]}), body(idx=None)]))
    assert {r["reject_reason"] for r in tagged.collect()} == {"no_station_name", "no_station_id"}


def test_unpivot_emits_the_key_whatever_the_reading(spark):
    docs = [body(iaqi={"pm25": {"v": 1}, "new": {"v": 2.5}}), wrapped(iaqi={}), body(iaqi=None)]
    rows = documents.unpivot_readings(_raw(spark, docs)).collect()
    assert sorted((r["pollutant"], r["value"]) for r in rows) == [("new", 2.5), ("pm25", 1.0)]


def test_peek_is_ordered_and_limited(spark):
    docs = [body(aqi=i, _queried_city=f"c{i % 3}") for i in range(30)]
    rows = documents.raw_peek(_raw(spark, docs), 4).collect()
    assert [(r["queried_city"], r["aqi"]) for r in rows] == [
        ("c0", 0.0),
        ("c0", 3.0),
        ("c0", 6.0),
        ("c0", 9.0),
    ]


def test_unread_readings_of_accepted_documents_are_counted(spark):
    odd = {"pm25": {"v": "-"}, "pm10": {"v": None}, "h": {"v": "7.5"}, "t": {}, "w": {"v": [1]}}
    bodies = [
        wrapped(iaqi=odd),
        body(iaqi=odd, time={"iso": "soon"}),
        wrapped(iaqi={}, time={}),
        wrapped(aqi="-", iaqi=odd),  # refused, so its readings do not count
        wrapped(idx=None, iaqi=odd),
    ]
    texts = spark.createDataFrame([(json.dumps(b),) for b in bodies], "value string")
    found = unread_api_values(documents.parse_documents(texts)).collect()
    assert {r["reason"]: r["n_rows"] for r in found} == {
        "pm25_not_numeric": 2,
        "wind_not_numeric": 2,
        "time_not_parsed": 1,
    }
    assert unread_api_values(documents.parse_documents(texts.limit(0))).count() == 0
