from __future__ import annotations

from datetime import datetime

from airstrata.operators.conform import conform_city, conform_csv
from airstrata.schemas import CSV_COLUMNS
from airstrata.sources import history

NOW = datetime(2026, 1, 1)
MAP = [("Ha Noi", "ha-noi"), ("Hanoi", "ha-noi")]


def record(**changes):
    row = dict.fromkeys(CSV_COLUMNS, "1")
    row.update(
        station_id="10221",
        location="Ha Noi",
        station_name="Center",
        dominant_pollutant="pm25",
        data_time_s="2021-01-01 08:00:00",
    )
    row.update(changes)
    return row


def land(tmp_path, lines):
    (tmp_path / "in.csv").write_text("\n".join([",".join(CSV_COLUMNS), *lines]) + "\n")
    return str(tmp_path)


def test_short_long_and_quoted_records(spark, tmp_path):
    full = [str(i) for i in range(21)]
    quoted = ['"a, ""b"""', *full[1:]]
    root = land(tmp_path, [",".join(full[:19]), ",".join(full + ["x", "y"]), ",".join(quoted)])
    rows = history.ingest_csv(spark, root, NOW).collect()
    by_id = {(r["station_id"], r["status"], r["alert_level"]) for r in rows}
    assert by_id == {("0", None, None), ("0", "19", "20"), ('a, "b"', "19", "20")}
    assert {r["data_time_tz"] for r in rows} == {"18"}


def test_header_is_skipped_in_every_file(spark, tmp_path):
    for name in ("a", "b"):
        (tmp_path / name).mkdir()
        land(tmp_path / name, [",".join("1" for _ in CSV_COLUMNS)])
    assert history.ingest_csv(spark, str(tmp_path), NOW).count() == 2


def _conform(spark, records):
    from pyspark.sql import functions as F

    schema = ", ".join(f"{c} string" for c in CSV_COLUMNS)
    rows = spark.createDataFrame([tuple(r[c] for c in CSV_COLUMNS) for r in records], schema)
    raw = history.clean_csv(rows.withColumn("source_file", F.lit(None).cast("string")), NOW)
    return conform_csv(raw, spark.createDataFrame(MAP, "source_city string, conformed_city string"))


def test_station_ids_decide_which_rows_stay(spark):
    ids = ["abc", "", "10221.5", " 10221 ", "NA"]
    rows = _conform(spark, [record(station_id=i) for i in ids]).collect()
    assert sorted(r["waqi_idx"] for r in rows) == [10221, 10222]


def test_a_row_without_index_value_stays(spark):
    row = _conform(spark, [record(aqi_index="NA")]).first()
    assert row["aqi"] is None and row["source"] == "kaggle"


def test_a_bad_time_is_null(spark):
    assert _conform(spark, [record(data_time_s="garbage")]).first()["measured_at"] is None


def test_sentinel_label(spark):
    assert _conform(spark, [record(dominant_pollutant="aqi")]).first()["dominant_pollutant"] is None


def test_locations_match_exactly_or_fall_back(spark):
    names = ["Hanoi", " Ha Noi", "Hue", None]
    rows = spark.createDataFrame([(n,) for n in names], "location string")
    mapped = conform_city(rows, spark.createDataFrame(MAP, "source_city string, conformed_city string"))
    assert {r["location"]: r["city_slug"] for r in mapped.collect()} == {
        "Hanoi": "ha-noi",
        " Ha Noi": "ha noi",
        "Hue": "hue",
        None: None,
    }


def test_quoted_line_breaks_on_request(spark, tmp_path):
    from airstrata.schemas import CSV_COLUMNS
    from airstrata.sources.history import scan_csv

    fields = ["1", "5", "Ha Noi", '"two\nlines"', *[""] * (len(CSV_COLUMNS) - 4)]
    (tmp_path / "a.csv").write_text(",".join(CSV_COLUMNS) + "\n" + ",".join(fields) + "\n")
    rows = scan_csv(spark, str(tmp_path), multi_line=True).collect()
    assert [r["station_name"] for r in rows] == ["two\nlines"]
