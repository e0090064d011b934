from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from airstrata.operators import snapshots


def test_clustering_keeps_rows_and_splits_a_hot_key(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    rows = [(1, 20260101, i) for i in range(4000)] + [(2, 20260101 + i % 9, i) for i in range(4000)]
    spark.createDataFrame(rows, "city_key int, date_key int, x int").write.parquet(source)
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    try:
        snapshots.write_clustered(spark.read.parquet(source), target, ["city_key", "date_key"])
    finally:
        spark.conf.unset(key)
    copy = spark.read.parquet(target)
    assert sorted(map(tuple, copy.collect())) == sorted(rows)
    hot = copy.filter("city_key = 1").select(F.col("_metadata.file_path")).distinct().count()
    assert hot > 1


def test_a_hot_key_reaches_all_files(spark, tmp_path):
    source, target = str(tmp_path / "a"), str(tmp_path / "b")
    spark.range(40_000).selectExpr("1 AS city_key", "20260101 AS date_key", "id").write.parquet(source)
    snapshots.write_clustered(spark.read.parquet(source), target, ["city_key", "date_key"], 200)
    files = spark.read.parquet(target).groupBy("_metadata.file_path").count().collect()
    assert len(files) == 200


def test_earlier_states(spark):
    at = [datetime(2026, 1, d) for d in (1, 2, 3)]
    fact = spark.createDataFrame([(t,) for t in at], "ingested_at timestamp_ntz")
    assert snapshots.as_of(fact, at[1]).count() == 2
    assert snapshots.before(fact, at[1]).count() == 1
