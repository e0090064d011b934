from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from airstrata.operators.ordering import (
    dense_rank_desc,
    dense_rank_desc_within,
    global_index,
)


def brute_ranks(values):
    distinct = sorted({v for v in values if v is not None}, reverse=True)
    order = ([None] if None in values else []) + distinct
    return {v: i + 1 for i, v in enumerate(order)}


@pytest.fixture
def many_ranges(spark):
    """Keep small shuffles in several partitions, as large ones would be."""
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(key, "false")
    yield spark
    spark.conf.unset(key)


@pytest.mark.parametrize("parts", [1, 4, 32])
def test_index_does_not_depend_on_partitions(many_ranges, parts):
    values = list(range(5000))
    random.Random(parts).shuffle(values)
    df = many_ranges.createDataFrame([(v * 3,) for v in values], "v int").repartition(parts)
    rows = global_index(df, ["v"]).collect()
    assert {r["v"]: r["idx"] for r in rows} == {v * 3: v for v in range(5000)}
    assert len(rows) == 5000


def test_index_of_nothing(spark):
    assert global_index(spark.createDataFrame([], "v int"), ["v"]).count() == 0


def test_global_ranks_with_ties_nulls_and_a_hot_value(many_ranges):
    rng = random.Random(2)
    values = [rng.choice([7.5, None] + [float(i) for i in range(400)]) for _ in range(2000)]
    values += [7.5] * 1000
    other = [v if v is None else -v for v in values]
    df = many_ranges.createDataFrame(list(zip(range(3000), values, other)), "i int, v double, w double")
    rows = dense_rank_desc(df, {"v": "rv", "w": "rw"}).collect()
    assert len(rows) == 3000
    by_v, by_w = brute_ranks(values), brute_ranks(other)
    assert all(r["rv"] == by_v[r["v"]] and r["rw"] == by_w[r["w"]] for r in rows)


def test_ranks_within_groups_agree_with_a_window(many_ranges):
    rng = random.Random(3)
    data = [
        (i, rng.choice(["a", "b", None]) if i % 3 else "hot", rng.choice([None, 1.0, 2.0, 3.5, float("nan"), float("inf"), -0.0, 0.0, float(i)]))
        for i in range(1500)
    ]
    df = many_ranges.createDataFrame(data, "i int, g string, v double")
    rows = dense_rank_desc_within(df, ["g"], "v", "r").collect()
    order = Window.partitionBy("g").orderBy(F.col("v").desc_nulls_first())
    expected = {r["i"]: r["r"] for r in df.withColumn("r", F.dense_rank().over(order)).collect()}
    assert {r["i"]: r["r"] for r in rows} == expected
    assert len(rows) == 1500


def test_ranks_put_nan_between_null_and_numbers(many_ranges):
    values = [None, float("nan"), float("inf"), 2.0, 1.0, float("-inf"), float("nan")]
    df = many_ranges.createDataFrame(list(enumerate(values)), "i int, v double")
    rows = dense_rank_desc(df, {"v": "r"}).collect()
    assert [r["r"] for r in sorted(rows)] == [1, 2, 3, 4, 5, 6, 2]
