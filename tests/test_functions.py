from __future__ import annotations

import math
from fractions import Fraction
from datetime import datetime

from pyspark.sql import functions as F

from airstrata.config import ALERT_LABELS
from airstrata.functions.exact import mean, ordered_mean, sums
from airstrata.functions.levels import aqi_category
from airstrata.functions.parsing import null_tokens_to_null, try_double, try_int, try_timestamp


def _apply(spark, function, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(function(F.col("v"))).collect()]


def test_levels_have_inclusive_bounds_and_a_label_for_missing(spark):
    values = [None, -1.0, 0.0, 50.0, 50.1, 100.0, 150.0, 200.0, 300.0, 300.1]
    assert _apply(spark, aqi_category, values, "double") == [
        "Hazardous",
        "Good",
        "Good",
        "Good",
        "Moderate",
        "Moderate",
        "Unhealthy for Sensitive Groups",
        "Unhealthy",
        "Very Unhealthy",
        "Hazardous",
    ]


def test_alert_labels(spark):
    values = [50.0, 120.0, 301.0]
    assert _apply(spark, lambda c: aqi_category(c, ALERT_LABELS), values, "double") == [
        "good",
        "unhealthy_sensitive",
        "hazardous",
    ]


def test_integers_round_and_bad_text_is_null(spark):
    values = ["abc", "", "10221.5", " 10221 ", "99999999999", None]
    assert _apply(spark, try_int, values) == [None, None, 10222, 10221, None, None]


def test_doubles(spark):
    assert _apply(spark, try_double, ["1.5", "x", "-", "1e2"]) == [1.5, None, None, 100.0]


def test_timestamps_need_a_day(spark):
    values = ["2021-01-01 08:00:00", "2021-01-01T08:00:00", "2021-01-01", "2021", "garbage", None]
    at = datetime(2021, 1, 1, 8)
    assert _apply(spark, try_timestamp, values) == [at, at, datetime(2021, 1, 1), None, None, None]
    assert _apply(spark, try_timestamp, ["2021-01", " 2021-1-2 03:04"]) == [None, datetime(2021, 1, 2, 3, 4)]


def test_null_tokens_are_exact(spark):
    values = ["", "NULL", "null", "NA", "N/A", "na", " NA", "x"]
    assert _apply(spark, null_tokens_to_null, values) == [None] * 5 + ["na", " NA", "x"]


def _mean(spark, values, parts, decimals=5):
    df = spark.createDataFrame([(v,) for v in values], "v double").repartition(parts)
    return df.agg(*sums(F.col("v"), "v", decimals)).select(mean("v")).first()[0]


def test_exact_means_do_not_depend_on_order(spark):
    values = [i / 10 for i in range(1000)] + [1e15, 0.1234567, -3.25]
    want = float(sum(Fraction(repr(v)) for v in values) / len(values))
    for parts in (1, 7, 32):
        assert _mean(spark, values, parts, 7) == want


def test_means_keep_every_double(spark):
    nan, inf = float("nan"), float("inf")
    assert math.isnan(_mean(spark, [1.0, nan, 2.0], 2))
    assert _mean(spark, [1.0, inf, 2.0], 2) == inf
    assert math.isnan(_mean(spark, [inf, -inf], 1))
    assert _mean(spark, [1e300], 1) == 1e300 and _mean(spark, [1e15], 1) == 1e15
    assert _mean(spark, [50.0000000004], 1) == 50.0000000004
    assert _mean(spark, [None, None], 1) is None and _mean(spark, [], 1) is None
    assert _mean(spark, [None, 3.0, 1e16], 3, None) == (3.0 + 1e16) / 2


def test_ordered_mean(spark):
    df = spark.createDataFrame([([0.3, 0.1, 0.2],), ([],), ([1.0, float("nan")],)], "v array<double>")
    found = [r[0] for r in df.select(ordered_mean(F.col("v"))).collect()]
    assert found[:2] == [(0.1 + 0.2 + 0.3) / 3, None] and math.isnan(found[2])


def test_null_label(spark):
    df = spark.createDataFrame([(None,), (50.0,), (float("nan"),)], "v double")
    rows = df.select(aqi_category(F.col("v"), null_label=None), aqi_category(F.col("v"), null_label="?")).collect()
    assert [tuple(r) for r in rows] == [(None, "?"), ("Good", "Good"), ("Hazardous", "Hazardous")]
