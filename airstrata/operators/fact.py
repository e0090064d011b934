"""The measurement fact: resolve the four dimension keys of each measurement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airstrata.functions.levels import aqi_category
from airstrata.schemas import FACT_COLUMNS


def _with_keys(
    measurements: DataFrame,
    dates: DataFrame,
    times: DataFrame,
    cities: DataFrame,
    stations: DataFrame,
    how: str,
) -> DataFrame:
    """Join the dimensions; only the keys come along.

    No join is hinted: the dimensions are stored tables, so their size is known
    and Spark broadcasts what is below spark.sql.autoBroadcastJoinThreshold. A
    station table beyond it is joined by shuffle, where adaptive execution
    splits the partition of a station that holds much of the data.
    """
    at = F.col("measured_at")
    day = dates.select("date_key", F.col("full_date").alias("_day"))
    clock = times.select("time_key", F.col("hour").alias("_hour"), F.col("minute").alias("_minute"))
    station_ids = stations.select("station_key", "waqi_idx", "city_key")
    return (
        measurements.withColumn("_day", F.to_date(at))
        .withColumn("_hour", F.hour(at))
        .withColumn("_minute", F.minute(at))
        .join(day, "_day", how)
        .join(clock, ["_hour", "_minute"], how)
        .join(cities.select("city_key", "city_slug"), "city_slug", how)
        .join(station_ids, ["waqi_idx", "city_key"], how)
    )


def build_fact(
    measurements: DataFrame,
    dates: DataFrame,
    times: DataFrame,
    cities: DataFrame,
    stations: DataFrame,
    dedup: bool = False,
) -> DataFrame:
    """Fact rows of the measurements that resolve in every dimension.

    With ``dedup`` one row stays per station, city, time and source: the one loaded last,
    and among these the one with the highest readings, so that the choice is fixed.
    """
    timed = measurements.filter(F.col("measured_at").isNotNull())
    if dedup:
        keys = ["waqi_idx", "city_slug", "measured_at", "source"]
        others = [c for c in timed.columns if c not in keys]
        order = ["ingested_at", *[c for c in others if c != "ingested_at"]]
        newest = F.max(F.struct(*order)).alias("_row")
        timed = timed.groupBy(*keys).agg(newest).select(*keys, "_row.*")
    return (
        _with_keys(timed, dates, times, cities, stations, "inner")
        .withColumn("pollution_level", aqi_category(F.col("aqi")))
        .select(*FACT_COLUMNS)
    )


# the outcomes of a measurement, the first that applies
OUTCOMES = (
    "no_timestamp",
    "unknown_city",
    "unknown_station",
    "date_outside_calendar",
    "time_not_on_the_hour",
    "kept",
)


def drop_reason() -> Column:
    return (
        F.when(F.col("measured_at").isNull(), "no_timestamp")
        .when(F.col("city_key").isNull(), "unknown_city")
        .when(F.col("station_key").isNull(), "unknown_station")
        .when(F.col("date_key").isNull(), "date_outside_calendar")
        .when(F.col("time_key").isNull(), "time_not_on_the_hour")
        .otherwise("kept")
    )


def keyed_measurements(
    measurements: DataFrame,
    dates: DataFrame,
    times: DataFrame,
    cities: DataFrame,
    stations: DataFrame,
) -> DataFrame:
    """Fact columns of every measurement and its ``outcome``; keys are missing where it has no row."""
    keyed = _with_keys(measurements, dates, times, cities, stations, "left")
    return keyed.withColumn("pollution_level", aqi_category(F.col("aqi"))).select(
        *FACT_COLUMNS, drop_reason().alias("outcome")
    )


def fact_outcomes(
    measurements: DataFrame,
    dates: DataFrame,
    times: DataFrame,
    cities: DataFrame,
    stations: DataFrame,
) -> DataFrame:
    """How many measurements reach the fact, and why the others do not."""
    keyed = _with_keys(measurements, dates, times, cities, stations, "left")
    return (
        keyed.select(drop_reason().alias("outcome"))
        .groupBy("outcome")
        .agg(F.count("*").alias("n_rows"))
    )
