"""Calendar, time-of-day, city and station dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airstrata.config import (
    API_SOURCE,
    DRY,
    HOUR_BANDS,
    OTHER_HOURS,
    SPINE_END,
    SPINE_START,
    WET,
    WET_MONTHS,
)
from airstrata.operators.upsert import allocate_keys, require_unique, upsert
from airstrata.schemas import CITY_COLUMNS, STATION_COLUMNS


def dim_date(spark: SparkSession, start: str = SPINE_START, end: str = SPINE_END) -> DataFrame:
    """One row per calendar day from ``start`` to ``end``, both included."""
    day = F.col("full_date")
    first, last = F.to_date(F.lit(start)), F.to_date(F.lit(end))
    return (
        spark.range(1)
        .select(F.explode(F.sequence(first, last)).alias("full_date"))
        .select(
            (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).alias("date_key"),
            day,
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            F.monthname(day).alias("month_name"),
            F.day(day).alias("day_of_month"),
            (F.weekday(day) + 1).alias("day_of_week"),
            F.dayname(day).alias("day_name"),
            F.quarter(day).alias("quarter"),
            F.weekofyear(day).alias("week_of_year"),
            (F.weekday(day) >= 5).alias("is_weekend"),
            F.when(F.month(day).between(*WET_MONTHS), WET).otherwise(DRY).alias("season"),
        )
    )


def dim_time(spark: SparkSession, minutes: bool = False) -> DataFrame:
    """One row per full hour, or per minute of the day.

    With full hours, readings off the hour have no row here.
    """
    step, rows = (1, 1440) if minutes else (60, 24)
    band = F.lit(OTHER_HOURS)
    for name, first, last in HOUR_BANDS:
        band = F.when(F.col("hour").between(first, last), name).otherwise(band)
    hour, minute = F.floor(F.col("id") * step / 60), F.col("id") * step % 60
    return spark.range(rows).select(
        (hour * 100 + minute).cast("int").alias("time_key"),
        hour.cast("int").alias("hour"),
        minute.cast("int").alias("minute"),
    ).withColumn("time_of_day", band)


def merge_city(current: DataFrame | None, reference: DataFrame) -> DataFrame:
    """Next version of the city dimension: reference attributes win."""
    require_unique(reference, ["city_slug"])
    source = reference.select(*[c for c in CITY_COLUMNS if c != "city_key"])
    if current is None:
        return allocate_keys(source, ["city_slug"], "city_key", 1).select(*CITY_COLUMNS)
    taken = {c: F.col(f"s.{c}") for c in ("city_name", "region", "lat", "lon")}
    return upsert(current.select(*CITY_COLUMNS), source, ["city_slug"], taken, "city_key")


def station_candidates(measurements: DataFrame, cities: DataFrame) -> DataFrame:
    """Best row per station with its observation window.

    API rows beat text records, then the latest measurement wins; a missing
    time counts as latest. Rows tied on both are decided by their attributes.

    The first step is a hash aggregate over the nearly constant attributes of a
    station: each task sends one row per variant of a station, however many
    measurements it read, so a station with most of the data is no bottleneck.
    """
    attributes = ["station_name", "lat", "lon", "url", "source"]
    variants = (
        measurements.join(cities.select("city_key", "city_slug"), "city_slug")
        .groupBy("waqi_idx", "city_key", *attributes)
        .agg(
            F.max(F.col("measured_at").isNull().cast("int")).alias("untimed"),
            F.min("measured_at").alias("first_seen"),
            F.max("measured_at").alias("last_seen"),
        )
    )
    order = F.struct(
        (F.col("source") == API_SOURCE).alias("from_api"),
        "untimed",
        F.when(F.col("untimed") == 0, F.col("last_seen")).alias("at"),
        *attributes,
    )
    return (
        variants.groupBy("waqi_idx", "city_key")
        .agg(
            F.max_by(F.struct(*attributes), order).alias("best"),
            F.min("first_seen").alias("first_seen"),
            F.max("last_seen").alias("last_seen"),
        )
        .select("waqi_idx", "city_key", "best.*", "first_seen", "last_seen")
    )


# fixed for the life of a store: the part a station is in, from its natural key
STATION_BUCKETS = 16
STATION_BUCKET = f"pmod(xxhash64(waqi_idx, city_key), {STATION_BUCKETS})"


def merge_station(
    current: DataFrame | None,
    candidates: DataFrame,
    load_ts,
    order_free: bool = False,
    start: int | None = None,
) -> DataFrame:
    """Next version of the station dimension.

    The key and the first sighting of a known station never change; missing
    coordinates, address and time keep what is known. With ``order_free`` the sightings
    are the earliest and latest of all batches, the source is the API if any batch had it,
    and name, address and coordinates are the highest of any batch, so the order of the
    batches does not matter. ``start`` is the first key for new stations, where ``current`` is
    a part of the dimension only.
    """
    source = candidates.withColumn("is_active", F.lit(True)).withColumn(
        "loaded_at", F.lit(load_ts).cast("timestamp_ntz")
    )
    natural = ["waqi_idx", "city_key"]
    if current is None:
        return allocate_keys(source, natural, "station_key", start or 1).select(*STATION_COLUMNS)
    taken = {c: F.col(f"s.{c}") for c in ("station_name", "source", "is_active", "loaded_at")}
    for c in ("lat", "lon", "url", "last_seen"):
        taken[c] = F.coalesce(F.col(f"s.{c}"), F.col(f"t.{c}"))
    if order_free:
        # each by itself is the same in whatever order versions meet; "api" sorts first
        pick = {"source": F.least, "station_name": F.greatest, "url": F.greatest}
        for c, choose in pick.items():
            taken[c] = choose(f"s.{c}", f"t.{c}")
        sides = [F.when(F.col(f"{x}.lat").isNotNull(), F.struct(f"{x}.lat", f"{x}.lon")) for x in "st"]
        taken["lat"], taken["lon"] = F.greatest(*sides)["lat"], F.greatest(*sides)["lon"]
        taken["first_seen"] = F.least("s.first_seen", "t.first_seen")
        taken["last_seen"] = F.greatest("s.last_seen", "t.last_seen")
    return upsert(current.select(*STATION_COLUMNS), source, natural, taken, "station_key", start)
