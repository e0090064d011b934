"""Gold marts over the star schema."""

from __future__ import annotations

from collections.abc import Collection
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airstrata.config import LEVEL_LABELS
from airstrata.functions.exact import mean, merged_sums, ordered_mean, prepared_sums, with_exact
from airstrata.functions.levels import aqi_category
from airstrata.operators.ordering import dense_rank_desc, dense_rank_desc_within
from airstrata.operators.rollups import (
    LABEL,
    averages,
    dealt,
    merge_partials,
    most_frequent,
    roll_up,
    start_partials,
)
from airstrata.session import materialize

DAY_MEASURES = ["aqi", "pm25", "pm10", "humidity", "temperature"]
CORE_MEASURES = ["aqi", "pm25", "pm10"]


@dataclass(frozen=True)
class Star:
    """The silver layer: four dimensions and the fact, all stored tables."""

    dates: DataFrame
    times: DataFrame
    cities: DataFrame
    stations: DataFrame
    fact: DataFrame


@dataclass(frozen=True)
class Partials:
    """What the marts are made of: partial aggregates of the fact, which merge.

    ``day``: per city, day and label. ``station_day``: which stations reported
    per city and day. ``station_month``: per station, city, month and label.
    ``hour``: per city and hour. Unless they are stored, nothing is computed until a mart
    needs it.
    """

    day: DataFrame
    station_day: DataFrame
    station_month: DataFrame
    hour: DataFrame
    #: rows of station_month, where it is stored
    rows: int = 0

    STATION_MONTH = ["station_key", "city_key", "year", "month"]
    KEYS = {
        "day": ["city_key", "date_key", LABEL],
        "station_day": ["city_key", "date_key", "station_key"],
        "station_month": [*STATION_MONTH, LABEL],
        "hour": ["city_key", "time_key"],
    }
    #: the month of a row, like 202401, by which all but the small last one are stored
    PARTS = {
        "day": "date_key div 100",
        "station_day": "date_key div 100",
        "station_month": "year * 100 + month",
    }

    @classmethod
    def of(cls, star: Star, decimals: int | None = None) -> Partials:
        """Each straight from the fact, for a single mart."""
        day = start_partials(DAY_MEASURES)
        fact = with_exact(star.fact, DAY_MEASURES, decimals)
        months = fact.join(_calendar(star, "year", "month"), "date_key")
        return cls(
            fact.groupBy(*cls.KEYS["day"]).agg(*day),
            star.fact.select(*cls.KEYS["station_day"]).distinct(),
            months.groupBy(*cls.KEYS["station_month"]).agg(*day),
            fact.groupBy(*cls.KEYS["hour"]).agg(*start_partials(CORE_MEASURES)),
        )

    @classmethod
    def scanned(cls, star: Star, decimals: int | None = None) -> Partials:
        """All four, stored, for several marts.

        One scan sums at the two grains that have few groups however large the fact is, city
        and day and label, and city and hour. At the grains of single stations there are nearly
        as many groups as rows: the few columns these need are dealt by key and merged there.
        """
        fact, count = star.fact, star.fact.count()
        grains = (
            with_exact(fact, DAY_MEASURES, decimals)
            .groupingSets([cls.KEYS["day"], cls.KEYS["hour"]], *cls.KEYS["day"], "time_key")
            .agg(*start_partials(DAY_MEASURES), F.grouping("time_key").alias("by_day"))
        )
        grains = materialize(grains, "grains")
        hours = [c for c in grains.columns if c not in {"date_key", LABEL, "by_day"}]
        months = fact.join(_calendar(star, "year", "month"), "date_key")
        months = months.select(*cls.KEYS["station_month"], *DAY_MEASURES)
        months = with_exact(dealt(months, cls.STATION_MONTH, count), DAY_MEASURES, decimals)
        months = months.groupBy(*cls.KEYS["station_month"]).agg(*start_partials(DAY_MEASURES))
        months = materialize(months, "month-grains")
        days = cls.KEYS["station_day"]
        return cls(
            grains.filter("by_day = 1").drop("by_day", "time_key"),
            materialize(dealt(fact.select(*days), days, count).distinct(), "day-grains"),
            months,
            grains.filter("by_day = 0").select(*[c for c in hours if not c.endswith(("humidity", "temperature"))]),
            months.count(),
        )

    def advance(self, store, batch: int) -> Partials:
        """Fold these partials of one batch into the stored state of the batches before it.

        Only the months that the batch has rows of are read and written, so its cost follows
        these; a state version builds on versions before it, so a replay gives the same.
        """
        months = self.day.select(F.expr(self.PARTS["day"]).alias("part")).distinct()
        touched = {r["part"] for r in months.collect()}
        for name, part in self.PARTS.items():
            table = f"gold_state/{name}"
            known = store.read_parts(table, touched, before=batch)
            fresh = self._fold(name, known, getattr(self, name))
            store.patch(table, fresh, batch, part, touched, self.KEYS[name][:2])
            store.expire(table, batch - 1)
        table = "gold_state/hour"
        store.replace(table, self._fold("hour", store.current(table, before=batch), self.hour), batch)
        store.expire(table, batch - 1)
        return Partials.stored(store, batch)

    def _fold(self, name: str, known: DataFrame | None, fresh: DataFrame) -> DataFrame:
        if known is None:
            return fresh
        both = known.unionByName(fresh)
        if name == "station_day":
            return both.distinct()
        measures = CORE_MEASURES if name == "hour" else DAY_MEASURES
        if name == "station_month":
            both = dealt(both, self.STATION_MONTH, known.count())
        return both.groupBy(*self.KEYS[name]).agg(*merge_partials(measures))

    @classmethod
    def stored(cls, store, batch: int, months: Collection[int] | None = None) -> Partials | None:
        """The state after a batch, of the given months; None if there is none of them."""
        found = [store.read_parts(f"gold_state/{name}", months, before=batch + 1) for name in cls.PARTS]
        hour = store.current("gold_state/hour", before=batch + 1)
        if any(f is None for f in found):
            return None
        return cls(*found, hour, found[list(cls.PARTS).index("station_month")].count())


def _city_names(star: Star) -> DataFrame:
    return star.cities.select(
        "city_key", F.col("city_slug").alias("queried_city"), "city_name", "region"
    )


def _calendar(star: Star, *columns: str) -> DataFrame:
    return star.dates.select("date_key", *columns)


def _daily(star: Star, day: DataFrame) -> DataFrame:
    return (
        roll_up(day, ["city_key", "date_key"], DAY_MEASURES)
        .join(_city_names(star), "city_key")
        .join(_calendar(star, F.col("full_date").alias("date")), "date_key")
        .select(
            "city_key",
            "date_key",
            "queried_city",
            "city_name",
            "region",
            "date",
            *averages(DAY_MEASURES),
            "max_aqi",
            "min_aqi",
            F.col("n").alias("record_count"),
            LABEL,
            aqi_category(F.col("max_aqi")).alias("pollution_level"),
        )
    )


def daily_summary(
    star: Star, decimals: int | None = None, partials: Partials | None = None
) -> DataFrame:
    """One row per city and day; the level follows the day's highest index."""
    partials = partials or Partials.of(star, decimals)
    stations = partials.station_day.groupBy("city_key", "date_key").agg(
        F.count("station_key").alias("station_count")
    )
    return (
        _daily(star, partials.day)
        .join(stations, ["city_key", "date_key"])
        .select(
            "queried_city",
            "city_name",
            "region",
            "date",
            "avg_aqi",
            "max_aqi",
            "min_aqi",
            "avg_pm25",
            "avg_pm10",
            "avg_humidity",
            "avg_temperature",
            "station_count",
            "record_count",
            LABEL,
            "pollution_level",
        )
    )


# fixed values: name of the day count of each level
DAY_COUNTS = dict(
    zip(
        LEVEL_LABELS,
        [
            "days_good",
            "days_moderate",
            "days_sensitive",
            "days_unhealthy",
            "days_very_unhealthy",
            "days_hazardous",
        ],
    )
)


def monthly_from_daily(daily: DataFrame) -> DataFrame:
    """One row per city and month from the daily mart: averages of daily averages.

    A month of a city has at most 31 days, so its daily averages are brought together
    and added in order of size: the result does not depend on how the rows were spread.
    """
    keys = ["queried_city", "city_name", "region", "year", "month"]
    values = [F.collect_list(f"avg_{m}").alias(f"days_of_{m}") for m in CORE_MEASURES]
    days = [
        F.count_if(F.col("pollution_level") == level).alias(name)
        for level, name in DAY_COUNTS.items()
    ]
    by_label = (
        daily.withColumn("year", F.year("date"))
        .withColumn("month", F.month("date"))
        .groupBy(*keys, LABEL)
        .agg(
            F.count("*").alias("n"),
            F.max("max_aqi").alias("max_aqi"),
            F.min("min_aqi").alias("min_aqi"),
            *values,
            *days,
        )
    )
    monthly = by_label.groupBy(*keys).agg(
        *merge_partials([]),
        *[F.flatten(F.collect_list(f"days_of_{m}")).alias(f"days_of_{m}") for m in CORE_MEASURES],
        *[F.sum(name).alias(name) for name in DAY_COUNTS.values()],
        most_frequent().alias(LABEL),
    )
    return monthly.select(
        *keys,
        *[ordered_mean(F.col(f"days_of_{m}")).alias(f"avg_{m}") for m in CORE_MEASURES],
        "max_aqi",
        "min_aqi",
        F.col("n").alias("record_count"),
        *DAY_COUNTS.values(),
        LABEL,
    ).withColumn("pollution_level", aqi_category(F.col("avg_aqi")))


def city_ranking(
    star: Star, decimals: int | None = None, daily: DataFrame | None = None
) -> DataFrame:
    """Monthly figures per city, ranked over all cities and months."""
    if daily is None:
        daily = _daily(star, Partials.of(star, decimals).day)
    return rank_cities(materialize(monthly_from_daily(daily), "monthly"))


def rank_cities(monthly: DataFrame) -> DataFrame:
    """Ranks over all cities and months; ``monthly`` should be a stored result."""
    return dense_rank_desc(monthly, {"avg_aqi": "aqi_rank", "avg_pm25": "pm25_rank"})


def station_summary(
    star: Star, decimals: int | None = None, partials: Partials | None = None
) -> DataFrame:
    """One row per station and month, ranked within its city and month."""
    partials = partials or Partials.of(star, decimals)
    keys = Partials.STATION_MONTH
    named = (
        roll_up(dealt(partials.station_month, keys, partials.rows), keys, DAY_MEASURES)
        .join(
            star.stations.select("station_key", "waqi_idx", "station_name", "lat", "lon"),
            "station_key",
        )
        .join(_city_names(star), "city_key")
    )
    summary = named.select(
        "waqi_idx",
        "station_name",
        "queried_city",
        "city_name",
        "region",
        "lat",
        "lon",
        "year",
        "month",
        *averages(DAY_MEASURES),
        "max_aqi",
        "min_aqi",
        F.col("n").alias("record_count"),
        LABEL,
    ).withColumn("pollution_level", aqi_category(F.col("avg_aqi")))
    return dense_rank_desc_within(
        materialize(summary, "station-summary"),
        ["queried_city", "year", "month"],
        "avg_aqi",
        "rank_in_city",
    )


def hourly_pattern(
    star: Star, decimals: int | None = None, partials: Partials | None = None
) -> DataFrame:
    """One row per city and hour of the day."""
    partials = partials or Partials.of(star, decimals)
    return (
        partials.hour.join(_city_names(star), "city_key")
        .join(star.times.select("time_key", "hour", "time_of_day"), "time_key")
        .select(
            "queried_city",
            "city_name",
            "region",
            "hour",
            "time_of_day",
            *averages(CORE_MEASURES),
            F.col("n").alias("record_count"),
        )
    )


def seasonal_summary(
    star: Star, decimals: int | None = None, partials: Partials | None = None
) -> DataFrame:
    """One row per city, calendar year and season."""
    partials = partials or Partials.of(star, decimals)
    keys = ["city_key", "year", "season"]
    by_label = (
        partials.day.join(_calendar(star, "year", "season"), "date_key")
        .groupBy(*keys, LABEL)
        .agg(*merge_partials(CORE_MEASURES))
    )
    return (
        roll_up(by_label, keys, CORE_MEASURES)
        .join(_city_names(star), "city_key")
        .select(
            "queried_city",
            "city_name",
            "region",
            "year",
            "season",
            *averages(CORE_MEASURES),
            "max_aqi",
            "min_aqi",
            F.col("n").alias("record_count"),
            LABEL,
        )
    )


def star_slice(star: Star, decimals: int | None = None) -> DataFrame:
    """Average index by city, season and time of day, to one decimal, sorted."""
    totals = (
        with_exact(star.fact, ["aqi"], decimals)
        .groupBy("city_key", "date_key", "time_key")
        .agg(*prepared_sums("aqi"))
        .join(_city_names(star), "city_key")
        .join(_calendar(star, "season"), "date_key")
        .join(star.times.select("time_key", "time_of_day"), "time_key")
        .groupBy("city_name", "season", "time_of_day")
        .agg(*merged_sums("aqi"))
    )
    return totals.select(
        "city_name", "season", "time_of_day", F.round(mean("aqi"), 1).alias("avg_aqi")
    ).orderBy(*[F.col(c).asc_nulls_last() for c in ("city_name", "season", "time_of_day")])


def ranking_coverage(ranking: DataFrame) -> DataFrame:
    """Load check: months per city in the ranking mart."""
    return ranking.groupBy("queried_city").agg(F.count("*").alias("n_rows"))


# how the marts are laid out: sort columns whose tail makes a row unique
LAYOUT = {
    "daily_summary": ["date", "queried_city"],
    "city_ranking": ["year", "month", "queried_city"],
    "station_summary": ["queried_city", "year", "month", "waqi_idx"],
    "hourly_pattern": ["queried_city", "hour"],
    "seasonal_summary": ["queried_city", "year", "season"],
}
# the part of a partitioned mart that a row is in
MART_PARTS = {
    "daily_summary": "year(date) * 100 + month(date)",
    "station_summary": "year * 100 + month",
    "seasonal_summary": "year",
}


def _at(moment) -> Column:
    now = moment or datetime.now(timezone.utc).replace(tzinfo=None)
    return F.lit(now).cast("timestamp_ntz")


def _all_of(jobs: dict) -> dict:
    """Results of independent jobs by name; submitted together, they fill the cluster between them."""
    with ThreadPoolExecutor(4) as pool:
        started = {name: pool.submit(copy_context().run, job) for name, job in jobs.items()}
    return {name: job.result() for name, job in started.items()}


def build_marts(
    star: Star,
    store,
    version: int,
    decimals: int | None = None,
    partials: Partials | None = None,
    at=None,
) -> dict[str, DataFrame]:
    """Write all five marts as one version and return what was written.

    Every row carries ``aggregated_at``, the time ``at`` or else that of the write (UTC).

    Without ``partials`` the fact is scanned once for all marts; the ranking reads the
    stored daily mart.
    """
    partials = partials or Partials.scanned(star, decimals)

    def publish(name: str, mart: DataFrame) -> DataFrame:
        mart = mart.withColumn("aggregated_at", _at(at))
        if name in MART_PARTS:
            return store.patch(f"gold/{name}", mart, version, MART_PARTS[name], None, LAYOUT[name])
        return store.replace(f"gold/{name}", mart, version, LAYOUT[name])

    def daily_and_ranking() -> tuple[DataFrame, DataFrame]:
        daily = publish("daily_summary", daily_summary(star, decimals, partials))
        return daily, publish("city_ranking", city_ranking(star, decimals, daily.drop("aggregated_at")))

    built = _all_of(
        {
            "daily_summary": daily_and_ranking,
            "station_summary": lambda: publish("station_summary", station_summary(star, decimals, partials)),
            "hourly_pattern": lambda: publish("hourly_pattern", hourly_pattern(star, decimals, partials)),
            "seasonal_summary": lambda: publish("seasonal_summary", seasonal_summary(star, decimals, partials)),
        }
    )
    built["daily_summary"], built["city_ranking"] = built["daily_summary"]
    return {name: built[name] for name in LAYOUT}


def _renamed_months(star: Star, store, since: int, batch: int) -> set[int]:
    """Months whose marts show a station or city that has other attributes than at ``since``."""

    def changed(now: DataFrame, then: DataFrame | None, columns: list[str]) -> DataFrame:
        # known keys only: new ones are in the batch's own months
        return now.select(*columns).join(then.select(columns[0]), columns[0]).exceptAll(then.select(*columns))

    names = ["city_key", "city_slug", "city_name", "region"]
    cities = store.current("silver/dim_city", before=since + 1)
    if cities is not None and not changed(star.cities, cities, names).isEmpty():
        return set(store.parts("gold_state/day", before=batch + 1))
    moved = {p for p, v in store.parts("silver/dim_station", before=batch + 1).items() if v > since}
    then = store.read_parts("silver/dim_station", moved, before=since + 1)
    if then is None:
        return set()
    now = store.read_parts("silver/dim_station", moved, before=batch + 1)
    stations = changed(now, then, ["station_key", "waqi_idx", "station_name", "lat", "lon"])
    state = store.current("gold_state/station_month", before=batch + 1)
    months = state.join(stations.select("station_key"), "station_key", "left_semi")
    return {r["part"] for r in months.select(F.expr(Partials.PARTS["station_month"]).alias("part")).distinct().collect()}


def refresh_marts(star: Star, store, batch: int, decimals: int | None = None, at=None) -> None:
    """Bring the marts up to the stored state of a batch.

    Daily and station marts are rewritten for the months, the seasonal one for the years, that
    changed since the marts were last written, even if a gate held back some batches.
    Ranks run over all cities and months, so the ranking is replaced, from a stored row per
    city and month; so is the hourly mart with its row per city and hour.
    """
    since = store.current_version("gold/daily_summary", before=batch)
    state = store.parts("gold_state/day", before=batch + 1)
    months = {p for p, v in state.items() if since is None or v > since}
    if since is not None:
        months |= _renamed_months(star, store, since, batch)
    years = {m // 100 for m in months}
    partials = Partials.stored(store, batch, months)

    def publish(name: str, mart: DataFrame, touched: Collection[int]) -> DataFrame:
        mart = mart.withColumn("aggregated_at", _at(at))
        return store.patch(f"gold/{name}", mart, batch, MART_PARTS[name], touched, LAYOUT[name])

    def daily() -> None:
        built = publish("daily_summary", daily_summary(star, decimals, partials), months)
        monthly = monthly_from_daily(built.drop("aggregated_at"))
        store.patch("gold_state/monthly", monthly, batch, "year * 100 + month", months)
        store.expire("gold_state/monthly", batch - 1)
        ranked = rank_cities(store.current("gold_state/monthly", before=batch + 1))
        store.replace("gold/city_ranking", ranked.withColumn("aggregated_at", _at(at)), batch, LAYOUT["city_ranking"])

    def seasonal() -> None:
        whole = Partials.stored(store, batch, {m for m in state if m // 100 in years})
        publish("seasonal_summary", seasonal_summary(star, decimals, whole), years)

    def hourly() -> None:
        mart = hourly_pattern(star, decimals, partials).withColumn("aggregated_at", _at(at))
        store.replace("gold/hourly_pattern", mart, batch, LAYOUT["hourly_pattern"])

    if partials is None:
        build_marts(star, store, batch, decimals, at=at)
        return
    _all_of(
        {
            "daily": daily,
            "stations": lambda: publish("station_summary", station_summary(star, decimals, partials), months),
            "hourly": hourly,
            "seasonal": seasonal,
        }
    )
