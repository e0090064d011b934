"""The silver quality gate: seven checks, one scan of the fact."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airstrata.config import GateConfig
from airstrata.operators.marts import Star
from airstrata.session import materialize

# fixed value: columns whose share of NULLs is checked
CRITICAL = [
    "aqi",
    "pm25",
    "pm10",
    "measured_at",
    "date_key",
    "city_key",
    "station_key",
    "time_key",
]


class QualityGateError(RuntimeError):
    """Raised after logging when at least one check failed."""

    def __init__(self, failed: list[str]):
        super().__init__("silver data-quality gate failed: " + ", ".join(failed))
        self.failed = failed


PROFILE_KEYS = ["station_key", "city_key", "no_time_row"]
_ADDED = ["n", *[f"null_{c}" for c in CRITICAL], "out_of_range", "bad_source"]


def _oldest(config: GateConfig, as_of) -> Column:
    now = F.lit(as_of).cast("timestamp_ntz")
    return now - F.expr(f"INTERVAL {int(config.freshness_hours)} HOURS")


def profile(star: Star, config: GateConfig = GateConfig(), as_of=None) -> DataFrame:
    """All counters of the gate, in one scan of the fact.

    The counters are kept per station, city and whether the calendar or the
    hours lack the row's key. Those two dimensions are fixed and small, and are
    joined while scanning; stations and cities are joined to the counted rows.
    """
    aqi = F.col("aqi")
    dates = star.dates.select(F.col("date_key").alias("_date"))
    times = star.times.select(F.col("time_key").alias("_time"))
    return (
        star.fact.join(dates, F.col("date_key") == F.col("_date"), "left")
        .join(times, F.col("time_key") == F.col("_time"), "left")
        .withColumn("no_time_row", F.col("_date").isNull() | F.col("_time").isNull())
        .groupBy(*PROFILE_KEYS)
        .agg(
            F.count("*").alias("n"),
            *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in CRITICAL],
            F.count_if((aqi < config.aqi_min) | (aqi > config.aqi_max)).alias("out_of_range"),
            F.count_if(~F.col("source").isin(*config.sources)).alias("bad_source"),
            F.count_if(F.col("ingested_at") >= _oldest(config, as_of)).alias("fresh"),
        )
    )


_STATE = "control_state/gate_profile"


def advance_profile(store, star: Star, batch: int, config: GateConfig) -> None:
    """Fold the counters of one batch into those of the batches before it.

    ``star`` holds the batch's fact rows. The state is one version per batch.
    """
    counted = profile(star, config).drop("fresh")
    before = store.current(_STATE, before=batch)
    if before is not None:
        both = before.unionByName(counted)
        counted = both.groupBy(*PROFILE_KEYS).agg(*[F.sum(c).alias(c) for c in _ADDED])
    store.replace(_STATE, counted, batch)
    store.expire(_STATE, batch - 1)


def stored_profile(store, star: Star, upto: int, config: GateConfig, as_of) -> DataFrame:
    """Counters of all batches without scanning the fact again.

    Only freshness depends on the time of the check: its filter reaches the
    scan, which skips the files of older loads.
    """
    merged = store.current(_STATE, before=upto + 1)
    recent = star.fact.filter(F.col("ingested_at") >= _oldest(config, as_of))
    fresh = recent.groupBy("station_key", "city_key").agg(F.count("*").alias("fresh"))
    return merged.unionByName(
        fresh.withColumn("no_time_row", F.lit(False)), allowMissingColumns=True
    )


def gate_counters(
    star: Star,
    reference: DataFrame,
    config: GateConfig = GateConfig(),
    as_of=None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """One row with the number each check decides on."""
    counted = profile(star, config, as_of) if counted is None else counted
    counted = materialize(counted, "gate-profile")
    stations = star.stations.select(F.col("station_key").alias("_station"))
    cities = star.cities.select(F.col("city_key").alias("_city"))
    orphan = F.col("no_time_row") | F.col("_station").isNull() | F.col("_city").isNull()
    totals = (
        counted.join(stations, F.col("station_key") == F.col("_station"), "left")
        .join(cities, F.col("city_key") == F.col("_city"), "left")
        .agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in [*_ADDED, "fresh"]],
            F.coalesce(F.sum(F.when(orphan, F.col("n"))), F.lit(0)).alias("orphans"),
        )
    )
    present = star.cities.join(counted.select("city_key"), "city_key", "left_semi")
    absent = reference.join(present.select("city_slug"), "city_slug", "left_anti")
    counters = totals.unionByName(
        absent.agg(F.count("*").alias("missing_cities")), allowMissingColumns=True
    ).agg(*[F.sum(c).alias(c) for c in [*totals.columns, "missing_cities"]])
    worst = F.greatest(*[F.col(f"null_{c}") for c in CRITICAL])
    return counters.select(
        F.col("n").alias("n_rows"),
        (worst / F.greatest(F.col("n"), F.lit(1)) * 100).alias("null_pct"),
        "out_of_range",
        "missing_cities",
        "bad_source",
        "fresh",
        "orphans",
    )


def _number_text(value: Column) -> Column:
    """A double as text without a trailing '.0'."""
    return F.regexp_replace(value.cast("string"), r"\.0$", "")


def gate_results(
    star: Star,
    reference: DataFrame,
    config: GateConfig = GateConfig(),
    as_of=None,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Seven rows: check_name, passed, detail.

    ``counted`` is a profile made earlier; without it the fact is scanned.
    """
    text = lambda name: F.col(name).cast("string")
    pct = _number_text(F.round("null_pct", 2))

    def check(name: str, passed: Column, good: Column, bad: Column) -> Column:
        return F.struct(
            F.lit(name).alias("check_name"),
            passed.alias("passed"),
            F.when(passed, good).otherwise(bad).alias("detail"),
        )

    rows = F.concat(F.lit("rows="), text("n_rows"))
    nulls = F.concat(F.lit("worst null%="), pct)
    # fixed values: names and detail texts of the checks
    checks = [
        check(
            "row_count",
            F.col("n_rows") >= config.min_rows,
            rows,
            F.concat(rows, F.lit(f" (min {config.min_rows})")),
        ),
        check(
            "null_pct",
            F.col("null_pct") <= config.max_null_pct,
            nulls,
            F.concat(nulls, F.lit(f" (max {config.max_null_pct:g}%)")),
        ),
        check(
            "aqi_range",
            F.col("out_of_range") == 0,
            F.lit("violations=0"),
            F.concat(F.lit("violations="), text("out_of_range")),
        ),
        check(
            "city_coverage",
            F.col("missing_cities") == 0,
            F.lit("all reference cities present"),
            F.concat(F.lit("missing="), text("missing_cities")),
        ),
        check(
            "source_validity",
            F.col("bad_source") == 0,
            F.lit("invalid=0"),
            F.concat(F.lit("invalid="), text("bad_source")),
        ),
        check(
            "freshness",
            F.col("fresh") > 0,
            F.concat(F.lit("fresh rows="), text("fresh")),
            F.lit(f"no rows loaded within {config.freshness_hours}h"),
        ),
        check(
            "fk_integrity",
            F.col("orphans") == 0,
            F.lit("orphan rows=0"),
            F.concat(F.lit("orphan fact rows="), text("orphans")),
        ),
    ]
    counters = gate_counters(star, reference, config, as_of, counted)
    return counters.select(F.inline(F.array(*checks)))


def run_gate(
    star: Star,
    reference: DataFrame,
    store,
    version: int,
    load_ts,
    config: GateConfig = GateConfig(),
    counted: DataFrame | None = None,
) -> DataFrame:
    """Log all seven results, then raise if a check failed that ``config`` stops on."""
    results = gate_results(star, reference, config, load_ts, counted).select(
        F.lit(f"run-{version}").alias("run_id"),
        "check_name",
        "passed",
        "detail",
        F.lit(load_ts).cast("timestamp_ntz").alias("checked_at"),
    )
    logged = store.append("control/dq_results", results, version)
    failing = logged.filter(~F.col("passed"))
    if config.stop_on is not None:
        failing = failing.filter(F.col("check_name").isin(*config.stop_on))
    failed = [r["check_name"] for r in failing.collect()]
    if failed:
        raise QualityGateError(sorted(failed))
    return logged
