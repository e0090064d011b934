"""Explicit schemas. Nothing in this package infers a schema from data."""

from __future__ import annotations

# fixed values: the columns of the text feed, by position
CSV_COLUMNS = [
    "station_id",
    "aqi_index",
    "location",
    "station_name",
    "url",
    "dominant_pollutant",
    "co",
    "dew",
    "humidity",
    "no2",
    "o3",
    "pressure",
    "pm10",
    "pm25",
    "so2",
    "temperature",
    "wind",
    "data_time_s",
    "data_time_tz",
    "status",
    "alert_level",
]
HISTORY_CSV = ", ".join(f"{c} string" for c in CSV_COLUMNS)

# fixed values: column names of the conformed and stored tables, to the end of the file
READINGS = [
    "pm25",
    "pm10",
    "co",
    "no2",
    "o3",
    "so2",
    "humidity",
    "temperature",
    "pressure",
    "wind",
]

MEASUREMENT_COLUMNS = [
    "waqi_idx",
    "station_name",
    "lat",
    "lon",
    "url",
    "city_slug",
    "source",
    "measured_at",
    "aqi",
    "dominant_pollutant",
    *READINGS,
    "ingested_at",
]

API_RAW = (
    "queried_city string, raw_payload variant, ingested_at timestamp_ntz, "
    "source_file string, reject_reason string"
)
CSV_RAW = (
    HISTORY_CSV + ", ingested_at timestamp_ntz, source_file string, raw_record string, record_shape string"
)

CITY_MAP = "source_city string, conformed_city string"
CITY_REFERENCE = "city_slug string, city_name string, region string, lat double, lon double"
LEDGER = "file_name string, layer string, loaded_at timestamp_ntz"
BATCH_LOG = "batch int, loaded_at timestamp_ntz"
RUN_REPORT = "step string, metric string, n_rows bigint"

CITY_COLUMNS = ["city_key", "city_slug", "city_name", "region", "lat", "lon"]
STATION_COLUMNS = [
    "station_key",
    "waqi_idx",
    "city_key",
    "station_name",
    "lat",
    "lon",
    "url",
    "source",
    "is_active",
    "first_seen",
    "last_seen",
    "loaded_at",
]
FACT_COLUMNS = [
    "date_key",
    "time_key",
    "city_key",
    "station_key",
    "measured_at",
    "aqi",
    "pollution_level",
    "dominant_pollutant",
    *READINGS,
    "source",
    "ingested_at",
]

_READING_TYPES = ", ".join(f"{c} double" for c in READINGS)

_AVERAGES = ", ".join(f"avg_{c} double" for c in ("aqi", "pm25", "pm10"))
_ALL_AVERAGES = f"{_AVERAGES}, avg_humidity double, avg_temperature double"
_PLACE = "queried_city string, city_name string, region string"
_RANGE = "max_aqi double, min_aqi double, record_count bigint"

# stored tables that are read back by name
TABLES = {
    "control/city_map": CITY_MAP,
    "control/city_reference": CITY_REFERENCE,
    "silver/dim_date": (
        "date_key int, full_date date, year int, month int, month_name string, "
        "day_of_month int, day_of_week int, day_name string, quarter int, week_of_year int, "
        "is_weekend boolean, season string"
    ),
    "silver/dim_time": "time_key int, hour int, minute int, time_of_day string",
    "silver/dim_city": (
        "city_key bigint, city_slug string, city_name string, region string, lat double, lon double"
    ),
    "silver/dim_station": (
        "station_key bigint, waqi_idx int, city_key bigint, station_name string, lat double, "
        "lon double, url string, source string, is_active boolean, first_seen timestamp_ntz, "
        "last_seen timestamp_ntz, loaded_at timestamp_ntz"
    ),
    "silver/fact_aqi": (
        "date_key int, time_key int, city_key bigint, station_key bigint, measured_at timestamp_ntz, "
        f"aqi double, pollution_level string, dominant_pollutant string, {_READING_TYPES}, "
        "source string, ingested_at timestamp_ntz"
    ),
    "control/loaded_files": LEDGER,
    "control/batch_log": BATCH_LOG,
    "control/run_report": RUN_REPORT,
    "gold/daily_summary": (
        f"{_PLACE}, date date, avg_aqi double, max_aqi double, min_aqi double, avg_pm25 double, "
        "avg_pm10 double, avg_humidity double, avg_temperature double, station_count bigint, "
        "record_count bigint, dominant_pollutant string, pollution_level string, "
        "aggregated_at timestamp_ntz"
    ),
    "gold/city_ranking": (
        f"{_PLACE}, year int, month int, {_AVERAGES}, {_RANGE}, days_good bigint, "
        "days_moderate bigint, days_sensitive bigint, days_unhealthy bigint, "
        "days_very_unhealthy bigint, days_hazardous bigint, dominant_pollutant string, "
        "pollution_level string, aqi_rank bigint, pm25_rank bigint, aggregated_at timestamp_ntz"
    ),
    "gold/station_summary": (
        f"waqi_idx int, station_name string, {_PLACE}, lat double, lon double, year int, month int, "
        f"{_ALL_AVERAGES}, {_RANGE}, dominant_pollutant string, pollution_level string, "
        "rank_in_city bigint, aggregated_at timestamp_ntz"
    ),
    "gold/hourly_pattern": (
        f"{_PLACE}, hour int, time_of_day string, {_AVERAGES}, record_count bigint, "
        "aggregated_at timestamp_ntz"
    ),
    "gold/seasonal_summary": (
        f"{_PLACE}, year int, season string, {_AVERAGES}, {_RANGE}, dominant_pollutant string, "
        "aggregated_at timestamp_ntz"
    ),
}

# tables stored in parts, of which a batch rewrites only those it touches
PARTITIONED = {
    "gold/daily_summary",
    "gold/station_summary",
    "gold/seasonal_summary",
    "gold_state/day",
    "gold_state/station_day",
    "gold_state/station_month",
    "gold_state/monthly",
    "silver/dim_station",
}
