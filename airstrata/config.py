"""Settings and fixed values shared by all layers."""

from __future__ import annotations

from dataclasses import dataclass

# ---- fixed values: must equal the source system's for right results ----------
CITY_MAP = [
    ("Ha Noi", "ha-noi"),
    ("Hanoi", "ha-noi"),
    ("Ho Chi Minh City", "ho-chi-minh-city"),
    ("Ho Chi Minh", "ho-chi-minh-city"),
    ("Da Nang", "da-nang"),
    ("Gia Lai", "gia-lai"),
    ("Cao Bang", "cao-bang"),
]
CITY_REFERENCE = [
    ("ha-noi", "Ha Noi", "North", 21.0285, 105.8542),
    ("ho-chi-minh-city", "Ho Chi Minh City", "South", 10.8231, 106.6297),
    ("da-nang", "Da Nang", "Central", 16.0544, 108.2022),
    ("gia-lai", "Gia Lai", "Central Highlands", 13.9718, 108.0151),
    ("cao-bang", "Cao Bang", "North", 22.6657, 106.2579),
]
NULL_TOKENS = ["", "NULL", "null", "NA", "N/A"]
LEVEL_BOUNDS = [50, 100, 150, 200, 300]
LEVEL_LABELS = [
    "Good",
    "Moderate",
    "Unhealthy for Sensitive Groups",
    "Unhealthy",
    "Very Unhealthy",
    "Hazardous",
]
ALERT_LABELS = [
    "good",
    "moderate",
    "unhealthy_sensitive",
    "unhealthy",
    "very_unhealthy",
    "hazardous",
]
POLLUTANT_SENTINEL = "aqi"
API_SOURCE = "api"
CSV_SOURCE = "kaggle"
WET_MONTHS = (5, 10)
WET, DRY = "Rainy", "Dry"
HOUR_BANDS = [("Morning", 5, 11), ("Afternoon", 12, 17), ("Evening", 18, 22)]
OTHER_HOURS = "Night"
SPINE_START = "2019-01-01"
SPINE_END = "2030-12-31"
# ---- end of fixed values -----------------------------------------------------


@dataclass(frozen=True)
class GateConfig:
    """Thresholds of the silver quality gate.

    All checks are logged; ``stop_on`` names those whose failure stops a run, None for all.
    """

    min_rows: int = 10
    max_null_pct: float = 5.0
    aqi_min: float = 0.0
    aqi_max: float = 500.0
    sources: tuple[str, ...] = (CSV_SOURCE, API_SOURCE)
    freshness_hours: int = 48
    stop_on: tuple[str, ...] | None = None


@dataclass(frozen=True)
class RunConfig:
    """Settings of one medallion run.

    ``decimals`` is the number of decimals up to which readings are summed as decimals,
    so that averages come out bit-identical however the rows are partitioned; readings
    that have more, and all readings when it is None, are summed as doubles.
    ``order_free_stations`` makes stations the same in whatever order batches come.
    ``multi_line`` lets quoted CSV fields hold line breaks (a file is then read by one task);
    ``city_from_folder`` names a document without a city after its landing folder.
    ``keep_versions`` bounds the table versions a stream leaves behind; None keeps all.
    """

    gate: GateConfig = GateConfig()
    spine_start: str = SPINE_START
    spine_end: str = SPINE_END
    decimals: int | None = None
    keep_versions: int | None = None
    order_free_stations: bool = False
    multi_line: bool = False
    city_from_folder: bool = False
