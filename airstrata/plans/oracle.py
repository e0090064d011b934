"""The registered queries as plain SQL over the given tables.

The SQL states results from the table columns directly: it neither builds nor
reads JSON or CSV texts, so it checks those steps independently.
"""

from __future__ import annotations

from airstrata.sources.given import SPINE


# fixed values: upper bound of each level, written out anew to check the library's own
_LEVELS = {
    50: "Good",
    100: "Moderate",
    150: "Unhealthy for Sensitive Groups",
    200: "Unhealthy",
    300: "Very Unhealthy",
}
_ALERTS = {50: "good", 100: "moderate", 150: "unhealthy_sensitive", 200: "unhealthy", 300: "very_unhealthy"}
LEVEL_LABELS = [*_LEVELS.values(), "Hazardous"]


def _level(value: str, labels: dict[int, str] = _LEVELS, last: str = "Hazardous") -> str:
    cases = " ".join(f"WHEN {value} <= {bound} THEN '{label}'" for bound, label in labels.items())
    return f"CASE {cases} ELSE '{last}' END"


def _avg(value: str) -> str:
    """The exact average of decimals; a plain one where a value is no finite number."""
    finite = f"{value} IS NULL OR isfinite({value})"
    exact = f"sum(CASE WHEN isfinite({value}) THEN CAST(CAST({value} AS VARCHAR) AS DECIMAL(28, 10)) END)"
    return (
        f"CASE WHEN count({value}) = 0 THEN NULL WHEN bool_and({finite}) "
        f"THEN CAST({exact} AS DOUBLE) / count({value}) ELSE avg({value}) END"
    )


def _day_avg(value: str) -> str:
    """The average of the daily averages of a month, added from the smallest up."""
    return f"CASE WHEN count({value}) > 0 THEN sum({value} ORDER BY {value}) / count({value}) END"


def _odd(first: int, value: str, kind: str) -> str:
    """Unusual numbers for the customers in four bands of the balance."""
    found = ["'NaN'", "'Infinity'", "'1e15'", "CAST(round(o_totalprice / 30000, 7) AS VARCHAR)"]
    cases = " ".join(
        f"WHEN c_acctbal >= {first + 30 * i} AND c_acctbal < {first + 30 * i + 30} THEN CAST({v} AS {kind})"
        for i, v in enumerate(found)
    )
    return f"CASE {cases} ELSE {value} END"


def _with(*steps: str) -> str:
    return "WITH " + ", ".join(steps) + " "


CITY = """city AS (
  SELECT row_number() OVER (ORDER BY lower(replace(n_name, '_', '-'))) AS city_key,
         lower(replace(n_name, '_', '-')) AS city_slug, n_name AS city_name, r_name AS region,
         n_nationkey, n_regionkey
  FROM nation JOIN region ON n_regionkey = r_regionkey)"""

FEEDS = f"""api AS (
  SELECT CAST(user_id AS INT) AS waqi_idx, c_name AS station_name,
         CAST(n_nationkey AS DOUBLE) AS lat, CAST(n_regionkey AS DOUBLE) AS lon,
         'station/' || user_id AS url, lower(replace(n_name, '_', '-')) AS city_slug,
         'api' AS source, date_trunc('hour', ts) AS measured_at, ts AS exact_at, value AS aqi,
         CASE WHEN event_type <> 'error' THEN event_type END AS dominant_pollutant,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k, ts AS ingested_at,
         event_type, event_id
  FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey),
csv AS (
  SELECT CAST(o_custkey AS INT) AS waqi_idx, c_name AS station_name,
         CAST(NULL AS DOUBLE) AS lat, CAST(NULL AS DOUBLE) AS lon,
         'station/' || o_custkey AS url,
         CASE WHEN c_acctbal BETWEEN -900 AND -700 THEN 'nowhere'
              ELSE lower(replace(n_name, '_', '-')) END AS city_slug,
         'kaggle' AS source,
         CASE WHEN c_acctbal BETWEEN -700 AND -500 THEN NULL ELSE o_orderdate END AS measured_at,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
              THEN {_odd(9700, "round(o_totalprice / 1000, 5)", "DOUBLE")} END AS aqi,
         CASE WHEN o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW')
              THEN o_orderpriority END AS dominant_pollutant,
         CASE WHEN o_orderstatus <> 'P'
              THEN {_odd(9850, "floor(o_totalprice / 5000)", "DOUBLE")} END AS pm25,
         o_orderdate AS ingested_at
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  WHERE c_acctbal >= -900)"""

_NO_READINGS = ", ".join(
    f"CAST(NULL AS DOUBLE) AS {c}" for c in ("co", "no2", "o3", "so2", "pressure", "wind")
)
_API_ROWS = f"""SELECT waqi_idx, station_name, lat, lon, url, city_slug, source, measured_at, aqi,
  dominant_pollutant, k AS pm25, round(k * 1.6e0, 5) AS pm10, k * 0.5e0 AS humidity,
  k * 0.25e0 AS temperature, {_NO_READINGS}, ingested_at FROM api"""
_CSV_ROWS = f"""SELECT waqi_idx, station_name, lat, lon, url, city_slug, source, measured_at, aqi,
  dominant_pollutant, pm25, CAST(NULL AS DOUBLE) AS pm10, CAST(NULL AS DOUBLE) AS humidity,
  CAST(NULL AS DOUBLE) AS temperature, {_NO_READINGS}, ingested_at FROM csv"""

MEASUREMENT = f"m AS ({_API_ROWS} UNION ALL {_CSV_ROWS})"


def _best(rows: str) -> str:
    return f"""SELECT waqi_idx, city_key, station_name, x.lat, x.lon, url, source, first_seen, last_seen
  FROM (SELECT r.*, city_key,
          min(measured_at) OVER (PARTITION BY waqi_idx, city_key) AS first_seen,
          max(measured_at) OVER (PARTITION BY waqi_idx, city_key) AS last_seen,
          row_number() OVER (PARTITION BY waqi_idx, city_key ORDER BY
            CASE source WHEN 'api' THEN 1 ELSE 2 END, measured_at DESC NULLS FIRST,
            station_name DESC, r.lat DESC NULLS LAST, r.lon DESC NULLS LAST, url DESC) AS rn
        FROM {rows} r JOIN city USING (city_slug)) x
  WHERE rn = 1"""


STATION = f"""station AS (
  SELECT row_number() OVER (ORDER BY waqi_idx, city_key) AS station_key, * FROM ({_best("m")}))"""

FACT = f"""fact AS (
  SELECT CAST(strftime(measured_at, '%Y%m%d') AS INT) AS date_key,
         CAST(hour(measured_at) * 100 AS INT) AS time_key, CAST(c.city_key AS BIGINT) AS city_key,
         CAST(s.station_key AS BIGINT) AS station_key, measured_at, aqi,
         {_level("aqi")} AS pollution_level, dominant_pollutant, pm25, pm10, co, no2, o3, so2,
         humidity, temperature, pressure, wind, m.source, ingested_at,
         city_name, region, m.city_slug, CAST(measured_at AS DATE) AS full_date,
         CAST(year(measured_at) AS INT) AS year, CAST(month(measured_at) AS INT) AS month,
         CASE WHEN month(measured_at) BETWEEN 5 AND 10 THEN 'Rainy' ELSE 'Dry' END AS season,
         CAST(hour(measured_at) AS INT) AS hour,
         CASE WHEN hour(measured_at) BETWEEN 5 AND 11 THEN 'Morning'
              WHEN hour(measured_at) BETWEEN 12 AND 17 THEN 'Afternoon'
              WHEN hour(measured_at) BETWEEN 18 AND 22 THEN 'Evening' ELSE 'Night' END AS time_of_day
  FROM m JOIN city c USING (city_slug) JOIN station s USING (waqi_idx, city_key)
  WHERE measured_at IS NOT NULL AND minute(measured_at) = 0
    AND CAST(measured_at AS DATE) BETWEEN DATE '{SPINE[0]}' AND DATE '{SPINE[1]}')"""

SILVER = (CITY, FEEDS, MEASUREMENT, STATION, FACT)


def _mode(table: str, keys: str, label: str = "dominant_pollutant") -> str:
    """Most frequent label per group; lowest label on a tie."""
    return f"""SELECT {keys}, {label} FROM (
      SELECT {keys}, {label}, row_number() OVER (
        PARTITION BY {keys} ORDER BY count(*) DESC, {label}) AS rn
      FROM {table} WHERE {label} IS NOT NULL GROUP BY {keys}, {label}) WHERE rn = 1"""


def _mart(keys: str, columns: str, label: bool = True) -> str:
    grouped = f"SELECT {keys}, {columns} FROM fact GROUP BY {keys}"
    if not label:
        return grouped
    return f"SELECT g.*, dominant_pollutant FROM ({grouped}) g LEFT JOIN ({_mode('fact', keys)}) USING ({keys})"


_AVGS5 = ", ".join(
    f"{_avg(c)} AS avg_{c}" for c in ("aqi", "pm25", "pm10", "humidity", "temperature")
)
_AVGS3 = ", ".join(f"{_avg(c)} AS avg_{c}" for c in ("aqi", "pm25", "pm10"))
_RANGE = "max(aqi) AS max_aqi, min(aqi) AS min_aqi, count(*) AS record_count"

_DAY_KEYS = "city_slug, city_name, region, full_date"
DAILY = f"""daily AS ({_mart(
    _DAY_KEYS,
    f"{_AVGS5}, {_RANGE}, count(DISTINCT station_key) AS station_count, "
    f"{_level('max(aqi)')} AS pollution_level",
)})"""

_MONTH = "city_slug, city_name, region, year, month"
_DAY_NAMES = ["good", "moderate", "sensitive", "unhealthy", "very_unhealthy", "hazardous"]
_DAYS = ", ".join(
    f"count(*) FILTER (pollution_level = '{label}') AS days_{name}"
    for name, label in zip(_DAY_NAMES, LEVEL_LABELS)
)
_MONTH_AVGS = ", ".join(f"{_day_avg(f'avg_{c}')} AS avg_{c}" for c in ("aqi", "pm25", "pm10"))
RANKING = f"""dated AS (
  SELECT *, CAST(year(full_date) AS INT) AS year, CAST(month(full_date) AS INT) AS month FROM daily),
month_rows AS (
  SELECT {_MONTH}, {_MONTH_AVGS}, max(max_aqi) AS max_aqi, min(min_aqi) AS min_aqi,
         count(*) AS record_count, {_DAYS}
  FROM dated GROUP BY {_MONTH}),
ranking AS (
  SELECT r.*, dominant_pollutant, {_level("avg_aqi")} AS pollution_level,
         dense_rank() OVER (ORDER BY avg_aqi DESC NULLS FIRST) AS aqi_rank,
         dense_rank() OVER (ORDER BY avg_pm25 DESC NULLS FIRST) AS pm25_rank
  FROM month_rows r LEFT JOIN ({_mode("dated", _MONTH)}) USING ({_MONTH}))"""

_STATION_MONTH = "station_key, city_slug, city_name, region, year, month"
_HOUR = "city_slug, city_name, region, hour, time_of_day"
_SEASON = "city_slug, city_name, region, year, season"

MART_SQL = {
    "daily_summary": _with(*SILVER, DAILY)
    + """SELECT city_slug AS queried_city, full_date AS date, * EXCLUDE (city_slug, full_date)
  FROM daily""",
    "city_ranking": _with(*SILVER, DAILY, RANKING)
    + "SELECT city_slug AS queried_city, * EXCLUDE (city_slug) FROM ranking",
    "station_summary": _with(*SILVER)
    + f"""SELECT waqi_idx, station_name, city_slug AS queried_city, city_name, region,
    s.lat, s.lon, g.* EXCLUDE (station_key, city_slug, city_name, region),
    {_level("avg_aqi")} AS pollution_level,
    dense_rank() OVER (PARTITION BY city_slug, year, month
      ORDER BY avg_aqi DESC NULLS FIRST) AS rank_in_city
  FROM ({_mart(_STATION_MONTH, f"{_AVGS5}, {_RANGE}")}) g JOIN station s USING (station_key)""",
    "hourly_pattern": _with(*SILVER)
    + f"""SELECT city_slug AS queried_city, * EXCLUDE (city_slug)
  FROM ({_mart(_HOUR, f"{_AVGS3}, count(*) AS record_count", label=False)})""",
    "seasonal_summary": _with(*SILVER)
    + f"""SELECT city_slug AS queried_city, * EXCLUDE (city_slug)
  FROM ({_mart(_SEASON, f"{_AVGS3}, {_RANGE}")})""",
}


def _sizes(fact: str = "fact") -> str:
    sizes = {
        "daily_summary": f"SELECT DISTINCT {_DAY_KEYS} FROM {fact}",
        "city_ranking": f"SELECT DISTINCT {_MONTH} FROM {fact}",
        "station_summary": f"SELECT DISTINCT station_key, year, month FROM {fact}",
        "hourly_pattern": f"SELECT DISTINCT {_HOUR} FROM {fact}",
        "seasonal_summary": f"SELECT DISTINCT {_SEASON} FROM {fact}",
    }
    return " UNION ALL ".join(
        f"SELECT '{name}' AS mart, count(*) AS n_rows FROM ({sql})" for name, sql in sizes.items()
    )


# ---- quality gate ------------------------------------------------------------


def _check(name: str, passed: str, good: str, bad: str) -> str:
    return f"""SELECT '{name}' AS check_name, {passed} AS passed,
    CASE WHEN {passed} THEN {good} ELSE {bad} END AS detail FROM counters"""


def _pct(value: str) -> str:
    return f"regexp_replace(CAST(round({value}, 2) AS VARCHAR), '\\.0$', '')"


def _worst(columns: list[str]) -> str:
    return "greatest(" + ", ".join(f"count(*) FILTER ({c} IS NULL)" for c in columns) + ")"


CRITICAL = ["aqi", "pm25", "pm10", "measured_at", "date_key", "city_key", "station_key", "time_key"]

COUNTERS = f"""counters AS (
  SELECT count(*) AS n, {_worst(CRITICAL)} / greatest(count(*), 1) * 100 AS null_pct,
    count(*) FILTER (aqi < 0 OR aqi > 500) AS out_of_range,
    (SELECT count(*) FROM city WHERE city_slug NOT IN (SELECT city_slug FROM fact)) AS missing,
    count(*) FILTER (source NOT IN ('kaggle', 'api')) AS bad_source,
    count(*) FILTER (ingested_at >=
      (SELECT max(ingested_at) FROM fact) - INTERVAL 48 HOUR) AS fresh,
    0 AS orphans
  FROM fact)"""

GATE = {
    "row_count": _check("row_count", "n >= 10", "'rows=' || n", "'rows=' || n || ' (min 10)'"),
    "null_pct": _check(
        "null_pct",
        "null_pct <= 5",
        f"'worst null%=' || {_pct('null_pct')}",
        f"'worst null%=' || {_pct('null_pct')} || ' (max 5%)'",
    ),
    "aqi_range": _check(
        "aqi_range", "out_of_range = 0", "'violations=0'", "'violations=' || out_of_range"
    ),
    "city_coverage": _check(
        "city_coverage", "missing = 0", "'all reference cities present'", "'missing=' || missing"
    ),
    "source_validity": _check(
        "source_validity", "bad_source = 0", "'invalid=0'", "'invalid=' || bad_source"
    ),
    "freshness": _check(
        "freshness", "fresh > 0", "'fresh rows=' || fresh", "'no rows loaded within 48h'"
    ),
    "fk_integrity": _check(
        "fk_integrity", "orphans = 0", "'orphan rows=0'", "'orphan fact rows=' || orphans"
    ),
}


def _gate(check: str, **changes: str) -> str:
    """One check with some counters stated differently."""
    columns = ", ".join(f"({sql}) AS {name}" for name, sql in changes.items())
    counters = COUNTERS
    if changes:
        counters = COUNTERS.replace("counters AS", "plain AS", 1) + (
            f", counters AS (SELECT * REPLACE ({columns}) FROM plain)"
        )
    return _with(*SILVER, counters) + GATE[check]


# ---- upserts over two batches ------------------------------------------------

_BATCHES = """m1 AS (SELECT * FROM m WHERE ingested_at <
    CASE WHEN source = 'api' THEN TIMESTAMP '2024-01-16' ELSE TIMESTAMP '1998-01-01' END),
m2 AS (SELECT * FROM m WHERE ingested_at >=
    CASE WHEN source = 'api' THEN TIMESTAMP '2024-01-16' ELSE TIMESTAMP '1998-01-01' END)"""

STATION_MERGE = (
    _with(CITY, FEEDS, MEASUREMENT, _BATCHES, f"s1 AS ({_best('m1')})", f"s2 AS ({_best('m2')})")
    + """SELECT CAST(station_key AS BIGINT) AS station_key, waqi_idx, CAST(city_key AS BIGINT) AS city_key,
    station_name, lat, lon, url, source, TRUE AS is_active, first_seen, last_seen
  FROM (
    SELECT row_number() OVER (ORDER BY waqi_idx, city_key) AS station_key, s1.waqi_idx, s1.city_key,
      coalesce(s2.station_name, s1.station_name) AS station_name,
      coalesce(s2.lat, s1.lat) AS lat, coalesce(s2.lon, s1.lon) AS lon,
      coalesce(s2.url, s1.url) AS url, coalesce(s2.source, s1.source) AS source,
      s1.first_seen, coalesce(s2.last_seen, s1.last_seen) AS last_seen
    FROM s1 LEFT JOIN s2 USING (waqi_idx, city_key)
    UNION ALL
    SELECT (SELECT count(*) FROM s1) + row_number() OVER (ORDER BY waqi_idx, city_key),
      waqi_idx, city_key, station_name, lat, lon, url, source, first_seen, last_seen
    FROM s2 ANTI JOIN s1 USING (waqi_idx, city_key))"""
)

_ODD_PRICES = """SELECT l_orderkey, l_linenumber, l_suppkey, l_extendedprice, CASE WHEN l_linenumber = 7 THEN NULL
    WHEN l_linenumber = 6 THEN 'NaN'::DOUBLE ELSE l_extendedprice END AS price FROM lineitem"""

_API_DOC = """SELECT city_slug AS queried_city, waqi_idx AS idx, aqi,
    strftime(measured_at, '%Y-%m-%dT%H:%M:%SZ') AS iso, TRUE AS has_file FROM api"""

# the rows of all tables after one and after both of two loads
_EARLY = "ingested_at < CASE WHEN source = 'api' THEN TIMESTAMP '2024-01-16' ELSE TIMESTAMP '1998-01-01' END"


def _tables(batch: int, fact: str, rows: str) -> str:
    return f"""SELECT CAST({batch} AS INT) AS batch, mart AS name, n_rows FROM ({_sizes(fact)})
  UNION ALL SELECT {batch}, 'fact_aqi', count(*) FROM {fact}
  UNION ALL SELECT {batch}, 'dim_station', count(DISTINCT (waqi_idx, city_slug))
    FROM {rows} WHERE city_slug IN (SELECT city_slug FROM city)"""


def _paths() -> str:
    """path, key, index and whether it is a number, of the body of a document."""
    keys = [("aqi", 1), ("idx", 1), ("dominentpol", 0), ("time", 0), ("time.iso", 0), ("city", 0), ("city.name", 0)]
    keys += [("city.url", 0), ("city.geo", 0), ("iaqi", 0), ("_queried_city", 0)]
    keys += [x for r in ("pm25", "pm10", "h", "t") for x in ((f"iaqi.{r}", 0), (f"iaqi.{r}.v", 1))]
    rows = [f"('{k}', '{k.split('.')[-1]}', NULL, {n})" for k, n in keys]
    rows += [f"('city.geo[{i}]', NULL, {i}, 1)" for i in (0, 1)]
    return "(VALUES " + ", ".join(rows) + ") places(place, key, index, number)"


ORACLE_SQL = {
    "aqi_category": f"""SELECT {_level("aqi")} AS level, count(*) AS n_rows, min(aqi) AS lowest,
    max(aqi) AS highest
  FROM (SELECT CASE WHEN l_returnflag <> 'N' THEN least(l_extendedprice / 200, 600) END AS aqi
        FROM lineitem) GROUP BY 1""",
    "json_ingest": _with(FEEDS) + _API_DOC,
    "json_outer_array": _with(FEEDS) + _API_DOC,
    "json_ingest_quarantine": _with(FEEDS)
    + """SELECT CASE WHEN aqi < 5 THEN 'malformed_json'
      WHEN aqi < 10 AND event_type <> 'view' THEN 'malformed_json'
      WHEN aqi < 10 THEN 'accepted'
      WHEN event_type = 'error' THEN 'status_not_ok'
      WHEN event_type = 'signup' THEN 'no_queried_city'
      ELSE 'accepted' END AS outcome, count(*) AS n_docs FROM api GROUP BY 1""",
    "json_null_strip": """SELECT event_type, count(*) AS n_docs,
    count(*) FILTER (event_type <> 'error') AS n_present FROM events GROUP BY 1""",
    "envelope_gate": _with(FEEDS)
    + """SELECT city_slug AS queried_city, count(*) AS n_docs FROM api
  WHERE event_type <> 'error' GROUP BY 1""",
    "csv_ingest": f"""SELECT
    CASE WHEN c_acctbal >= -900 THEN CAST(o_custkey AS VARCHAR) END AS station_id,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED'
         THEN {_odd(9700, "CAST(round(o_totalprice / 1000, 5) AS VARCHAR)", "VARCHAR")} END AS aqi_index,
    CASE WHEN c_acctbal BETWEEN -900 AND -700 THEN 'Nowhere' ELSE n_name END AS location,
    c_name AS station_name, 'station/' || o_custkey AS url,
    CASE WHEN o_orderpriority = '5-LOW' THEN 'aqi'
         WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_orderpriority END AS dominant_pollutant,
    CASE WHEN o_orderstatus <> 'P'
         THEN {_odd(9850, "CAST(CAST(floor(o_totalprice / 5000) AS INT) AS VARCHAR)", "VARCHAR")} END AS pm25,
    CASE WHEN c_acctbal BETWEEN -700 AND -500 THEN 'garbage'
         ELSE strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') END AS data_time_s,
    'UTC' AS data_time_tz, 'ok' AS status,
    {_level("o_totalprice / 1000", _ALERTS, "hazardous")} AS alert_level,
    {", ".join(f"CAST(NULL AS VARCHAR) AS {c}" for c in (
        "co", "dew", "humidity", "no2", "o3", "pressure", "pm10", "so2", "temperature", "wind"))}
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey""",
    "csv_null_tokens": """SELECT o_orderpriority AS status, count(*) AS n_rows,
    count(*) FILTER (o_orderpriority <> '5-LOW') AS n_null_co,
    count(*) FILTER (o_orderstatus = 'F') AS n_null_wind FROM orders GROUP BY 1""",
    "csv_arity": f"""SELECT
    CASE WHEN o_orderstatus <> 'F' THEN {_level("o_totalprice / 1000", _ALERTS, "hazardous")} END
      AS alert_level,
    CASE WHEN o_orderstatus <> 'F' THEN 'ok' END AS status,
    CASE o_orderstatus WHEN 'F' THEN 'padded' WHEN 'P' THEN 'cut' ELSE 'whole' END AS shape,
    count(*) AS n_rows, count(*) AS n_named,
    CAST(sum(CASE o_orderstatus WHEN 'F' THEN 18 WHEN 'P' THEN 22 END) AS BIGINT) AS n_commas
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
  GROUP BY 1, 2, 3""",
    "file_ledger": """SELECT CAST(load AS INT) AS load, count(ts) AS n_docs, count(ts) AS n_good
  FROM (VALUES (1), (2), (3)) loads(load)
  LEFT JOIN events ON load = CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 1 ELSE 2 END GROUP BY 1""",
    "city_conform": """SELECT location, CASE WHEN location LIKE ' %' THEN lower(trim(location))
      ELSE lower(replace(location, '_', '-')) END AS city_slug, count(*) AS n_rows
  FROM (SELECT CASE WHEN o_orderstatus = 'O' THEN ' ' || n_name ELSE n_name END AS location
        FROM orders JOIN customer ON o_custkey = c_custkey
        JOIN nation ON c_nationkey = n_nationkey) GROUP BY 1, 2""",
    "conform_api": _with(FEEDS) + _API_ROWS,
    "conform_csv": _with(FEEDS) + _CSV_ROWS,
    "conform_union": _with(FEEDS) + _API_ROWS + " UNION ALL " + _CSV_ROWS,
    "dim_date": """SELECT CAST(strftime(d, '%Y%m%d') AS INT) AS date_key, CAST(d AS DATE) AS full_date,
    CAST(year(d) AS INT) AS year, CAST(month(d) AS INT) AS month, strftime(d, '%b') AS month_name,
    CAST(day(d) AS INT) AS day_of_month, CAST(isodow(d) AS INT) AS day_of_week,
    strftime(d, '%a') AS day_name, CAST(quarter(d) AS INT) AS quarter,
    CAST(weekofyear(d) AS INT) AS week_of_year, isodow(d) IN (6, 7) AS is_weekend,
    CASE WHEN month(d) IN (11, 12, 1, 2, 3, 4) THEN 'Dry' ELSE 'Rainy' END AS season,
    coalesce(n, 0) AS n_orders
  FROM (SELECT unnest(generate_series(min(o_orderdate), max(o_orderdate), INTERVAL 1 DAY)) AS d
        FROM orders)
  LEFT JOIN (SELECT o_orderdate AS d, count(*) AS n FROM orders GROUP BY 1) USING (d)""",
    "dim_time": """SELECT CAST(h * 100 AS INT) AS time_key, CAST(h AS INT) AS hour,
    CAST(0 AS INT) AS minute,
    CASE WHEN h BETWEEN 5 AND 11 THEN 'Morning' WHEN h BETWEEN 12 AND 17 THEN 'Afternoon'
         WHEN h BETWEEN 18 AND 22 THEN 'Evening' ELSE 'Night' END AS time_of_day,
    coalesce(n, 0) AS n_events
  FROM (SELECT unnest(range(24)) AS h)
  LEFT JOIN (SELECT hour(ts) AS h, count(*) AS n FROM events GROUP BY 1) USING (h)""",
    "reject_counts": """SELECT * FROM (
    SELECT 'record' AS layer, 'station_not_numeric' AS reason, count(*) AS n_rows
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal < -900
    UNION ALL SELECT 'value', 'time_not_parsed', count(*)
    FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal BETWEEN -700 AND -500
    ) WHERE n_rows > 0""",
    "api_unread_values": """SELECT * FROM (
    SELECT 'pm25_not_numeric' AS reason, count(*) AS n_rows FROM events WHERE event_type = 'error'
    UNION ALL SELECT 'time_not_parsed', count(*) FROM events WHERE event_type = 'signup'
    ) WHERE n_rows > 0""",
    "run_report": _with(*SILVER)
    + """SELECT * FROM (
    SELECT 'conform' AS step, 'rows' AS metric, (SELECT count(*) FROM api) + (SELECT count(*) FROM orders) AS n_rows
    UNION ALL SELECT 'conform', 'station_not_numeric', count(*)
      FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_acctbal < -900
    UNION ALL SELECT 'fact', 'rows', count(*) FROM m
    UNION ALL SELECT 'fact', CASE WHEN measured_at IS NULL THEN 'no_timestamp' ELSE 'unknown_city' END, count(*)
      FROM m WHERE measured_at IS NULL OR city_slug NOT IN (SELECT city_slug FROM city) GROUP BY 2
    UNION ALL SELECT 'fact', 'kept', count(*) FROM fact) WHERE n_rows > 0""",
    "asof_star": _with(*SILVER, f"early AS (SELECT * FROM fact WHERE {_EARLY}), m1 AS (SELECT * FROM m WHERE {_EARLY})")
    + _tables(1, "early", "m1")
    + " UNION ALL "
    + _tables(2, "fact", "m"),
    "star_slice_sql": _with(*SILVER)
    + f"""SELECT fact.city_name, season, time_of_day, {_level("max(aqi)")} AS worst_level,
    count(*) AS n_rows, count(DISTINCT station.waqi_idx) AS n_stations
  FROM fact JOIN station USING (station_key) GROUP BY 1, 2, 3""",
    "nested_flatten": f"""WITH kinds AS (
    SELECT event_type = 'view' AS bare, count(*) AS n FROM events
    JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1)
  SELECT CASE WHEN bare THEN '$.' ELSE '$.data.' END || place AS path, key, CAST(index AS INT) AS index,
    n AS n_rows, n * number AS n_numbers
  FROM kinds, {_paths()}
  UNION ALL SELECT '$.' || k, k, NULL, n, 0 FROM kinds, (VALUES ('status'), ('data')) t(k) WHERE NOT bare""",
    "batch_run": _with(*SILVER)
    + """SELECT batch, 0 AS code, CASE batch WHEN 1 THEN (SELECT count(*) FROM fact) ELSE 0 END AS n_fact,
    (SELECT count(*) FROM (SELECT DISTINCT city_slug, full_date FROM fact)) AS n_daily
  FROM (SELECT unnest([1, 2])::INT AS batch)""",
    "dim_city_merge": _with(CITY)
    + """SELECT row_number() OVER (ORDER BY n_regionkey >= 3, city_slug) AS city_key,
    city_slug, city_name, region, CAST(n_nationkey AS DOUBLE) AS lat,
    CAST(n_regionkey AS DOUBLE) AS lon FROM city""",
    "dim_station_merge": STATION_MERGE,
    "station_best_row": _with(CITY, FEEDS, MEASUREMENT)
    + f"SELECT * REPLACE (CAST(city_key AS BIGINT) AS city_key) FROM ({_best('m')})",
    "surrogate_keys": """SELECT row_number() OVER (ORDER BY l_suppkey, l_partkey) AS pair_key, l_suppkey, l_partkey
  FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem)""",
    "global_dense_rank": f"""SELECT l_orderkey, l_linenumber, l_extendedprice,
    dense_rank() OVER (ORDER BY price DESC NULLS FIRST) AS price_rank FROM ({_ODD_PRICES})""",
    "rank_within_group": f"""SELECT l_orderkey, l_linenumber, l_suppkey,
    dense_rank() OVER (PARTITION BY l_suppkey ORDER BY price DESC NULLS FIRST) AS price_rank
  FROM ({_ODD_PRICES})""",
    "dim_time_minute": """SELECT CAST(h * 100 + m AS INT) AS time_key, CAST(h AS INT) AS hour,
    CAST(m AS INT) AS minute,
    CASE WHEN h BETWEEN 5 AND 11 THEN 'Morning' WHEN h BETWEEN 12 AND 17 THEN 'Afternoon'
         WHEN h BETWEEN 18 AND 22 THEN 'Evening' ELSE 'Night' END AS time_of_day,
    coalesce(n, 0) AS n_events
  FROM (SELECT unnest(range(24)) AS h) CROSS JOIN (SELECT unnest(range(60)) AS m)
  LEFT JOIN (SELECT hour(ts) AS h, minute(ts) AS m, count(*) AS n FROM events GROUP BY 1, 2) USING (h, m)""",
    "fact_dedup": _with(*SILVER)
    + """SELECT city_key, source, count(DISTINCT (station_key, measured_at)) AS n_rows,
    count(DISTINCT (station_key, measured_at)) AS n_readings FROM fact GROUP BY city_key, source""",
    "aqi_category_null_label": f"""SELECT CASE WHEN aqi IS NOT NULL THEN {_level("aqi")} END AS level,
    CASE WHEN aqi IS NULL THEN 'Unknown' ELSE {_level("aqi")} END AS named_level, count(*) AS n_rows
  FROM (SELECT CASE WHEN l_returnflag <> 'N' THEN least(l_extendedprice / 200, 600) END AS aqi
        FROM lineitem) GROUP BY 1, 2""",
    "fact_build": _with(*SILVER)
    + """SELECT date_key, time_key, city_key, station_key, measured_at, aqi, pollution_level,
    dominant_pollutant, pm25, pm10, co, no2, o3, so2, humidity, temperature, pressure, wind,
    source, ingested_at FROM fact""",
    "fact_minute_drop": _with(CITY, FEEDS)
    + """SELECT CASE WHEN moment IS NULL THEN 'no_timestamp'
      WHEN city_slug NOT IN (SELECT city_slug FROM city) THEN 'unknown_city'
      WHEN minute(moment) <> 0 THEN 'time_not_on_the_hour' ELSE 'kept' END AS outcome,
    count(*) AS n_rows
  FROM (SELECT exact_at AS moment, city_slug FROM api UNION ALL SELECT measured_at, city_slug FROM csv)
  GROUP BY 1""",
    **MART_SQL,
    "gold_all": _with(*SILVER) + _sizes(),
    "stream_run": _with(*SILVER) + _sizes(),
    "star_slice": _with(*SILVER)
    + f"""SELECT city_name, season, time_of_day, round({_avg("aqi")}, 1) AS avg_aqi
  FROM fact GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""",
    "ranking_coverage": _with(*SILVER)
    + """SELECT city_slug AS queried_city, count(DISTINCT (year, month)) AS n_rows
  FROM fact GROUP BY 1""",
    "dq_row_count": _gate("row_count"),
    "dq_null_pct": _gate(
        "null_pct", null_pct="SELECT count(*) FILTER (aqi IS NULL) / count(*) * 100 FROM fact"
    ),
    "dq_aqi_range": _gate(
        "aqi_range",
        out_of_range="SELECT count(*) FROM fact WHERE aqi * 2 - 100 < 0 OR aqi * 2 - 100 > 500",
    ),
    "dq_city_coverage": _gate(
        "city_coverage",
        missing="""SELECT count(*) FROM city
          WHERE region = 'ASIA' OR city_slug NOT IN (SELECT city_slug FROM fact)""",
    ),
    "dq_source_validity": _gate(
        "source_validity", bad_source="SELECT count(*) FROM fact WHERE aqi > 450"
    ),
    "dq_freshness": _gate("freshness"),
    "dq_fk_integrity": _gate(
        "fk_integrity",
        orphans="""SELECT count(*) FROM fact WHERE season = 'Rainy'
          OR station_key IN (SELECT station_key FROM station WHERE source <> 'api')""",
    ),
    "dq_gate": _with(*SILVER, COUNTERS) + " UNION ALL ".join(GATE.values()),
    "raw_peek": _with(FEEDS)
    + """SELECT city_slug AS queried_city, aqi, station_name AS station FROM api
  ORDER BY queried_city, station, aqi LIMIT 10""",
    "pollutant_unpivot": _with(FEEDS)
    + """SELECT city_slug AS queried_city, pollutant, count(*) AS n_values, min(v) AS lowest,
    max(v) AS highest
  FROM (SELECT city_slug, 'pm25' AS pollutant, k AS v FROM api
        UNION ALL SELECT city_slug, 'pm10', round(k * 1.6e0, 5) FROM api
        UNION ALL SELECT city_slug, 'h', k * 0.5e0 FROM api
        UNION ALL SELECT city_slug, 't', k * 0.25e0 FROM api) GROUP BY 1, 2""",
    "asof_count": _with(*SILVER)
    + """SELECT 'now' AS state, count(*) AS n_rows FROM fact UNION ALL
  SELECT 'then', count(*) FROM fact WHERE ingested_at <= TIMESTAMP '2024-01-16'""",
    "restore_before": _with(*SILVER)
    + """SELECT source, count(*) AS n_rows, max(ingested_at) AS newest FROM fact
  WHERE ingested_at < TIMESTAMP '2024-01-16' GROUP BY 1""",
    "layout_write": _with(*SILVER)
    + "SELECT city_key, date_key, count(*) AS n_rows, max(aqi) AS max_aqi FROM fact GROUP BY 1, 2",
    "gated_run": _with(*SILVER)
    + f"""SELECT 'default' AS run, CAST(1 AS INT) AS code,
    CASE WHEN count(*) FILTER (aqi > 500) > 0 THEN 'aqi_range,null_pct' ELSE 'null_pct' END
      AS failed, CAST(0 AS BIGINT) AS n_daily FROM fact
  UNION ALL SELECT 'relaxed', 0, '', count(*) FROM (SELECT DISTINCT {_DAY_KEYS} FROM fact)""",
    "stream_roots": """SELECT CASE WHEN ts < TIMESTAMP '2024-01-16' THEN 'early' ELSE 'late' END AS folder,
    count(*) AS n_docs, count(*) AS n_good
  FROM events JOIN customer ON user_id = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY 1""",
    "stream_ingest": """SELECT 'api' AS feed, count(*) AS n_rows FROM events
  UNION ALL SELECT 'history', count(*) FROM orders""",
    "stream_fact": _with(*SILVER)
    + "SELECT date_key, time_key, city_key, measured_at, aqi, pm10, source FROM fact",
    "stream_dim_station": _with(*SILVER)
    + """SELECT waqi_idx, CAST(city_key AS BIGINT) AS city_key, station_name, lat, lon, url
  FROM station""",
    "stream_daily_summary": MART_SQL["daily_summary"],
}
# however the batches are stored, the rows are the same
ORACLE_SQL["folded_fact"] = ORACLE_SQL["fact_build"]
