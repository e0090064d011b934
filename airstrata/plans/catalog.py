"""Registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airstrata.config import GateConfig, RunConfig
from airstrata.functions.levels import aqi_category
from airstrata.operators import marts, quality, snapshots
from airstrata.operators.conform import (
    conform_api,
    conform_city,
    conform_csv,
    tagged,
    unread_api_values,
    unread_values,
)
from airstrata.operators.dimensions import (
    dim_date,
    dim_time,
    merge_city,
    merge_station,
    station_candidates,
)
from airstrata.operators.fact import build_fact, fact_outcomes
from airstrata.operators.ordering import dense_rank_desc, dense_rank_desc_within
from airstrata.operators.upsert import allocate_keys
from airstrata.plans import surface
from airstrata.plans.medallion import (
    FOLDABLE,
    as_of,
    finish,
    gold,
    load_bronze,
    load_silver,
    run_medallion,
    setup,
    star,
)
from airstrata.schemas import API_RAW, CSV_COLUMNS, TABLES
from airstrata.session import folder_state, materialize, scratch_path, scratch_scope
from airstrata.sources import documents, given, history
from airstrata.sources.store import Store
from airstrata.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]

# the two load batches of the upsert queries are split at these moments
EVENT_SPLIT = "2024-01-16"
ORDER_SPLIT = "1998-01-01"
LOAD_TS = datetime(2024, 1, 31)
# the feeds hold readings that are NaN, infinite or 1e15: the range check is logged, but stops no run
NOTHING_FAILS = GateConfig(
    max_null_pct=100.0,
    stop_on=("row_count", "null_pct", "city_coverage", "source_validity", "freshness", "fk_integrity"),
)
CONFIG = RunConfig(spine_start=given.SPINE[0], spine_end=given.SPINE[1], decimals=given.DECIMALS)

_STORES: dict[tuple, tuple[tuple, Store]] = {}


def new_store(spark: SparkSession, sf_dir: str, label: str) -> Store:
    """A store with control tables and generated dimensions."""
    store = Store(spark, scratch_path(spark, label))
    setup(store, CONFIG, given.city_map(spark, sf_dir), given.city_reference(spark, sf_dir))
    return store


def build_silver(spark: SparkSession, sf_dir: str) -> Store:
    store = new_store(spark, sf_dir, "silver")
    load_silver(store, given.measurements(spark, sf_dir), 1, LOAD_TS)
    return store


def _kept(spark: SparkSession, sf_dir: str, label: str, build: Callable[[SparkSession, str], Store]) -> Store:
    """The store that ``build`` makes of an input, kept until the input changes."""
    place = (spark.sparkContext.applicationId, label, sf_dir)
    state = folder_state(spark, sf_dir)
    if place not in _STORES or _STORES[place][0] != state:
        _STORES[place] = (state, build(spark, sf_dir))
    return _STORES[place][1]


def silver_store(spark: SparkSession, sf_dir: str) -> Store:
    """The stored silver layer of the given tables, built once per session and input."""
    return _kept(spark, sf_dir, "silver", build_silver)


def silver(spark: SparkSession, sf_dir: str) -> marts.Star:
    return star(silver_store(spark, sf_dir))


# ---- ingest ------------------------------------------------------------------


def _land_texts(spark: SparkSession, texts: DataFrame, per_file: int = 0) -> str:
    path = scratch_path(spark, "landing")
    writer = texts.select("value").write
    if per_file:
        writer = writer.option("maxRecordsPerFile", per_file)
    writer.text(path)
    return path


def _land_csv(spark: SparkSession, records: DataFrame) -> str:
    path = scratch_path(spark, "landing")
    records.write.option("header", True).csv(path)
    return path


def _doc_columns(raw: DataFrame) -> DataFrame:
    body = F.coalesce(
        F.try_variant_get("raw_payload", "$.data", "variant"), F.col("raw_payload")
    )
    return raw.select(
        "queried_city",
        F.try_variant_get(body, "$.idx", "int").alias("idx"),
        F.try_variant_get(body, "$.aqi", "double").alias("aqi"),
        F.try_variant_get(body, "$.time.iso", "string").alias("iso"),
        F.col("source_file").isNotNull().alias("has_file"),
    )


def json_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = _land_texts(spark, given.api_texts(spark, sf_dir))
    return _doc_columns(documents.ingest_api(spark, landing, LOAD_TS, False, "*.txt"))


def json_ingest_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut off texts, double keys, bad status and missing city, by column values."""
    text, aqi, kind = F.col("value"), F.col("aqi"), F.col("event_type")
    broken = (
        F.when(aqi < 5, F.expr("left(value, length(value) - 1)"))
        .when(aqi < 10, F.concat(F.lit('{"status":"ok",'), F.expr("substring(value, 2)")))
        .when(kind == "error", F.regexp_replace(text, '"status":"ok"', '"status":"error"'))
        .when(kind == "signup", F.regexp_replace(text, "_queried_city", "_other"))
        .otherwise(text)
    )
    texts = given.api_texts(spark, sf_dir).withColumn("value", broken)
    raw = documents.ingest_api(spark, _land_texts(spark, texts), LOAD_TS, False, "*.txt")
    reason = F.coalesce("reject_reason", F.lit("accepted"))
    return raw.groupBy(reason.alias("outcome")).agg(F.count("*").alias("n_docs"))


def json_outer_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that each hold an array of at most 50 responses."""
    texts = given.api_texts(spark, sf_dir)
    pages = texts.groupBy(F.floor(F.col("event_id") / 50).alias("page")).agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("value"), ", "), F.lit("]")).alias("value")
    )
    landing = _land_texts(spark, pages, per_file=1)
    return _doc_columns(documents.ingest_api(spark, landing, LOAD_TS, True, "*.txt"))


def json_null_strip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A JSON null is treated like an absent key."""
    label = F.when(F.col("event_type") != "error", F.col("event_type"))
    body = F.struct("event_type", label.alias("dominentpol"), F.col("value").alias("aqi"))
    events = given.table(spark, sf_dir, "events")
    texts = events.select(F.to_json(body, {"ignoreNullFields": "false"}).alias("value"))
    parsed = documents.parse_documents(texts)
    present = documents.doc_child(F.col("raw_payload"), "$.dominentpol").isNotNull()
    return parsed.groupBy(
        F.try_variant_get("raw_payload", "$.event_type", "string").alias("event_type")
    ).agg(F.count("*").alias("n_docs"), F.count_if(present).alias("n_present"))


def envelope_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = given.api_texts(spark, sf_dir).withColumn(
        "value",
        F.when(
            F.col("event_type") == "error",
            F.regexp_replace("value", '"status":"ok"', '"status":"error"'),
        ).otherwise(F.col("value")),
    )
    kept = documents.envelope_gate(documents.parse_documents(texts))
    return kept.groupBy("queried_city").agg(F.count("*").alias("n_docs"))


def csv_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = given.csv_records(spark, sf_dir).select(*CSV_COLUMNS)
    return history.ingest_csv(spark, _land_csv(spark, records), LOAD_TS).select(*CSV_COLUMNS)


def csv_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One token per order priority; 'na' in lower case is an ordinary value."""
    tokens = {"1-URGENT": "", "2-HIGH": "NULL", "3-MEDIUM": "null", "4-NOT SPECIFIED": "N/A"}
    priority = F.col("o_orderpriority")
    token = F.lit("na")
    for name, text in tokens.items():
        token = F.when(priority == name, F.lit(text)).otherwise(token)
    status = F.col("o_orderstatus")
    records = given.table(spark, sf_dir, "orders").select(
        *[
            {
                "status": priority,
                "co": token,
                "wind": F.when(status == "F", "NA").otherwise(status),
            }
            .get(c, F.lit("x"))
            .alias(c)
            for c in CSV_COLUMNS
        ]
    )
    raw = history.ingest_csv(spark, _land_csv(spark, records), LOAD_TS)
    return raw.groupBy("status").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("co").isNull()).alias("n_null_co"),
        F.count_if(F.col("wind").isNull()).alias("n_null_wind"),
    )


def csv_arity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of 19, 21 and 23 fields, by order status."""
    records = given.csv_records(spark, sf_dir).select(*CSV_COLUMNS, "o_orderstatus")
    exact = [F.col(c) for c in CSV_COLUMNS]
    shapes = {
        "F": exact[:19],
        "O": exact,
        "P": [*exact, F.lit("more"), F.lit("yet more")],
    }
    landings = []
    for status, columns in shapes.items():
        rows = records.filter(F.col("o_orderstatus") == status)
        named = [c.alias(f"f{i}") for i, c in enumerate(columns)]
        landings.append(_land_csv(spark, rows.select(*named)))
    raw = history.ingest_csv(spark, landings, LOAD_TS)
    shape = F.coalesce("record_shape", F.lit("whole")).alias("shape")
    # commas of the raw text, to see that all its fields were kept
    commas = F.length("raw_record") - F.length(F.replace("raw_record", F.lit(","), F.lit("")))
    return raw.groupBy("alert_level", "status", shape).agg(
        F.count("*").alias("n_rows"), F.count("station_name").alias("n_named"), F.sum(commas).alias("n_commas")
    )


def file_ledger(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three loads: a first drop of files, a second one, and nothing new."""
    store = Store(spark, scratch_path(spark, "ledger"))
    landing = scratch_path(spark, "landing")
    bodies = given.api_bodies(spark, sf_dir)
    early = F.col("ts") < F.lit(EVENT_SPLIT).cast("timestamp_ntz")
    counts = []
    for load, drop in ((1, bodies.filter(early)), (2, bodies.filter(~early)), (3, None)):
        if drop is not None:
            drop.select("data.*").write.mode("append").json(landing)
        load_bronze(store, landing, load, LOAD_TS, whole_files=False)
        rows = store.batch("bronze/api_raw", load, API_RAW)
        counts.append(
            rows.agg(
                F.lit(load).alias("load"),
                F.count("*").alias("n_docs"),
                F.count_if(F.col("reject_reason").isNull()).alias("n_good"),
            )
        )
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


# ---- conform -----------------------------------------------------------------


def aqi_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    price = F.col("l_extendedprice")
    aqi = F.when(F.col("l_returnflag") != "N", F.least(price / 200, F.lit(600.0)))
    lines = given.table(spark, sf_dir, "lineitem").select(aqi.alias("aqi"))
    return lines.groupBy(aqi_category(F.col("aqi")).alias("level")).agg(
        F.count("*").alias("n_rows"), F.min("aqi").alias("lowest"), F.max("aqi").alias("highest")
    )


def city_conform(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact names map; padded names miss the map and fall back to plain text."""
    status = F.col("o_orderstatus")
    orders = given.located(spark, sf_dir, given.table(spark, sf_dir, "orders"), "o_custkey")
    location = F.when(status == "O", F.concat(F.lit(" "), "n_name")).otherwise(F.col("n_name"))
    rows = conform_city(orders.select(location.alias("location")), given.city_map(spark, sf_dir))
    return rows.groupBy("location", "city_slug").agg(F.count("*").alias("n_rows"))


def query_conform_api(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_api(given.api_raw(spark, sf_dir))


def query_conform_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform_csv(given.csv_raw(spark, sf_dir), given.city_map(spark, sf_dir))


# ---- dimensions and keys -----------------------------------------------------


def query_dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar over the span of the orders, with the orders of each day."""
    orders = given.table(spark, sf_dir, "orders").groupBy(
        F.to_date("o_orderdate").alias("full_date")
    ).agg(F.count("*").alias("orders"))
    orders = materialize(orders, "orders-per-day")
    first, last = orders.agg(
        F.min("full_date").cast("string"), F.max("full_date").cast("string")
    ).first()
    days = dim_date(spark, first, last).join(orders, "full_date", "left")
    return days.withColumn("n_orders", F.coalesce("orders", F.lit(0))).drop("orders")


def query_dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = given.table(spark, sf_dir, "events").groupBy(F.hour("ts").alias("hour")).agg(
        F.count("*").alias("events")
    )
    hours = dim_time(spark).join(events, "hour", "left")
    return hours.withColumn("n_events", F.coalesce("events", F.lit(0))).drop("events")


def query_dim_city_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First three regions under old names, then all regions."""
    reference = given.city_reference(spark, sf_dir)
    old = reference.filter(F.col("lon") < 3).withColumn(
        "city_name", F.concat("city_name", F.lit(" (old)"))
    )
    first = materialize(merge_city(None, old), "cities")
    return merge_city(first, reference)


def _two_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Measurements split by load time; the text feed comes in both batches."""
    rows = materialize(given.measurements(spark, sf_dir), "measurements")
    split = F.when(F.col("source") == "api", F.lit(EVENT_SPLIT)).otherwise(F.lit(ORDER_SPLIT))
    early = F.col("ingested_at") < split.cast("timestamp_ntz")
    return rows.filter(early), rows.filter(~early)


def query_dim_station_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    cities = silver(spark, sf_dir).cities
    first, second = _two_batches(spark, sf_dir)
    stations = merge_station(None, station_candidates(first, cities), LOAD_TS)
    stations = materialize(stations, "stations")
    arrived = materialize(station_candidates(second, cities), "candidates")
    merged = merge_station(stations, arrived, LOAD_TS)
    return merged.drop("loaded_at")


def station_best_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    return station_candidates(given.measurements(spark, sf_dir), silver(spark, sf_dir).cities)


def surrogate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs = given.table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey").distinct()
    return allocate_keys(pairs, ["l_suppkey", "l_partkey"], "pair_key", 1)


def _odd_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items with a price that is missing on some lines and no number on others."""
    line = F.col("l_linenumber")
    price = F.when(line == 7, F.lit(None)).when(line == 6, F.lit(float("nan")))
    return given.table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_suppkey",
        "l_extendedprice",
        price.otherwise(F.col("l_extendedprice")).alias("price"),
    )


def global_dense_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranked = dense_rank_desc(_odd_prices(spark, sf_dir).drop("l_suppkey"), {"price": "price_rank"})
    return ranked.drop("price")


def rank_within_group(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items by price within their supplier."""
    lines = _odd_prices(spark, sf_dir).drop("l_extendedprice")
    return dense_rank_desc_within(lines, ["l_suppkey"], "price", "price_rank").drop("price")


def dim_time_minute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every minute of the day, with the events in it."""
    at = [F.hour("ts").alias("hour"), F.minute("ts").alias("minute")]
    events = given.table(spark, sf_dir, "events").groupBy(*at).agg(F.count("*").alias("events"))
    minutes = dim_time(spark, minutes=True).join(events, ["hour", "minute"], "left")
    return minutes.withColumn("n_events", F.coalesce("events", F.lit(0))).drop("events")


def fact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows and index range per city, with one reading per station, time and source."""
    s = silver(spark, sf_dir)
    rows = given.measurements(spark, sf_dir)
    fact = build_fact(rows, s.dates, s.times, s.cities, s.stations, dedup=True)
    return fact.groupBy("city_key", "source").agg(
        F.count("*").alias("n_rows"), F.countDistinct("station_key", "measured_at").alias("n_readings")
    )


def aqi_category_null_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Levels with no label, and with a label of their own, for missing values."""
    aqi = F.when(F.col("l_returnflag") != "N", F.least(F.col("l_extendedprice") / 200, F.lit(600.0)))
    lines = given.table(spark, sf_dir, "lineitem").select(aqi.alias("aqi"))
    levels = [aqi_category(F.col("aqi"), null_label=None), aqi_category(F.col("aqi"), null_label="Unknown")]
    return lines.groupBy(levels[0].alias("level"), levels[1].alias("named_level")).agg(F.count("*").alias("n_rows"))


# ---- fact and marts ----------------------------------------------------------


def fact_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    return silver(spark, sf_dir).fact


def folded_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact appended in four batches, by quarter: three folded in two steps, one replayed, one left."""
    store = Store(spark, scratch_path(spark, "folded"))
    name, fact = "silver/fact_aqi", silver(spark, sf_dir).fact
    quarters = {q: fact.filter(F.quarter("measured_at") == q) for q in (1, 2, 3, 4)}
    for batch, rows in quarters.items():
        store.append(name, rows, batch)
    for upto in (2, 3):
        store.fold(name, upto, FOLDABLE[name])
    store.append(name, quarters[2], 2)
    store.expire_folded(name)
    return store.appended(name)


def fact_minute_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact event times: readings off the hour find no row in the hour dimension."""
    s = silver(spark, sf_dir)
    rows = given.measurements(spark, sf_dir, on_the_hour=False)
    return fact_outcomes(rows, s.dates, s.times, s.cities, s.stations)


def _mart(build: Callable[..., DataFrame]) -> Query:
    return lambda spark, sf_dir: build(silver(spark, sf_dir), given.DECIMALS)


def gold_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Name and size of each mart after a full refresh."""
    store = Store(spark, scratch_path(spark, "gold"))
    written = marts.build_marts(silver(spark, sf_dir), store, 1, given.DECIMALS)
    counts = [
        mart.agg(F.lit(name).alias("mart"), F.count("*").alias("n_rows"))
        for name, mart in written.items()
    ]
    out = counts[0]
    for count in counts[1:]:
        out = out.unionByName(count)
    return out


def ranking_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return marts.ranking_coverage(marts.city_ranking(silver(spark, sf_dir), given.DECIMALS))


# ---- quality gate ------------------------------------------------------------


def _gate(spark: SparkSession, sf_dir: str, check: str | None = None, **changes) -> DataFrame:
    """Gate results at the time of the last event, on a changed star if asked."""
    s = silver(spark, sf_dir)
    s = replace(s, **{name: change(getattr(s, name)) for name, change in changes.items()})
    as_of = s.fact.agg(F.max("ingested_at")).first()[0]
    results = quality.gate_results(s, given.city_reference(spark, sf_dir), as_of=as_of)
    return results if check is None else results.filter(F.col("check_name") == check)


def dq_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gate(spark, sf_dir)


def dq_row_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gate(spark, sf_dir, "row_count")


def dq_null_pct(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = lambda fact: fact.fillna(0.0, ["pm25", "pm10"])
    return _gate(spark, sf_dir, "null_pct", fact=filled)


def dq_aqi_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    shifted = lambda fact: fact.withColumn("aqi", F.col("aqi") * 2 - 100)
    return _gate(spark, sf_dir, "aqi_range", fact=shifted)


def dq_city_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cities of one region lose their readings."""
    fewer = lambda cities: cities.filter(F.col("region") != "ASIA")
    return _gate(spark, sf_dir, "city_coverage", cities=fewer)


def dq_source_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    other = F.when(F.col("aqi") > 450, F.lit("sensor")).otherwise(F.col("source"))
    renamed = lambda fact: fact.withColumn("source", other)
    return _gate(spark, sf_dir, "source_validity", fact=renamed)


def dq_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _gate(spark, sf_dir, "freshness")


def dq_fk_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stations without an API source and the rainy season are taken away."""
    return _gate(
        spark,
        sf_dir,
        "fk_integrity",
        stations=lambda stations: stations.filter("source = 'api'"),
        dates=lambda dates: dates.filter("season = 'Dry'"),
    )


# ---- ad hoc ------------------------------------------------------------------


def raw_peek(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.raw_peek(given.api_raw(spark, sf_dir))


def pollutant_unpivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = documents.unpivot_readings(given.api_raw(spark, sf_dir))
    return rows.groupBy("queried_city", "pollutant").agg(
        F.count("*").alias("n_values"), F.min("value").alias("lowest"), F.max("value").alias("highest")
    )


def asof_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = silver(spark, sf_dir).fact
    then = snapshots.as_of(fact, EVENT_SPLIT)
    return (
        fact.select(F.lit("now").alias("state"))
        .unionByName(then.select(F.lit("then").alias("state")))
        .groupBy("state")
        .agg(F.count("*").alias("n_rows"))
    )


def restore_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact before the second half of the events was loaded, as a new version."""
    store = Store(spark, scratch_path(spark, "restore"))
    fact = silver(spark, sf_dir).fact
    kept = store.replace("fact", snapshots.before(fact, EVENT_SPLIT), 1)
    return kept.groupBy("source").agg(
        F.count("*").alias("n_rows"), F.max("ingested_at").alias("newest")
    )


def _clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "clustered")
    snapshots.write_clustered(silver(spark, sf_dir).fact, path, ["city_key", "date_key"])
    return spark.read.parquet(path)


def layout_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per city and day read back from the clustered copy."""
    return _clustered(spark, sf_dir).groupBy("city_key", "date_key").agg(
        F.count("*").alias("n_rows"), F.max("aqi").alias("max_aqi")
    )


# ---- runs --------------------------------------------------------------------


def _landed(spark: SparkSession, sf_dir: str) -> str:
    """Both feeds as landing files: JSON lines and CSV with a header."""
    root = scratch_path(spark, "landing")
    texts = given.api_texts(spark, sf_dir).select("value")
    texts.write.text(f"{root}/api")
    given.csv_records(spark, sf_dir).select(*CSV_COLUMNS).write.option("header", True).csv(
        f"{root}/history"
    )
    return root


def gated_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status and marts of a run that fails the gate and of one that passes."""
    store = new_store(spark, sf_dir, "run")
    s = load_silver(store, given.measurements(spark, sf_dir), 1, LOAD_TS)
    runs = []
    for batch, (name, gate) in enumerate((("default", GateConfig()), ("relaxed", NOTHING_FAILS)), 1):
        status = finish(store, s, batch, LOAD_TS, replace(CONFIG, gate=gate))
        runs.append(
            gold(store, "daily_summary").agg(
                F.lit(name).alias("run"),
                F.lit(status.code).alias("code"),
                F.lit(",".join(status.failed_checks)).alias("failed"),
                F.count("*").alias("n_daily"),
            )
        )
    return runs[0].unionByName(runs[1])


def batch_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run from landed files through all layers, and one that finds nothing new."""
    store = new_store(spark, sf_dir, "batch-run")
    root, config = _landed(spark, sf_dir), replace(CONFIG, gate=NOTHING_FAILS)
    counts = []
    for batch in (1, 2):
        status = run_medallion(store, root, batch, LOAD_TS, config, False, "*.txt")
        rows = store.batch("silver/fact_aqi", batch, TABLES["silver/fact_aqi"])
        counts.append(
            rows.agg(F.lit(batch).alias("batch"), F.lit(status.code).alias("code"), F.count("*").alias("n_fact"))
        )
    daily = gold(store, "daily_summary").agg(F.count("*").alias("n_daily"))
    return counts[0].unionByName(counts[1]).join(daily, how="left")


def run_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a silver load counted while it wrote: rows by step and outcome."""
    store = new_store(spark, sf_dir, "report")
    api, csv = given.api_raw(spark, sf_dir), given.csv_raw(spark, sf_dir)
    with scratch_scope(spark):
        load_silver(store, tagged(api, csv, given.city_map(spark, sf_dir)), 1, LOAD_TS)
    return store.batch("control/run_report", 1, TABLES["control/run_report"]).filter("n_rows > 0")


def asof_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of every table at two moments, each after one of two loads."""
    store = new_store(spark, sf_dir, "moments")
    config = replace(CONFIG, gate=GateConfig(stop_on=()))
    loads = [datetime(2024, 1, 31), datetime(2024, 2, 2)]
    with scratch_scope(spark):
        for batch, rows in enumerate(_two_batches(spark, sf_dir), 1):
            at = loads[batch - 1]
            finish(store, load_silver(store, rows, batch, at), batch, at, config)
    counts = []
    for at in (datetime(2024, 2, 1), datetime(2024, 3, 1)):
        then = as_of(store, at)
        tables = {"dim_station": then.star.stations, "fact_aqi": then.star.fact, **then.marts}
        for name, rows in tables.items():
            counts.append(
                rows.agg(F.lit(then.batch).alias("batch"), F.lit(name).alias("name"), F.count("*").alias("n_rows"))
            )
    return reduce(DataFrame.unionByName, counts)


def star_slice_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The slice of the star as plain SQL over the registered views and function."""
    surface.register(silver_store(spark, sf_dir))
    return spark.sql(
        """SELECT c.city_name, d.season, t.time_of_day, aqi_category(max(f.aqi)) AS worst_level,
             count(*) AS n_rows, count(DISTINCT s.waqi_idx) AS n_stations
           FROM fact_aqi f JOIN dim_city c USING (city_key) JOIN dim_date d USING (date_key)
             JOIN dim_time t USING (time_key) JOIN dim_station s USING (station_key)
           GROUP BY 1, 2, 3"""
    )


def nested_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each path occurs in the documents, at any depth, and how often as a number."""
    rows = documents.flatten(given.api_raw(spark, sf_dir).select("raw_payload"), deep=True)
    number = F.try_variant_get("value", "$", "decimal(38,5)")
    return rows.groupBy("path", "key", "index").agg(F.count("*").alias("n_rows"), F.count(number).alias("n_numbers"))


def reject_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is refused or cannot be read, by layer and reason."""
    api, csv = given.api_raw(spark, sf_dir), given.csv_raw(spark, sf_dir)
    rows = tagged(api, csv, given.city_map(spark, sf_dir))
    refused = rows.filter("reject_reason IS NOT NULL").groupBy(F.col("reject_reason").alias("reason"))
    counts = refused.agg(F.count("*").alias("n_rows")).select(F.lit("record").alias("layer"), "reason", "n_rows")
    return counts.unionByName(unread_values(csv).select(F.lit("value").alias("layer"), "reason", "n_rows"))


def api_unread_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a reading that is no number on errors, and no time on signups."""
    kind = F.col("event_type")
    reading = F.when(kind == "error", "-").otherwise(F.col("value").cast("string"))
    iso = F.when(kind == "signup", "soon").otherwise(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"))
    body = F.struct(
        F.lit(50).alias("aqi"),
        F.lit(1).alias("idx"),
        F.struct(iso.alias("iso")).alias("time"),
        F.struct(kind.alias("name")).alias("city"),
        F.struct(F.struct(reading.alias("v")).alias("pm25")).alias("iaqi"),
    )
    texts = given.table(spark, sf_dir, "events").select(F.to_json(body).alias("value"))
    return unread_api_values(documents.parse_documents(texts))


def run_stream(spark: SparkSession, sf_dir: str) -> Store:
    """Both streaming jobs over everything that has landed."""
    store = new_store(spark, sf_dir, "stream")
    config = replace(CONFIG, gate=NOTHING_FAILS)
    status = jobs.run_once(
        store, _landed(spark, sf_dir), LOAD_TS, config, whole_files=False, json_glob="*.txt"
    )
    if status.code:
        raise quality.QualityGateError(list(status.failed_checks))
    return store


def _streamed(spark: SparkSession, sf_dir: str) -> Store:
    return _kept(spark, sf_dir, "stream", run_stream)


def stream_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events that land in two folders, by time: one stream loads both, and each file once."""
    store = new_store(spark, sf_dir, "roots")
    bodies = given.api_bodies(spark, sf_dir)
    early = F.col("ts") < F.lit(EVENT_SPLIT).cast("timestamp_ntz")
    roots = [scratch_path(spark, name) for name in ("early", "late")]
    for root, half in zip(roots, (bodies.filter(early), bodies.filter(~early)), strict=True):
        half.select("data.*").write.json(root)
    for _ in range(2):
        for query in jobs.stream_bronze(store, roots, F.lit(LOAD_TS), whole_files=False):
            query.awaitTermination()
    folder = F.when(F.col("source_file").contains(roots[0].split("/")[-1]), "early").otherwise("late")
    rows = spark.read.parquet(store.path(jobs.API_BRONZE))
    return rows.groupBy(folder.alias("folder")).agg(
        F.count("*").alias("n_docs"), F.count_if(F.col("reject_reason").isNull()).alias("n_good")
    )


def stream_ingest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows the streaming load put into the two bronze tables."""
    store = _streamed(spark, sf_dir)
    api = spark.read.parquet(store.path(jobs.API_BRONZE)).select(F.lit("api").alias("feed"))
    csv = spark.read.parquet(store.path(jobs.CSV_BRONZE)).select(F.lit("history").alias("feed"))
    return api.unionByName(csv).groupBy("feed").agg(F.count("*").alias("n_rows"))


def stream_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = star(_streamed(spark, sf_dir)).fact
    return fact.select("date_key", "time_key", "city_key", "measured_at", "aqi", "pm10", "source")


def stream_dim_station(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Natural keys and coordinates; the surrogate key depends on arrival."""
    stations = star(_streamed(spark, sf_dir)).stations
    return stations.select("waqi_idx", "city_key", "station_name", "lat", "lon", "url")


def stream_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold(_streamed(spark, sf_dir), "daily_summary").drop("aggregated_at")


def stream_counts(store: Store) -> DataFrame:
    counts = [
        gold(store, name).agg(F.lit(name).alias("mart"), F.count("*").alias("n_rows"))
        for name in marts.LAYOUT
    ]
    out = counts[0]
    for count in counts[1:]:
        out = out.unionByName(count)
    return out


def stream_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size of every mart after the streaming run."""
    return stream_counts(_streamed(spark, sf_dir))


QUERIES: dict[str, Query] = {
    "aqi_category": aqi_levels,
    "json_ingest": json_ingest,
    "json_ingest_quarantine": json_ingest_quarantine,
    "json_outer_array": json_outer_array,
    "json_null_strip": json_null_strip,
    "envelope_gate": envelope_gate,
    "csv_ingest": csv_ingest,
    "csv_null_tokens": csv_null_tokens,
    "csv_arity": csv_arity,
    "file_ledger": file_ledger,
    "city_conform": city_conform,
    "conform_api": query_conform_api,
    "conform_csv": query_conform_csv,
    "conform_union": given.measurements,
    "dim_date": query_dim_date,
    "dim_time": query_dim_time,
    "dim_city_merge": query_dim_city_merge,
    "dim_station_merge": query_dim_station_merge,
    "station_best_row": station_best_row,
    "surrogate_keys": surrogate_keys,
    "global_dense_rank": global_dense_rank,
    "rank_within_group": rank_within_group,
    "dim_time_minute": dim_time_minute,
    "fact_dedup": fact_dedup,
    "aqi_category_null_label": aqi_category_null_label,
    "fact_build": fact_build,
    "folded_fact": folded_fact,
    "fact_minute_drop": fact_minute_drop,
    "daily_summary": _mart(marts.daily_summary),
    "city_ranking": _mart(marts.city_ranking),
    "station_summary": _mart(marts.station_summary),
    "hourly_pattern": _mart(marts.hourly_pattern),
    "seasonal_summary": _mart(marts.seasonal_summary),
    "gold_all": gold_all,
    "star_slice": _mart(marts.star_slice),
    "ranking_coverage": ranking_coverage,
    "dq_row_count": dq_row_count,
    "dq_null_pct": dq_null_pct,
    "dq_aqi_range": dq_aqi_range,
    "dq_city_coverage": dq_city_coverage,
    "dq_source_validity": dq_source_validity,
    "dq_freshness": dq_freshness,
    "dq_fk_integrity": dq_fk_integrity,
    "dq_gate": dq_gate,
    "raw_peek": raw_peek,
    "pollutant_unpivot": pollutant_unpivot,
    "asof_count": asof_count,
    "restore_before": restore_before,
    "layout_write": layout_write,
    "gated_run": gated_run,
    "batch_run": batch_run,
    "reject_counts": reject_counts,
    "api_unread_values": api_unread_values,
    "run_report": run_report,
    "asof_star": asof_star,
    "star_slice_sql": star_slice_sql,
    "nested_flatten": nested_flatten,
    "stream_roots": stream_roots,
    "stream_ingest": stream_ingest,
    "stream_fact": stream_fact,
    "stream_dim_station": stream_dim_station,
    "stream_daily_summary": stream_daily_summary,
    "stream_run": stream_run,
}
