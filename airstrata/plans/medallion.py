"""One medallion run: bronze, silver, quality gate, gold."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airstrata.config import CITY_MAP, CITY_REFERENCE, RunConfig
from airstrata.operators.conform import RECORD_REASONS, tagged
from airstrata.operators.dimensions import (
    STATION_BUCKET,
    dim_date,
    dim_time,
    merge_city,
    merge_station,
    station_candidates,
)
from airstrata.operators.fact import OUTCOMES, keyed_measurements
from airstrata.operators.marts import LAYOUT, Star, build_marts, refresh_marts
from airstrata.operators.quality import QualityGateError, run_gate
from airstrata.operators.quarantine import REASON, accepted, rejected
from airstrata.operators.report import RunReport
from airstrata.schemas import API_RAW, BATCH_LOG, CSV_RAW, FACT_COLUMNS, TABLES
from airstrata.schemas import CITY_MAP as CITY_MAP_SCHEMA
from airstrata.schemas import CITY_REFERENCE as CITY_REFERENCE_SCHEMA
from airstrata.session import materialize, scratch_scope
from airstrata.sources.documents import JSON_GLOB, parse_documents, scan_text, tag_api
from airstrata.sources.history import clean_csv, scan_csv, shape_counts
from airstrata.sources.landing import landing_roots
from airstrata.sources.ledger import finish_load, finished_load, fix_roots, load_files
from airstrata.sources.store import Store


@dataclass(frozen=True)
class RunStatus:
    """What a run did: 0 for success, 1 for a stop at the gate."""

    code: int
    failed_checks: tuple[str, ...] = ()


def setup(
    store: Store,
    config: RunConfig = RunConfig(),
    city_map: DataFrame | None = None,
    city_reference: DataFrame | None = None,
) -> None:
    """Write the control tables and the generated dimensions, dropping nothing else."""
    spark = store.spark
    if city_map is None:
        city_map = spark.createDataFrame(CITY_MAP, CITY_MAP_SCHEMA)
    if city_reference is None:
        city_reference = spark.createDataFrame(CITY_REFERENCE, CITY_REFERENCE_SCHEMA)
    store.replace("control/city_map", city_map, 0)
    store.replace("control/city_reference", city_reference, 0)
    store.replace("silver/dim_date", dim_date(spark, config.spine_start, config.spine_end), 0)
    store.replace("silver/dim_time", dim_time(spark), 0)


def load_bronze(
    store: Store,
    roots: str | Sequence[str],
    batch: int,
    load_ts,
    whole_files: bool = True,
    json_glob: str = JSON_GLOB,
    config: RunConfig = RunConfig(),
) -> int:
    """Load the files not loaded yet; returns how many there were.

    Two file streams run over what is new and end, so the files are listed by Spark's file
    source, and its checkpoint keeps them from being loaded again. A batch whose load was
    completed is not loaded again, whatever has landed since.
    """
    done = finished_load(store, "bronze", batch)
    if done is not None:
        return done
    folders = landing_roots(roots)
    fix_roots(store, folders)
    texts = scan_text(store.spark, folders, whole_files, json_glob, stream=True)
    documents = tag_api(parse_documents(texts), load_ts, config.city_from_folder)
    load_files(store, documents, "bronze/api_raw", "bronze", load_ts, batch)
    records = scan_csv(store.spark, folders, stream=True, multi_line=config.multi_line)
    load_files(store, clean_csv(records, load_ts), "bronze/historical_csv", "bronze", load_ts, batch)
    return finish_load(store, "bronze", batch)


def star(store: Store, upto: int | None = None) -> Star:
    """The silver layer; ``upto`` names the last batch to see."""
    limit = None if upto is None else upto + 1
    return Star(
        store.current("silver/dim_date"),
        store.current("silver/dim_time"),
        store.current("silver/dim_city", before=limit),
        store.current("silver/dim_station", before=limit),
        store.appended("silver/fact_aqi", upto=upto),
    )


def gold(store: Store, mart: str, before: int | None = None) -> DataFrame:
    """The current version of a mart; empty while no gate has passed."""
    table = store.current(f"gold/{mart}", before)
    return store.spark.createDataFrame([], TABLES[f"gold/{mart}"]) if table is None else table


KEY_MARK = "control/station_keys"


def upsert_stations(
    store: Store, candidates: DataFrame, batch: int, load_ts, order_free: bool = False
) -> None:
    """Merge candidates into the buckets of the station dimension that they fall into.

    The other buckets keep their files. The highest key given out so far is stored per
    batch, so that new keys need no look at the other buckets.
    """
    buckets = candidates.select(F.expr(STATION_BUCKET).alias("part")).distinct().collect()
    touched = {r["part"] for r in buckets}
    marked = store.current(KEY_MARK, before=batch)
    highest = marked.first()["highest"] if marked is not None else 0
    known = store.read_parts("silver/dim_station", touched, before=batch)
    merged = merge_station(known, candidates, load_ts, order_free, highest + 1)
    written = store.patch(
        "silver/dim_station", merged, batch, STATION_BUCKET, touched, ["waqi_idx", "city_key"]
    )
    highest = written.agg(F.greatest(F.max("station_key"), F.lit(highest)).alias("highest"))
    store.replace(KEY_MARK, highest.withColumn("highest", F.coalesce("highest", F.lit(0)).cast("long")), batch)
    store.expire(KEY_MARK, batch - 1)


def load_silver(
    store: Store, measurements: DataFrame, batch: int, load_ts, order_free: bool = False
) -> Star:
    """Upsert cities and stations, append the fact rows of one batch.

    ``measurements`` is stored first, as it feeds both the stations and the
    fact; its rejected rows stay there as the quarantine. Versions carry the
    batch number and build on the versions before it, so replaying a batch gives
    the same tables.
    """
    if REASON not in measurements.columns:
        measurements = measurements.withColumn(REASON, F.lit(None).cast("string"))
    report = RunReport()
    measurements = report.by_value("conform", measurements, REASON, RECORD_REASONS)
    snapshot = accepted(store.append("silver/measurement", measurements, batch))
    cities = store.replace(
        "silver/dim_city",
        merge_city(
            store.current("silver/dim_city", before=batch),
            store.current("control/city_reference"),
        ),
        batch,
    )
    candidates = materialize(station_candidates(snapshot, cities), "candidates")
    upsert_stations(store, candidates, batch, load_ts, order_free)
    stations = store.current("silver/dim_station", before=batch + 1)
    dates, times = store.current("silver/dim_date"), store.current("silver/dim_time")
    keyed = keyed_measurements(snapshot, dates, times, cities, stations)
    keyed = report.by_value("fact", keyed, "outcome", OUTCOMES)
    fact = keyed.filter("outcome = 'kept'").select(*FACT_COLUMNS)
    store.append("silver/fact_aqi", fact, batch)
    report.save(store, batch)
    log = store.spark.createDataFrame([(batch, load_ts)], BATCH_LOG).coalesce(1)
    store.append("control/batch_log", log, batch)
    return star(store, upto=batch)


def batch_at(store: Store, moment) -> int | None:
    """The last batch that was loaded up to a moment, from the log; None if there was none."""
    log = store.appended("control/batch_log")
    if log is None:
        return None
    return log.filter(F.col("loaded_at") <= F.lit(moment).cast("timestamp_ntz")).agg(F.max("batch")).first()[0]


# appended tables with a folder per batch, and the order their folded rows are stored in
FOLDABLE = {
    "silver/measurement": (),
    "silver/fact_aqi": ("date_key", "city_key", "station_key", "time_key"),
}


def fold_batches(store: Store, upto: int) -> None:
    """Fold the silver batches up to ``upto``, all of which must have been loaded.

    Earlier moments stay readable, as rows keep their batch. ``Store.expire_folded`` deletes
    the old folders once no reader uses them.
    """
    log = store.appended("control/batch_log")
    loaded = None if log is None else log.agg(F.max("batch")).first()[0]
    if loaded is None or upto > loaded:
        raise ValueError(f"batch {upto} is not loaded yet, the last one is {loaded}")
    for name, order in FOLDABLE.items():
        store.fold(name, upto, order)


@dataclass(frozen=True)
class Moment:
    """All layers as they were at a moment: the silver star and the marts by name."""

    batch: int
    star: Star
    marts: dict[str, DataFrame]


def as_of(store: Store, moment) -> Moment | None:
    """Dimensions, fact and marts of the last batch loaded up to a moment.

    Versions of a table follow the batches, so one look into the log picks them all alike:
    the fact's batches up to it, and the newest version not behind it of everything else.
    """
    batch = batch_at(store, moment)
    if batch is None:
        return None
    return Moment(batch, star(store, batch), {m: gold(store, m, batch + 1) for m in LAYOUT})


def finish(
    store: Store,
    silver: Star,
    batch: int,
    load_ts,
    config: RunConfig = RunConfig(),
    incremental: bool = False,
    counted: DataFrame | None = None,
) -> RunStatus:
    """Gate, then gold; gold is not touched when the gate fails.

    ``counted`` carries the counters that earlier batches have stored, and ``incremental``
    says that the marts' state is stored too; else the gate and the marts read the whole fact.
    """
    reference = store.current("control/city_reference")
    try:
        run_gate(silver, reference, store, batch, load_ts, config.gate, counted)
    except QualityGateError as error:
        return RunStatus(1, tuple(error.failed))
    if incremental:
        refresh_marts(silver, store, batch, config.decimals, load_ts)
    else:
        build_marts(silver, store, batch, config.decimals, at=load_ts)
    return RunStatus(0)


def run_medallion(
    store: Store,
    roots: str | Sequence[str],
    batch: int,
    load_ts,
    config: RunConfig = RunConfig(),
    whole_files: bool = True,
    json_glob: str = JSON_GLOB,
) -> RunStatus:
    """Load new files and take them through all layers."""
    with scratch_scope(store.spark):
        load_bronze(store, roots, batch, load_ts, whole_files, json_glob, config)
        api = store.batch("bronze/api_raw", batch, API_RAW).filter("reject_reason is null")
        csv = store.batch("bronze/historical_csv", batch, CSV_RAW)
        rows = tagged(api, csv, store.current("control/city_map"))
        silver = load_silver(store, rows, batch, load_ts, config.order_free_stations)
        return finish(store, silver, batch, load_ts, config)


def quarantine(store: Store) -> DataFrame:
    """Everything that was refused, or kept cut or padded: where, why and how often."""
    counts = []
    records = store.appended("bronze/historical_csv")
    if records is not None:
        shapes = F.concat(F.lit("record_"), "record_shape").alias(REASON)
        counts.append(shape_counts(records).select(F.lit("bronze").alias("layer"), shapes, "n_rows"))
    for layer, table in (("bronze", "bronze/api_raw"), ("silver", "silver/measurement")):
        rows = store.appended(table)
        if rows is not None:
            refused = rejected(rows).groupBy(REASON).agg(F.count("*").alias("n_rows"))
            counts.append(refused.select(F.lit(layer).alias("layer"), REASON, "n_rows"))
    return reduce(DataFrame.unionByName, counts)
