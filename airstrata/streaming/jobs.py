"""The medallion run as two Structured Streaming jobs.

The first loads landing files into bronze; its file sink records each file once.
The second follows the bronze tables and takes every micro-batch through silver,
the gate and gold. Both commit their offsets after their writes, and all writes
of the second carry the batch number, so a batch that is run again after a
failure overwrites what it had written.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from airstrata.config import RunConfig
from airstrata.operators.conform import tagged
from airstrata.operators.marts import LAYOUT, Partials
from airstrata.operators.quality import QualityGateError, advance_profile, stored_profile
from airstrata.plans.medallion import RunStatus, finish, load_silver
from airstrata.schemas import API_RAW, CSV_RAW, TABLES
from airstrata.session import scratch_scope
from airstrata.sources.documents import JSON_GLOB, parse_documents, scan_text, tag_api
from airstrata.sources.history import CSV_GLOB, clean_csv, scan_csv
from airstrata.sources.landing import landing_roots
from airstrata.sources.ledger import fix_roots
from airstrata.sources.store import Store

# fixed value: how often the incremental run starts as a service
CADENCE = "5 minutes"

API_BRONZE = "bronze/api_raw"
CSV_BRONZE = "bronze/historical_csv"


def _trigger(once: bool) -> dict:
    return {"availableNow": True} if once else {"processingTime": CADENCE}


def _to_bronze(store: Store, rows: DataFrame, table: str, once: bool) -> StreamingQuery:
    return (
        rows.writeStream.format("parquet")
        .option("path", store.path(table))
        .option("checkpointLocation", store.path(f"checkpoints/{table}"))
        .trigger(**_trigger(once))
        .start()
    )


def stream_bronze(
    store: Store,
    root: str | Sequence[str],
    load_ts: Column | None = None,
    once: bool = True,
    whole_files: bool = True,
    files_per_batch: int | None = None,
    json_glob: str = JSON_GLOB,
    csv_glob: str = CSV_GLOB,
    config: RunConfig = RunConfig(),
) -> list[StreamingQuery]:
    """Load new files below one or several folders into the two bronze tables.

    The folders are those of the first start, as the checkpoint keeps an offset for each.

    ``once`` works off what is there and ends; otherwise the jobs keep running
    and look for files every five minutes.
    """
    # the gate compares load times with UTC, whatever the session's zone is
    now = F.convert_timezone(None, F.lit("UTC"), F.localtimestamp())
    load_ts = now if load_ts is None else load_ts
    roots = landing_roots(root)
    fix_roots(store, roots)
    texts = scan_text(store.spark, roots, whole_files, json_glob, True, files_per_batch)
    records = scan_csv(store.spark, roots, csv_glob, True, files_per_batch, config.multi_line)
    documents = tag_api(parse_documents(texts), load_ts, config.city_from_folder)
    return [
        _to_bronze(store, documents, API_BRONZE, once),
        _to_bronze(store, clean_csv(records, load_ts), CSV_BRONZE, once),
    ]


def bronze_changes(store: Store, files_per_batch: int | None = None) -> DataFrame:
    """New measurements of both bronze tables as one stream."""

    def follow(table: str, schema: str) -> DataFrame:
        reader = store.spark.readStream.schema(schema)
        if files_per_batch:
            reader = reader.option("maxFilesPerTrigger", files_per_batch)
        return reader.parquet(store.path(table))

    api = follow(API_BRONZE, API_RAW).filter("reject_reason is null")
    return tagged(api, follow(CSV_BRONZE, CSV_RAW), store.current("control/city_map"))


def process_batch(
    store: Store,
    measurements: DataFrame,
    batch: int,
    load_ts,
    config: RunConfig,
) -> RunStatus:
    """Silver, gate and gold for one micro-batch.

    The gate and the marts work from counters and partial aggregates. A batch folds its
    own into the state that the batch before left, so its cost follows the new rows and
    the number of groups, not the fact or the number of batches. Where ``keep_versions``
    is set, older versions of dimensions and marts are deleted.
    """
    with scratch_scope(store.spark):
        silver = load_silver(store, measurements, batch, load_ts, config.order_free_stations)
        added = store.batch("silver/fact_aqi", batch, TABLES["silver/fact_aqi"])
        fresh = replace(silver, fact=added)
        advance_profile(store, fresh, batch, config.gate)
        counted = stored_profile(store, silver, batch, config.gate, load_ts)
        Partials.scanned(fresh, config.decimals).advance(store, batch)
        status = finish(store, silver, batch, load_ts, config, True, counted)
    if config.keep_versions and batch > config.keep_versions:
        for table in ("silver/dim_city", "silver/dim_station", *(f"gold/{m}" for m in LAYOUT)):
            # the newest version stays, even if the gate has held gold back
            newest = store.current_version(table)
            if newest is not None:
                store.expire(table, min(batch - config.keep_versions + 1, newest))
    return status


def stream_gold(
    store: Store,
    load_ts: datetime | None = None,
    config: RunConfig = RunConfig(),
    once: bool = True,
    stop_on_failure: bool = False,
    files_per_batch: int | None = None,
    on_status: Callable[[RunStatus], None] | None = None,
) -> StreamingQuery:
    """Follow bronze up to gold.

    A failed gate leaves the silver rows and the old marts in place and the next
    batch goes on, as a scheduled run would; ``stop_on_failure`` ends the job
    instead. Batch 0 is the setup, so micro-batches count from 1. ``load_ts``
    fixes the load time, which is else the time a batch starts.
    """

    def handle(rows: DataFrame, batch_id: int) -> None:
        now = load_ts or datetime.now(timezone.utc).replace(tzinfo=None)
        status = process_batch(store, rows, batch_id + 1, now, config)
        if on_status:
            on_status(status)
        if status.code and stop_on_failure:
            raise QualityGateError(list(status.failed_checks))

    return (
        bronze_changes(store, files_per_batch)
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", store.path("checkpoints/gold"))
        .trigger(**_trigger(once))
        .start()
    )


def run_once(
    store: Store,
    root: str | Sequence[str],
    load_ts,
    config: RunConfig = RunConfig(),
    whole_files: bool = True,
    files_per_batch: int | None = None,
    json_glob: str = JSON_GLOB,
) -> RunStatus:
    """Take everything that has landed through all layers, then return how it ended.

    The gate judges all that was loaded so far, so the status is that of the last batch; it
    is 0 if there was nothing new.
    """
    stamp = F.lit(load_ts)
    for query in stream_bronze(
        store, root, stamp, True, whole_files, files_per_batch, json_glob, config=config
    ):
        query.awaitTermination()
    seen = [RunStatus(0)]
    stream_gold(store, load_ts, config, True, False, files_per_batch, seen.append).awaitTermination()
    return seen[-1]
