"""Raw documents and text records to one typed measurement set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airstrata.config import API_SOURCE, CSV_SOURCE, POLLUTANT_SENTINEL
from airstrata.functions.parsing import doc_child, try_double, try_int, try_timestamp
from airstrata.operators.quarantine import accepted, tag_rejects
from airstrata.schemas import MEASUREMENT_COLUMNS, READINGS

# fixed values: reading -> its key in the document
DOCUMENT_KEYS = {
    "pm25": "pm25",
    "pm10": "pm10",
    "co": "co",
    "no2": "no2",
    "o3": "o3",
    "so2": "so2",
    "humidity": "h",
    "temperature": "t",
    "pressure": "p",
    "wind": "w",
}


# the parts of a document that are read, in one cast; the index stays raw so
# that a missing value and one that is not a number can be told apart
BODY_TYPE = (
    "struct<aqi: variant, idx: decimal(38,0), dominentpol: string, time: struct<iso: string>, "
    "city: struct<name: string, url: string, geo: array<double>>, iaqi: struct<"
    + ", ".join(f"{key}: struct<v: double>" for key in DOCUMENT_KEYS.values())
    + ">>"
)


def _project_api(api_raw: DataFrame) -> DataFrame:
    """Typed columns of the documents that carry an index value.

    Generating the body as a row of its own keeps the optimizer from copying the
    cast into every filter on its fields: each document is walked once.
    """
    body = F.coalesce(doc_child(F.col("raw_payload"), "$.data"), F.col("raw_payload"))
    typed = F.try_variant_get(body, "$", BODY_TYPE)
    rows = api_raw.select("queried_city", "ingested_at", F.explode(F.array(typed)).alias("doc"))
    has_aqi = F.col("doc.aqi").isNotNull() & ~F.is_variant_null("doc.aqi")
    return rows.filter(has_aqi).select(
        F.col("doc.idx").try_cast("int").alias("waqi_idx"),
        F.col("doc.city.name").alias("station_name"),
        F.get("doc.city.geo", F.lit(0)).alias("lat"),
        F.get("doc.city.geo", F.lit(1)).alias("lon"),
        F.col("doc.city.url").alias("url"),
        F.col("queried_city").alias("city_slug"),
        F.lit(API_SOURCE).alias("source"),
        try_timestamp(F.left("doc.time.iso", F.lit(19))).alias("measured_at"),
        F.try_variant_get("doc.aqi", "$", "double").alias("aqi"),
        F.nullif(F.col("doc.dominentpol"), F.lit(POLLUTANT_SENTINEL)).alias("dominant_pollutant"),
        *[F.col(f"doc.iaqi.{DOCUMENT_KEYS[c]}.v").alias(c) for c in READINGS],
        "ingested_at",
    )


def tagged_api(api_raw: DataFrame) -> DataFrame:
    """Typed document rows with the reason for a reject.

    Documents without an index value are no measurements and drop out; an index
    that is not a number (and a station without id or name) is a reject.
    """
    return tag_rejects(
        _project_api(api_raw),
        {
            "aqi_not_numeric": F.col("aqi").isNull(),
            "no_station_id": F.col("waqi_idx").isNull(),
            "no_station_name": F.col("station_name").isNull(),
        },
    )


def conform_api(api_raw: DataFrame) -> DataFrame:
    return accepted(tagged_api(api_raw)).select(*MEASUREMENT_COLUMNS)


def conform_city(records: DataFrame, city_map: DataFrame) -> DataFrame:
    """Add the city slug: exact match on the display name, else its plain text."""
    return (
        records.join(city_map, records["location"] == city_map["source_city"], "left")
        .withColumn(
            "city_slug", F.coalesce(F.col("conformed_city"), F.lower(F.trim(F.col("location"))))
        )
        .drop("source_city", "conformed_city")
    )


def _project_csv(csv_raw: DataFrame, city_map: DataFrame) -> DataFrame:
    typed = csv_raw.withColumn("waqi_idx", try_int(F.col("station_id")))
    return conform_city(typed, city_map).select(
        "waqi_idx",
        "station_name",
        F.lit(None).cast("double").alias("lat"),
        F.lit(None).cast("double").alias("lon"),
        "url",
        "city_slug",
        F.lit(CSV_SOURCE).alias("source"),
        try_timestamp(F.col("data_time_s")).alias("measured_at"),
        try_double(F.col("aqi_index")).alias("aqi"),
        F.nullif(F.col("dominant_pollutant"), F.lit(POLLUTANT_SENTINEL)).alias(
            "dominant_pollutant"
        ),
        *[try_double(F.col(c)).alias(c) for c in READINGS],
        "ingested_at",
    )


def tagged_csv(csv_raw: DataFrame, city_map: DataFrame) -> DataFrame:
    """Typed text records with the reason for a reject."""
    return tag_rejects(
        _project_csv(csv_raw, city_map),
        {
            "station_not_numeric": F.col("waqi_idx").isNull(),
            "no_station_name": F.col("station_name").isNull(),
        },
    )


def unread_api_values(api_raw: DataFrame) -> DataFrame:
    """reason, n_rows: readings and times of accepted documents that hold no number or time.

    The counterpart of ``unread_values`` for documents; a JSON null counts as missing.
    """
    readings = ", ".join(f"{key}: struct<v: variant>" for key in DOCUMENT_KEYS.values())
    kind = (
        "struct<aqi: double, idx: decimal(38,0), time: struct<iso: string>, city: struct<name: string>, "
        f"iaqi: struct<{readings}>>"
    )
    body = F.coalesce(doc_child(F.col("raw_payload"), "$.data"), F.col("raw_payload"))
    docs = api_raw.select(F.explode(F.array(F.try_variant_get(body, "$", kind))).alias("doc"))
    kept = docs.filter("doc.aqi IS NOT NULL AND try_cast(doc.idx AS int) IS NOT NULL AND doc.city.name IS NOT NULL")

    def lost(value):
        there = value.isNotNull() & ~F.is_variant_null(value)
        return F.count_if(there & F.try_variant_get(value, "$", "double").isNull())

    found = {f"{name}_not_numeric": lost(F.col(f"doc.iaqi.{key}.v")) for name, key in DOCUMENT_KEYS.items()}
    at = F.col("doc.time.iso")
    found["time_not_parsed"] = F.count_if(at.isNotNull() & try_timestamp(F.left(at, F.lit(19))).isNull())
    counts = [F.struct(F.lit(reason).alias("reason"), n.alias("n_rows")) for reason, n in found.items()]
    return kept.agg(F.array(*counts).alias("found")).select(F.inline("found")).filter("n_rows > 0")


def unread_values(csv_raw: DataFrame) -> DataFrame:
    """reason, n_rows: texts of accepted records that hold no number or time.

    Such a reading is NULL in a row that stays, so no reject tells of it.
    """

    def lost(text, parsed):
        return F.count_if(text.isNotNull() & parsed.isNull())

    names = {"aqi_index": "aqi", **{c: c for c in READINGS}}
    counts = [F.struct(F.lit(f"{n}_not_numeric").alias("reason"), lost(F.col(c), try_double(F.col(c))).alias("n_rows")) for c, n in names.items()]
    at = F.col("data_time_s")
    counts.append(F.struct(F.lit("time_not_parsed").alias("reason"), lost(at, try_timestamp(at)).alias("n_rows")))
    kept = csv_raw.filter(try_int(F.col("station_id")).isNotNull() & F.col("station_name").isNotNull())
    return kept.agg(F.array(*counts).alias("found")).select(F.inline("found")).filter("n_rows > 0")


def conform_csv(csv_raw: DataFrame, city_map: DataFrame) -> DataFrame:
    """Typed text records. A row needs a numeric station id, but no index value."""
    return accepted(tagged_csv(csv_raw, city_map)).select(*MEASUREMENT_COLUMNS)


RECORD_REASONS = (
    "aqi_not_numeric",
    "no_station_id",
    "no_station_name",
    "station_not_numeric",
)


def tagged(api_raw: DataFrame, csv_raw: DataFrame, city_map: DataFrame) -> DataFrame:
    """Both feeds in one schema, with the reason for a reject.

    Good and bad rows come out of one pass; storing them together and filtering
    on the reason saves the quarantine a second look at the raw data.
    """
    return tagged_api(api_raw).unionByName(tagged_csv(csv_raw, city_map))


def conform(api_raw: DataFrame, csv_raw: DataFrame, city_map: DataFrame) -> DataFrame:
    return accepted(tagged(api_raw, csv_raw, city_map)).select(*MEASUREMENT_COLUMNS)
