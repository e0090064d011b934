"""Raw API responses: JSON files into the bronze document table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airstrata.functions.parsing import doc_child, doc_string
from airstrata.operators.quarantine import tag_rejects
from airstrata.session import materialize
from airstrata.sources.landing import scan_files

JSON_GLOB = "*.json"


def scan_text(
    spark: SparkSession,
    paths: str | Sequence[str],
    whole_files: bool = True,
    glob: str = JSON_GLOB,
    stream: bool = False,
    files_per_batch: int | None = None,
) -> DataFrame:
    """Text and file path of every document below ``paths``.

    ``whole_files`` reads a file as one text: an object, or an array of objects,
    on any number of lines. Without it a file holds one text per line, which is
    the shape for bulk loads, as such files can be split between tasks. Folders do not
    lie inside one another.
    """
    reader = (spark.readStream if stream else spark.read).format("text").option("wholetext", whole_files)
    return scan_files(reader, paths, ["value"], glob, stream, files_per_batch)


def parse_documents(texts: DataFrame, text: str = "value") -> DataFrame:
    """One row per JSON object; an outer array is opened.

    Text that is not JSON, or has a key twice in an object, gives a NULL payload.
    """
    starts_array = F.substring(F.ltrim(F.col(text)), 1, 1) == "["
    elements = F.when(
        starts_array & F.col("_doc").isNotNull(),
        F.try_variant_get("_doc", "$", "array<variant>"),
    ).otherwise(F.array("_doc"))
    return (
        texts.withColumn("_doc", F.try_parse_json(text))
        .withColumn("raw_payload", F.explode(elements))
        .drop("_doc")
    )


def _folder_of(file_path: Column) -> Column:
    return F.element_at(F.split(file_path, "/"), -2)


def queried_city(from_folder: bool = False) -> Column:
    """The city a response was asked for, in the wrapped or the bare shape.

    ``from_folder`` falls back to the name of the folder the file landed in.
    """
    payload = F.col("raw_payload")
    found = [doc_string(payload, "$.data._queried_city"), doc_string(payload, "$._queried_city")]
    if from_folder:
        found.append(_folder_of(F.col("source_file")))
    return F.coalesce(*found)


def envelope_ok() -> Column:
    """A wrapped response must say so; a bare one has no status."""
    status = doc_string(F.col("raw_payload"), "$.status")
    wrapped = doc_child(F.col("raw_payload"), "$.data").isNotNull() | status.isNotNull()
    return ~wrapped | F.coalesce(status == "ok", F.lit(False))


def envelope_gate(documents: DataFrame, city_from_folder: bool = False) -> DataFrame:
    """Keep good responses and attach the queried city.

    ``city_from_folder`` falls back to the folder name of the landing path.
    """
    city = queried_city(city_from_folder)
    return documents.filter(envelope_ok()).withColumn("queried_city", city)


API_REASONS = ("malformed_json", "status_not_ok", "no_queried_city")


def tag_api(documents: DataFrame, load_ts, city_from_folder: bool = False) -> DataFrame:
    """Bronze document rows with the reason for a reject, NULL for good rows."""
    rows = documents.select(
        queried_city(city_from_folder).alias("queried_city"),
        "raw_payload",
        F.lit(load_ts).cast("timestamp_ntz").alias("ingested_at"),
        "source_file",
    )
    broken = [F.col("raw_payload").isNull(), ~envelope_ok(), F.col("queried_city").isNull()]
    return tag_rejects(rows, dict(zip(API_REASONS, broken, strict=True)))


def ingest_api(
    spark: SparkSession,
    paths: str | Sequence[str],
    load_ts,
    whole_files: bool = True,
    glob: str = JSON_GLOB,
) -> DataFrame:
    return tag_api(parse_documents(scan_text(spark, paths, whole_files, glob)), load_ts)


def raw_peek(api_raw: DataFrame, rows: int = 10) -> DataFrame:
    """City, index and station of the first documents, in a fixed order."""
    body = F.coalesce(doc_child(F.col("raw_payload"), "$.data"), F.col("raw_payload"))
    peek = api_raw.select(
        "queried_city",
        F.try_variant_get(body, "$.aqi", "double").alias("aqi"),
        F.try_variant_get(body, "$.city.name", "string").alias("station"),
    )
    return peek.orderBy("queried_city", "station", "aqi").limit(rows)


def unpivot_readings(api_raw: DataFrame) -> DataFrame:
    """One row per document and reading, whatever readings the document has."""
    body = F.coalesce(doc_child(F.col("raw_payload"), "$.data"), F.col("raw_payload"))
    readings = F.try_variant_get(body, "$.iaqi", "map<string,variant>")
    return api_raw.select("queried_city", F.explode(readings).alias("pollutant", "reading")).select(
        "queried_city", "pollutant", F.try_variant_get("reading", "$.v", "double").alias("value")
    )


def flatten(documents: DataFrame, column: str = "raw_payload", deep: bool = False) -> DataFrame:
    """One row per entry of the object or array in a VARIANT column.

    Adds path, key (of an object's entry), index (of an array's) and value. A scalar or a
    missing value has no entries. ``deep`` opens the entries too, level by level until none
    holds an object or array, however deep that is; containers have rows of their own.
    """
    spark = documents.sparkSession
    others = [c for c in documents.columns if c != column]
    level = documents.select(*others, F.lit("$").alias("path"), F.col(column).alias("value"))
    found = []
    while True:
        entries = spark.tvf.variant_explode(F.col("value").outer())
        opened = level.withColumnRenamed("path", "_above").lateralJoin(
            entries.toDF("_place", "_name", "_entry")
        )
        step = F.when(F.col("_name").isNotNull(), F.concat(F.lit("."), "_name")).otherwise(
            F.concat(F.lit("["), "_place", F.lit("]"))
        )
        # the place counts an object's entries too; only an array's is an index
        opened = opened.select(
            *others,
            F.concat("_above", step).alias("path"),
            F.col("_name").alias("key"),
            F.when(F.col("_name").isNull(), F.col("_place")).alias("index"),
            F.col("_entry").alias("value"),
        )
        if not deep:
            return opened
        opened = materialize(opened, "flattened")
        found.append(opened)
        level = opened.filter(F.schema_of_variant("value").rlike("^(OBJECT|ARRAY)")).select(*others, "path", "value")
        if level.isEmpty():
            return reduce(DataFrame.unionByName, found)
