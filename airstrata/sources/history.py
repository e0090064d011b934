"""Historical readings: all-string CSV files into the bronze record table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airstrata.functions.parsing import null_tokens_to_null
from airstrata.schemas import CSV_COLUMNS, HISTORY_CSV
from airstrata.sources.landing import scan_files

CSV_GLOB = "*.csv"


def scan_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    glob: str = CSV_GLOB,
    stream: bool = False,
    files_per_batch: int | None = None,
    multi_line: bool = False,
) -> DataFrame:
    """The 21 text columns by position, header line skipped, with the file path.

    ``multi_line`` lets quoted texts hold line breaks; a file is then read by one task.

    Short records are padded with NULL and long ones cut. ``raw_record`` holds the text of
    such a record, and of one whose quotes do not match; it is NULL for a record that fits.
    """
    reader = (
        (spark.readStream if stream else spark.read)
        .format("csv")
        .schema(f"{HISTORY_CSV}, raw_record string")
        .option("columnNameOfCorruptRecord", "raw_record")
        # the number of fields shows only when all are read
        .option("columnPruning", False)
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("multiLine", multi_line)
    )
    return scan_files(reader, paths, [*CSV_COLUMNS, "raw_record"], glob, stream, files_per_batch)


def record_shape(raw_record: Column) -> Column:
    """``cut`` for a text with more fields than columns, ``padded`` for one with fewer.

    NULL for a NULL text; ``malformed`` where the number of fields fits.
    """
    # quoted fields may hold commas
    bare = F.regexp_replace(raw_record, r'(^|,)"(?:[^"]|"")*"', "$1")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return (
        F.when(fields > len(CSV_COLUMNS), "cut")
        .when(fields < len(CSV_COLUMNS), "padded")
        .when(fields.isNotNull(), "malformed")
    )


def clean_csv(records: DataFrame, load_ts) -> DataFrame:
    """Null tokens become NULL in every column; load time and shape are added."""
    raw = F.lit(None).cast("string")
    if "raw_record" in records.columns:
        # names another column too: Spark reads no file for the text of odd records alone
        raw = F.when(F.col("raw_record").isNotNull() | F.col("station_id").isNotNull(), F.col("raw_record"))
    return records.select(
        *[null_tokens_to_null(F.col(c)).alias(c) for c in CSV_COLUMNS],
        F.lit(load_ts).cast("timestamp_ntz").alias("ingested_at"),
        "source_file",
        raw.alias("raw_record"),
        record_shape(raw).alias("record_shape"),
    )


def shape_counts(csv_raw: DataFrame) -> DataFrame:
    """record_shape and n_rows of the records that do not fit the columns."""
    odd = csv_raw.filter(F.col("record_shape").isNotNull())
    return odd.groupBy("record_shape").agg(F.count("*").alias("n_rows"))


def ingest_csv(
    spark: SparkSession,
    paths: str | Sequence[str],
    load_ts,
    glob: str = CSV_GLOB,
    multi_line: bool = False,
) -> DataFrame:
    return clean_csv(scan_csv(spark, paths, glob, multi_line=multi_line), load_ts)
