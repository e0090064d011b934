"""Earlier states of the fact, and its layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def as_of(fact: DataFrame, moment) -> DataFrame:
    """The fact as it was at ``moment``: it only grows, so load time decides."""
    return fact.filter(F.col("ingested_at") <= F.lit(moment).cast("timestamp_ntz"))


def before(fact: DataFrame, moment) -> DataFrame:
    """The fact as it was before a load, to be written as a new version."""
    return fact.filter(F.col("ingested_at") < F.lit(moment).cast("timestamp_ntz"))


def write_clustered(
    table: DataFrame, path: str, by: Sequence[str], files: int | None = None
) -> None:
    """Rewrite a stored table so that each file covers a narrow key range.

    Without a number of ``files`` adaptive execution sizes the partitions.

    The row number ends the range key, so that a key with much of the data, or many
    copies of a row, spreads over as many files as it fills. Within a scan of stored files
    row numbers are repeatable, so a retried task salts its rows alike; call
    this on a table that was read, not on the result of a shuffle.
    """
    salted = table.withColumn("_salt", F.monotonically_increasing_id())
    target = () if files is None else (files,)
    (
        salted.repartitionByRange(*target, *by, "_salt")
        .sortWithinPartitions(*by)
        .drop("_salt")
        .write.mode("overwrite")
        .parquet(path)
    )
