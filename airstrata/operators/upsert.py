"""MERGE on plain parquet: build the next version of a table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airstrata.operators.ordering import global_index
from airstrata.session import materialize


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    if not df.groupBy(*keys).count().filter("count > 1").isEmpty():
        raise ValueError(f"source of an upsert has duplicate keys {list(keys)}")


def allocate_keys(new_rows: DataFrame, natural: Sequence[str], name: str, start: int) -> DataFrame:
    """Number new rows from ``start`` in the order of their natural key."""
    return global_index(new_rows, natural, "_idx").select(
        (F.col("_idx") + F.lit(start)).cast("bigint").alias(name), *new_rows.columns
    )


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    on_match: Mapping[str, Column],
    surrogate: str,
    start: int | None = None,
) -> DataFrame:
    """Update matched rows, keep the others and insert new ones, in one full outer join.

    ``on_match`` holds an expression per updated column over the aliases ``t``
    and ``s``. ``source`` has all target columns but the surrogate key. New rows are numbered
    from ``start``, or behind the highest key of the target.
    """
    t = target.withColumn("_old", F.lit(True)).alias("t")
    s = source.withColumn("_hit", F.lit(True)).alias("s")
    old, hit = F.col("t._old").isNotNull(), F.col("s._hit").isNotNull()

    def merged(c: str) -> Column:
        kept = F.col(f"t.{c}")
        if c in on_match:
            kept = F.when(hit, on_match[c]).otherwise(kept)
        if c == surrogate:
            return kept.alias(c)
        return F.when(old, kept).otherwise(F.col(f"s.{c}")).alias(c)

    both = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full_outer")
    # stored, as new rows and the others are read apart
    both = materialize(both.select(*map(merged, target.columns), old.alias("_old")), "merged")
    if start is None:
        start = (both.agg(F.max(surrogate)).first()[0] or 0) + 1
    added = both.filter(~F.col("_old")).drop("_old", surrogate)
    inserted = allocate_keys(added, keys, surrogate, start)
    return both.filter("_old").drop("_old").unionByName(inserted.select(*target.columns))


def insert_missing(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``source`` whose keys the target does not hold yet."""
    return source.dropDuplicates(list(keys)).join(target.select(*keys), list(keys), "left_anti")
