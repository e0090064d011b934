"""Global order without a single-partition window.

Rows are range-partitioned, sorted per partition and written once with their
partition number and position. The rows per partition (one number each) give
every partition its offset, and offset + position is the global index.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airstrata.session import materialize


def _ordered(df: DataFrame, order_cols: Sequence[str]) -> DataFrame:
    spread = df.repartitionByRange(*[F.col(c).asc_nulls_first() for c in order_cols])
    placed = spread.sortWithinPartitions(*[F.col(c).asc_nulls_first() for c in order_cols])
    return materialize(
        placed.withColumn("_part", F.spark_partition_id()).withColumn(
            "_pos", F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
        ),
        "ordered",
    )


def _add_offset(placed: DataFrame, size: Column, name: str) -> DataFrame:
    """Add the running total of ``size`` over all earlier partitions.

    One row per partition comes to the driver and goes back as a broadcast.
    """
    sizes = placed.groupBy("_part").agg(size.alias("n")).orderBy("_part").collect()
    if len(sizes) < 2:
        return placed.withColumn(name, F.lit(0).cast("bigint"))
    rows, before = [], 0
    for part in sizes:
        rows.append((part["_part"], before))
        before += part["n"]
    offsets = placed.sparkSession.createDataFrame(rows, f"_part int, {name} bigint")
    return placed.join(F.broadcast(offsets), "_part")


def global_index(df: DataFrame, order_cols: Sequence[str], name: str = "idx") -> DataFrame:
    """Add a gap-free 0-based index in the order of ``order_cols``.

    The order columns must identify a row, so that the index does not depend
    on how the rows were spread.
    """
    placed = _ordered(df, order_cols)
    return (
        _add_offset(placed, F.count("*"), "_before")
        .withColumn(name, F.col("_before") + F.col("_pos"))
        .drop("_part", "_pos", "_before")
    )


def _rank_table(values: DataFrame, groups: Sequence[str], few_groups: bool = False) -> DataFrame:
    """Dense rank of each distinct ``_value`` per group: NULL, NaN, then highest first.

    A value's rank is its place in the global order of (group, value) less the
    place of the first value of its group, so no task gathers a group. With
    ``few_groups``, a number fixed by the caller, the first places are broadcast;
    a shuffle would bring all values of a group together.
    """
    distinct = values.distinct().select(
        "*",
        F.col("_value").isNotNull().alias("_known"),
        (~F.isnan(F.col("_value").cast("double"))).alias("_number"),
        (-F.col("_value")).alias("_descending"),
    )
    placed = global_index(distinct, [*groups, "_known", "_number", "_descending"], "_idx")
    firsts = placed.groupBy(*groups).agg(F.min("_idx").alias("_first"))
    firsts = firsts.select(*[F.col(g).alias(f"_f{g}") for g in groups], "_first")
    if few_groups:
        firsts = F.broadcast(firsts)
    match = [placed[g].eqNullSafe(firsts[f"_f{g}"]) for g in groups]
    return placed.join(firsts, match).select(
        *groups, "_value", (F.col("_idx") - F.col("_first") + 1).alias("_rank")
    )


def dense_rank_desc(df: DataFrame, ranks: Mapping[str, str]) -> DataFrame:
    """DENSE_RANK over all rows for each ranked column, highest value first.

    ``ranks`` maps a column to the name of its rank; a NULL ranks above every
    value. All columns are put in order together, as groups of one ordering.
    ``df`` should be a stored result, as it is read once to order the values and
    once to attach the ranks.
    """
    stacked = F.array(
        *[
            F.struct(F.lit(place).alias("_column"), F.col(column).alias("_value"))
            for place, column in enumerate(ranks)
        ]
    )
    table = _rank_table(df.select(F.inline(stacked)), ["_column"], few_groups=True)
    for place, (column, name) in enumerate(ranks.items()):
        mine = table.filter(F.col("_column") == place).select(
            F.col("_value"), F.col("_rank").alias(name)
        )
        df = df.join(mine, df[column].eqNullSafe(mine["_value"])).drop("_value")
    return df


def dense_rank_desc_within(
    df: DataFrame, groups: Sequence[str], value_col: str, name: str
) -> DataFrame:
    """DENSE_RANK per group, highest value first, NULL above NaN above every number.

    ``df`` should be a stored result, as it is read twice. Groups of any size are ranked by
    their place in the global order of distinct values.
    """
    values = df.select(*[F.col(g).alias(f"_g{g}") for g in groups], F.col(value_col).alias("_value"))
    table = _rank_table(values, [f"_g{g}" for g in groups])
    match = [df[g].eqNullSafe(table[f"_g{g}"]) for g in groups]
    match.append(df[value_col].eqNullSafe(table["_value"]))
    return df.join(table, match).select(*df.columns, F.col("_rank").alias(name))
