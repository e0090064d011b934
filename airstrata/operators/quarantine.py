"""Separate rows that break a rule, with the name of the rule."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

REASON = "reject_reason"


def tag_rejects(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add the name of the first broken rule, NULL for a good row.

    Each rule is a condition that holds for bad rows; unknown counts as good.
    """
    return df.withColumn(
        REASON, F.coalesce(*[F.when(broken, F.lit(name)) for name, broken in rules.items()])
    )


def accepted(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNull()).drop(REASON)


def rejected(df: DataFrame) -> DataFrame:
    return df.filter(F.col(REASON).isNotNull())
