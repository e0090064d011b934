"""Pollution level labels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from airstrata.config import LEVEL_BOUNDS, LEVEL_LABELS


def aqi_category(
    aqi: Column, labels: Sequence[str] = LEVEL_LABELS, null_label: str | None = LEVEL_LABELS[-1]
) -> Column:
    """Label of an index value; upper bounds are inclusive.

    A missing value gets ``null_label``: the highest level, unless another label or
    None, for no label, is asked for. NaN is above every bound.
    """
    level = F.when(aqi <= F.lit(LEVEL_BOUNDS[0]), F.lit(labels[0]))
    for bound, label in zip(LEVEL_BOUNDS[1:], labels[1:]):
        level = level.when(aqi <= F.lit(bound), F.lit(label))
    missing = labels[-1] if null_label == LEVEL_LABELS[-1] else null_label
    return F.when(aqi.isNull(), F.lit(missing)).otherwise(level.otherwise(F.lit(labels[-1])))
