"""Mergeable sums and averages that do not depend on the order of the rows.

A sum has two parts: ``sum_x`` adds, as decimals and so exactly, the values that a decimal
of the agreed scale represents; ``odd_x`` adds all others as doubles (NaN, infinities,
values of 1e16 and more, values with more decimals). ``cnt_x`` counts both. No value is
rounded, clamped or left out.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_DIGITS = 28
# up to 1e12 such values add up within the 38 digits of a decimal
_LIMIT = 16


def _exact(value: Column, decimals: int | None) -> Column:
    """The value as a decimal where that loses nothing, else NULL."""
    scale = 0 if decimals is None else decimals
    kind = f"decimal({_DIGITS},{scale})"
    if decimals is None:
        return F.lit(None).cast(kind)
    value = value.cast("double")
    fits = F.abs(value) < float(10 ** min(_LIMIT, _DIGITS - scale))
    number = F.when(fits, value).try_cast(kind)
    return F.when(number.cast("double") == value, number)


def with_exact(rows: DataFrame, names: Sequence[str], decimals: int | None) -> DataFrame:
    """Adds exact_name, the decimal of each value where that loses nothing.

    As columns of their own the decimals are worked out once per row and not per aggregate.
    """
    return rows.withColumns({f"exact_{n}": _exact(F.col(n), decimals) for n in names})


def prepared_sums(name: str) -> list[Column]:
    """Aggregates sum_name, odd_name and cnt_name over rows that ``with_exact`` has prepared."""
    exact = F.col(f"exact_{name}")
    return _sums(exact, F.col(name), name)


def sums(value: Column, name: str, decimals: int | None) -> list[Column]:
    """The same aggregates over any value; without decimals all values are odd."""
    return _sums(_exact(value, decimals), value, name)


def _sums(exact: Column, value: Column, name: str) -> list[Column]:
    return [
        F.sum(exact).alias(f"sum_{name}"),
        F.sum(F.when(exact.isNull(), value)).alias(f"odd_{name}"),
        F.count(value).alias(f"cnt_{name}"),
    ]


def merged_sums(name: str) -> list[Column]:
    """The same aggregates over their own results."""
    return [F.sum(f"{part}_{name}").alias(f"{part}_{name}") for part in ("sum", "odd", "cnt")]


def mean(name: str) -> Column:
    """Average of what was summed; NULL for a group without values."""
    total = F.coalesce(F.col(f"sum_{name}").cast("double"), F.lit(0.0)) + F.coalesce(
        F.col(f"odd_{name}"), F.lit(0.0)
    )
    return F.when(F.col(f"cnt_{name}") > 0, total / F.col(f"cnt_{name}"))


def ordered_mean(values: Column) -> Column:
    """Average of a short array of doubles, added from the smallest up."""
    total = F.aggregate(F.sort_array(values), F.lit(0.0), lambda a, x: a + x)
    return F.when(F.size(values) > 0, total / F.size(values))
