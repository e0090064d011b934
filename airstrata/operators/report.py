"""Counts of what a run reads, refuses, drops and writes, taken while it writes.

The counts are observed on the rows as they pass to the written table, so they cost no
second read.
"""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from airstrata.schemas import RUN_REPORT


class RunReport:
    """Observed counts of the steps of one run, by step and metric."""

    def __init__(self) -> None:
        self._watched: dict[str, Observation] = {}

    def watch(self, step: str, rows: DataFrame, metrics: Mapping[str, Column]) -> DataFrame:
        """The same rows; once they are written the number of them for which each metric holds is known."""
        seen = self._watched[step] = Observation(step)
        counts = [F.count_if(holds).alias(name) for name, holds in metrics.items()]
        return rows.observe(seen, F.count("*").alias("rows"), *counts)

    def by_value(self, step: str, rows: DataFrame, column: str, values: Collection[str]) -> DataFrame:
        """Counts rows by the value of a column, of which all values are known."""
        return self.watch(step, rows, {value: F.col(column) == value for value in values})

    def counts(self) -> list[tuple[str, str, int]]:
        """step, metric, n_rows; only of steps whose rows were written."""
        return [(step, name, n) for step, seen in self._watched.items() for name, n in seen.get.items()]

    def save(self, store, batch: int) -> DataFrame:
        rows = store.spark.createDataFrame(self.counts(), RUN_REPORT).coalesce(1)
        return store.append("control/run_report", rows, batch)
