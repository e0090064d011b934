"""The layers under their SQL names: views over the current versions, and the level function."""

from __future__ import annotations

from airstrata.config import LEVEL_BOUNDS, LEVEL_LABELS
from airstrata.operators.marts import LAYOUT
from airstrata.plans.medallion import Moment, gold, star
from airstrata.sources.store import Store

_DIMENSIONS = {"dim_date": "dates", "dim_time": "times", "dim_city": "cities", "dim_station": "stations"}


def level_function(name: str = "aqi_category") -> str:
    """The statement that defines the level of an index value as a SQL function."""
    cases = " ".join(
        f"WHEN aqi <= {bound} THEN '{label}'" for bound, label in zip(LEVEL_BOUNDS, LEVEL_LABELS)
    )
    return (
        f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(aqi DOUBLE) RETURNS STRING "
        f"RETURN CASE {cases} ELSE '{LEVEL_LABELS[-1]}' END"
    )


def register(store: Store, moment: Moment | None = None) -> None:
    """Make the star, the marts and the level function known to ``spark.sql``.

    The views show the versions that are current now, or those of ``moment``; call it again
    after a run. The optimizer inlines the function, so no row leaves the JVM.
    """
    silver = moment.star if moment else star(store)
    for view, field in _DIMENSIONS.items():
        getattr(silver, field).createOrReplaceTempView(view)
    silver.fact.createOrReplaceTempView("fact_aqi")
    for mart in LAYOUT:
        table = moment.marts[mart] if moment else gold(store, mart)
        table.createOrReplaceTempView(mart)
    store.spark.sql(level_function())
