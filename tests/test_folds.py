"""Folding the batches of appended tables."""

from __future__ import annotations

from datetime import timedelta

import pytest

from airstrata.plans.medallion import FOLDABLE, as_of, fold_batches, load_silver, setup, star
from airstrata.schemas import TABLES
from airstrata.session import glob_paths
from tests.stars import SCHEMA
from tests.test_parts import DAYS, months
from tests.test_runs import CONFIG, LOAD, rows

NAME = "silver/plain"


def table(spark, values):
    return spark.createDataFrame(values, "k int, x string")


def folders(store, name=NAME):
    return sorted(int(p.split("=")[-1]) for p in glob_paths(store.spark, f"{store.path(name)}/batch_id=*"))


def test_a_replay_between_fold_and_delete_counts_once(spark, store):
    batches = {b: table(spark, [(b, "a"), (b, "a"), (b, None)]) for b in (1, 2, 3, 4)}
    for b, part in batches.items():
        store.append(NAME, part, b)
    every = rows(store.appended(NAME))
    assert store.fold(NAME, 2).count() == 6
    assert rows(store.appended(NAME)) == every
    store.append(NAME, batches[2], 2)
    assert rows(store.appended(NAME)) == every
    store.expire_folded(NAME)
    assert folders(store) == [3, 4] and rows(store.appended(NAME)) == every
    # a replay after the delete neither
    store.append(NAME, batches[1], 1)
    assert rows(store.appended(NAME)) == every


def test_each_fold_holds_the_batches_behind_the_one_before(spark, store):
    for b in (1, 2, 3, 4, 5):
        store.append(NAME, table(spark, [(b, "a")]), b)
    assert store.fold(NAME, 2).count() == 2
    assert store.fold(NAME, 4).count() == 2
    assert store.fold(NAME, 3) is None
    store.expire_folded(NAME)
    assert store.folds(NAME) == [2, 4] and folders(store) == [5]
    for upto in range(1, 6):
        assert store.appended(NAME, upto=upto).count() == upto
        assert [r["k"] for r in store.batch(NAME, upto, "k int, x string").collect()] == [upto]
    assert store.fold(NAME, 5).count() == 1
    store.expire_folded(NAME)
    assert folders(store) == [] and store.appended(NAME).count() == 5


def test_a_fold_that_died_is_not_read_and_run_again(spark, store):
    for b in (1, 2):
        store.append(NAME, table(spark, [(b, "a")]), b)
    broken = table(spark, [(9, "broken")]).selectExpr("*", "1 AS batch_id")
    without_mark = "mapreduce.fileoutputcommitter.marksuccessfuljobs"
    broken.write.option(without_mark, "false").parquet(f"{store.path(NAME)}.folded/v=2")
    assert store.folds(NAME) == []
    assert [r["k"] for r in store.appended(NAME).orderBy("k").collect()] == [1, 2]
    assert store.fold(NAME, 2).count() == 2
    assert [r["k"] for r in store.appended(NAME).orderBy("k").collect()] == [1, 2]


def test_tables_that_are_missing_or_loaded_in_pieces(spark, store):
    assert store.fold("silver/none", 3) is None and store.appended("silver/none") is None
    store.expire_folded("silver/none")
    store.append(NAME, table(spark, [(1, "a")]), 1, load="first")
    with pytest.raises(ValueError, match="several loads"):
        store.fold(NAME, 1)
    assert store.appended(NAME).count() == 1


def test_moments_and_the_star_outlive_a_fold(spark, store):
    setup(store, CONFIG)
    frame = lambda values: spark.createDataFrame(values, SCHEMA)
    loads = [frame(months(DAYS, m)) for m in (1, 2, 3)]
    for batch, part in enumerate(loads, 1):
        load_silver(store, part, batch, LOAD + timedelta(days=batch))
    before, then = rows(star(store).fact), rows(as_of(store, LOAD + timedelta(days=1)).star.fact)
    fold_batches(store, 2)
    for name in FOLDABLE:
        store.expire_folded(name)
    assert folders(store, "silver/fact_aqi") == [3]
    assert rows(star(store).fact) == before
    assert rows(as_of(store, LOAD + timedelta(days=1)).star.fact) == then
    # a batch replayed through all steps gives the same star
    load_silver(store, loads[1], 2, LOAD + timedelta(days=2))
    assert rows(star(store).fact) == before
    again = store.batch("silver/fact_aqi", 2, TABLES["silver/fact_aqi"])
    assert again.count() == len(DAYS)
    with pytest.raises(ValueError, match="not loaded yet"):
        fold_batches(store, 4)
