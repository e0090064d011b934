from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from airstrata.llm import links


def brute_components(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        x, y = sorted((find(a), find(b)))
        up[y] = x
    return {x: find(x) for x in up}


def test_components(spark):
    rng = random.Random(1)
    edges = [(i, i + 1) for i in range(100, 160)]  # a path
    edges += [(200, 200 + i) for i in range(1, 50)]  # a star
    edges += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    edges += [(5, 5), (7, 6), (6, 7), (500, 7)]
    found = links.components(spark.createDataFrame(edges, "a long, b long"))
    want = {k: v for k, v in brute_components([e for e in edges if e[0] != e[1]]).items()}
    assert {r["id"]: r["component"] for r in found.collect()} == want


def test_no_edges(spark):
    assert links.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_every_pair_of_a_large_group_meets_once(spark):
    size = 3 * links.BLOCK + 17
    rows = spark.range(size).select("id", F.lit(1).alias("g"), F.lit(2).alias("weight"), (F.col("id") % 5).alias("p"))
    dealt = links.in_blocks(rows, "g", "id", F.lit(size)).withColumn("weight", F.col("weight").cast("long"))
    counted = links.count_links(dealt, "p", lambda p: np.equal.outer(np.array(p), np.array(p)))
    found = {r["id"]: r["n"] for r in counted.groupBy("id").agg(F.sum("links").alias("n")).collect()}
    assert found == {i: 2 * (len(range(i % 5, size, 5)) - 1) for i in range(size)}
    joined = links.components(counted.select(F.col("id").alias("a"), F.col("root").alias("b")))
    assert {r["id"]: r["component"] for r in joined.collect()} == {i: i % 5 for i in range(size)}


def test_tasks_are_never_cut():
    keys = [1, 1, 2, 3, 3, 3, 4, 4, 4, 4, 5]
    for size in (1, 2, 3, 4, 20):
        batches = [
            pa.record_batch([pa.array(keys[i : i + size]), pa.array(range(i, min(i + size, len(keys))))], names=["task", "x"])
            for i in range(0, len(keys), size)
        ]
        found = [b.column(0).to_pylist() for b in links.whole_tasks(iter(batches))]
        assert [k for f in found for k in f] == keys
        assert all(not set(a) & set(b) for a, b in zip(found, found[1:], strict=False))


def test_forest():
    root = links.forest(7, np.array([5, 2, 3, 6]), np.array([6, 3, 1, 5]))
    assert root.tolist() == [0, 1, 1, 1, 4, 5, 5]
