"""Linked items: components of a graph, and comparison of all pairs within groups.

Used where items that may be alike share a group. Large groups are split into blocks that
meet pairwise, so no task holds more than two blocks; tasks give one row per item (its
number of links and one edge), never the pairs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airstrata.session import materialize

#: items of a block; a task compares two blocks at most
BLOCK = 120


def components(edges: DataFrame) -> DataFrame:
    """id, component (the smallest id that edges a-b lead to), for every id in an edge.

    Each round points every node at its smallest neighbour, follows the pointers to their
    ends and contracts the edges, which at least halves the nodes that still have edges. All
    steps are joins whose results are stored; the driver sees counts only.
    """
    plain = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    open_edges = materialize(plain.distinct(), "edges")
    nodes = open_edges.select(F.col("a").alias("id")).union(open_edges.select("b")).distinct()
    found = nodes.withColumn("component", F.col("id"))
    while open_edges.count():
        both = open_edges.union(open_edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        up = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("up"))
        up = materialize(up.select("id", F.least("id", "up").alias("up")), "pointers")
        while True:
            over = up.select(F.col("id").alias("up"), F.col("up").alias("next"))
            up = materialize(up.join(over, "up").select("id", F.col("next").alias("up"), (F.col("next") < F.col("up")).alias("moved")), "pointers")
            moved = up.filter("moved").limit(1).count()
            up = up.drop("moved")
            if not moved:
                break
        end = lambda name: up.select(F.col("id").alias(name), F.col("up").alias(f"_{name}"))
        ends = open_edges.join(end("a"), "a").join(end("b"), "b")
        ends = ends.filter("_a <> _b").select(F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b"))
        open_edges = materialize(ends.distinct(), "edges")
        found = found.join(end("component"), "component", "left")
        found = found.select("id", F.coalesce("_component", "component").alias("component"))
    return materialize(found, "components")


def in_blocks(rows: DataFrame, group: str, member: str, size: Column, most: int = BLOCK) -> DataFrame:
    """Adds task, whose rows must be compared, and side, the block of the row (0 or 1).

    A group of more than BLOCK rows is dealt by hash into blocks; every pair of blocks is a
    task, so each two rows meet. Rows of both sides meet each other only; in a task with one
    side all rows meet. With ``most`` above BLOCK, groups of more than 16 blocks have larger
    ones, of up to ``most`` rows, as each row is sent once for every block of its group.
    """
    blocks = F.ceil(size / F.greatest(F.lit(BLOCK), F.least(F.lit(most), F.ceil(size / 16))))
    own = F.pmod(F.xxhash64(member), blocks)
    rows = rows.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    low, high = F.least("_own", "_other"), F.greatest("_own", "_other")
    rows = rows.withColumn("task", F.xxhash64(group, low, high))
    return rows.withColumn("side", (F.col("_own") > F.col("_other")).cast("int")).withColumn(
        "lone", F.col("_own") == F.col("_other")
    )


def dealt_rows(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of a task next to each other, first column task, in a fixed order."""
    return rows.select("task", *columns).repartition("task").sortWithinPartitions("task", *columns[:2])


def whole_tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Regroups sorted batches so that no run of equal first columns is cut."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        last = int(np.searchsorted(keys != keys[-1], False)) if keys[0] == keys[-1] else int(np.flatnonzero(keys != keys[-1])[-1]) + 1
        if last or (kept and kept[-1].column(0)[-1].as_py() != keys[-1]):
            done = [*kept, batch.slice(0, last)]
            yield pa.Table.from_batches(done).combine_chunks().to_batches()[0]
            kept = []
        kept.append(batch.slice(last))
    if kept:
        yield pa.Table.from_batches(kept).combine_chunks().to_batches()[0]


def forest(count: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``count`` items the smallest item that links a-b lead to."""
    root = np.arange(count)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        for end in (a, b, root[a], root[b]):
            np.minimum.at(new, end, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def count_links(
    rows: DataFrame, payload: str, alike: Callable[[list], np.ndarray]
) -> DataFrame:
    """id, links (weights of the linked items), root (an edge), one row per item and task.

    ``rows`` has task, side, lone, id, weight and the payload; ``alike`` gives for the
    payloads of a task the matrix of which are linked.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_tasks(batches):
            keys = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1).tolist(), len(keys)]
            ids, links, roots = [], [], []
            for a, z in zip(cuts, cuts[1:], strict=False):
                own = batch.slice(a, z - a)
                side = own.column(1).to_numpy()
                name = own.column(2).to_numpy()
                lone = own.column(3)[0].as_py()
                weight = own.column(4).to_numpy()
                linked = alike(own.column(5).to_pylist())
                np.fill_diagonal(linked, False)
                if not lone:
                    linked &= side[:, None] != side[None, :]
                root = forest(len(name), *np.nonzero(np.triu(linked)))
                ids.append(name)
                links.append(linked @ weight)
                roots.append(name[root])
            yield pa.record_batch(
                [pa.array(np.concatenate(x).astype(np.int64)) for x in (ids, links, roots)],
                names=["id", "links", "root"],
            )

    dealt = dealt_rows(rows, ["side", "id", "lone", "weight", payload])
    return dealt.mapInArrow(task, "id long, links long, root long")


def exact_groups(candidates: DataFrame, items: DataFrame, payload: str, alike, most: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """All links within components of candidate edges a-b, and the components of these links.

    ``items``: id, weight, payload. First result: id, links; second: id, component.
    """
    guessed = components(candidates)
    sizes = guessed.groupBy("component").agg(F.count("*").alias("_size"))
    member = guessed.join(sizes, "component").join(items, "id")
    rows = in_blocks(member, "component", "id", F.col("_size"), most)
    counted = materialize(count_links(rows, payload, alike), "links")
    return (
        counted.groupBy("id").agg(F.sum("links").alias("links")),
        components(counted.select(F.col("id").alias("a"), F.col("root").alias("b"))),
    )
