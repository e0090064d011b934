"""Embedding near-duplicates by sorted projection passes.

Each pass hashes a vector by 64 random hyperplanes, one bit each, and orders the vectors
of a label lexicographically by these bits; vectors at a small angle agree on a long
prefix in some pass and come to lie within a bounded window. Pairs in a window are compared
by 512-bit signatures of their signs, with a margin of four standard deviations, and the
pairs of all passes are united. Within each united group all pairs are then verified by their
cosine in double precision, in blocks, so the bound of the window costs no link of a large
group.

How far a window reaches is measured. The ``window + 1``-th neighbours of a row in a pass
tell the prefix that nobody outside its window shares; a pair at the threshold agrees on it
with a known probability. A row is done once its passes together find such a pair with
probability ``recall``. The first passes follow from the largest label, as if its vectors
spread evenly. Rows that are not done then go on with further passes, or, where their label
is so crowded that these would cost more, are one group: all their pairs are verified.

Exact copies (equal label and vector) are one class and are not expanded into pairs.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components,
those without label and those without vec_id link with nothing; vectors of different length
never link; rows that repeat a vec_id count as vectors of their own; an empty table gives no
rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from airstrata.llm.links import exact_groups, forest, whole_tasks
from airstrata.operators.ordering import global_index
from airstrata.session import materialize


@dataclass(frozen=True)
class DedupConfig:
    threshold: float = 0.93
    window: int = 32
    recall: float = 0.9999
    seed: int = 11

    def passes(self, largest: int) -> int:
        """Passes after which a pair at the threshold was within a window, by its prefix."""
        agree = 1 - math.acos(self.threshold) / math.pi
        once = agree ** max(0.0, math.log2(max(largest, 1) / self.window))
        return max(1, math.ceil(math.log(1 - self.recall) / math.log(1 - min(once, 0.999))))

    @property
    def need(self) -> float:
        """Credit (-log of the chance that all passes miss) with which a row is done."""
        return -math.log(1 - self.recall)

    @property
    def most_bits(self) -> int:
        """Signature bits in which a pair at the threshold differs at most."""
        differ = math.acos(self.threshold) / math.pi
        return math.ceil(SIGNATURE * differ + 4 * math.sqrt(SIGNATURE * differ * (1 - differ)))


SIGNATURE = 512
#: a pass costs a row about as much as so many comparisons
PASS_COST = 1500
#: parts that the rows of a label are dealt into where they meet its figures
SALTS = 64
#: vectors of a block at most, where groups are verified
MOST = 1024
#: passes of a further round at most
ROUND = 32


def _signs(vectors: np.ndarray, count: int, seed: int) -> np.ndarray:
    planes = np.random.Generator(np.random.Philox(seed)).standard_normal((vectors.shape[1], count))
    return np.packbits(vectors @ planes > 0, axis=1)


def _hashes(reps: DataFrame, passes: int, config: DedupConfig, turn: int = 0) -> DataFrame:
    """id, label, signature and the sort key of every pass; each ``turn`` has its own hyperplanes."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.column(2).to_pylist()
            signature, keys = [b""] * len(rows), [None] * len(rows)
            by_length: dict[int, list[int]] = {}
            for i, row in enumerate(rows):
                by_length.setdefault(len(row), []).append(i)
            for at in by_length.values():
                vectors = np.array([rows[i] for i in at], dtype=float)
                marks = _signs(vectors, SIGNATURE, config.seed)
                bits = _signs(vectors, 64 * passes, config.seed + 1 + turn)
                # big-endian words with the top bit flipped sort as signed numbers like their bits
                order = bits.reshape(len(at), passes, 8).view(">u8")[..., 0] ^ np.uint64(1 << 63)
                for i, mark, key in zip(at, marks, order.astype(np.uint64).view(np.int64), strict=True):
                    signature[i], keys[i] = mark.tobytes(), key
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(signature, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["id", "set", "signature", "keys"],
            )

    return reps.select("id", "set", "embedding").mapInArrow(task, "id long, set long, signature binary, keys array<long>")


def _window_pairs(run: np.ndarray, marks: np.ndarray, window: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places of rows of the same run at most ``window`` apart whose signatures are near."""
    left, right = [], []
    for step in range(1, min(window, len(run) - 1) + 1):
        same = np.flatnonzero(run[:-step] == run[step:])
        near = same[np.bitwise_count(marks[same] ^ marks[same + step]).sum(axis=1) <= most]
        left.append(near)
        right.append(near + step)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *left]), np.concatenate([none, *right])


def _read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    run, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    marks = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint64).reshape(len(ids), SIGNATURE // 64)
    return run, ids, marks


def _edges(run, ids, marks, config: DedupConfig):
    """One edge per row that is not the first of its linked rows."""
    a, b = _window_pairs(run, marks, config.window, config.most_bits)
    root = forest(len(ids), a, b)
    tied = np.flatnonzero(root != np.arange(len(ids)))
    return ids[tied], ids[root[tied]]


def _credits(run: np.ndarray, keys: np.ndarray, low: int, high: int, config: DedupConfig) -> np.ndarray:
    """What a pass adds to the credit of rows ``low`` to ``high`` of the sorted rows of a task.

    A neighbour outside the rows at hand is unknown, so its row gets nothing, unless the run
    of the row ends before.
    """
    at, w = np.arange(low, high), config.window + 1

    def shared(other: np.ndarray, edge: int) -> np.ndarray:
        """Leading bits shared with the row at ``other``; -1 in another run, 64 if unknown."""
        there = np.clip(other, 0, len(run) - 1)
        differ = (keys[at] ^ keys[there]).view(np.uint64)
        top, rest = (differ >> np.uint64(32)).astype(float), (differ & np.uint64(0xFFFFFFFF)).astype(float)
        bits = 64 - np.where(top > 0, 32 + np.frexp(top)[1], np.frexp(rest)[1])
        bits = np.where(other == there, bits, 64)
        return np.where(run[at] == run[np.where(other == there, there, edge)], bits, -1)

    prefix = 1 + np.maximum(shared(at - w, 0), shared(at + w, len(run) - 1))
    found = np.where(prefix > 64, 0.0, (1 - math.acos(config.threshold) / math.pi) ** prefix)
    return -np.log1p(-np.minimum(found, 0.99999))


def candidate_edges(hashed: DataFrame, config: DedupConfig) -> tuple[DataFrame, DataFrame]:
    """a, b: spanning edges of all window pairs of all passes, over partition borders too.

    Second result: id, credit, summed over the passes.
    """
    rows = hashed.select("id", "set", "signature", F.posexplode("keys").alias("pass", "key"))
    rows = rows.withColumn("run", F.xxhash64("pass", "set"))
    placed = rows.repartitionByRange("run", "key", "id").sortWithinPartitions("run", "key", "id")
    placed = placed.select("run", "id", "signature", "key")

    def out(border, run, a, b, marks, credit=None) -> pa.RecordBatch:
        arrays = [
            pa.array(np.broadcast_to(border, len(a)).astype(np.int64)),
            pa.array(run.astype(np.int64)),
            pa.array(a),
            pa.array(b),
            pa.array([m.tobytes() for m in marks] if marks is not None else [None] * len(a), pa.binary()),
            pa.array(credit if credit is not None else [None] * len(a), pa.float64()),
        ]
        return pa.record_batch(arrays, names=["border", "run", "a", "b", "signature", "credit"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, w = TaskContext.get().partitionId(), config.window
        kept, head = None, None
        # the last rows, with their keys; those of them that still wait for neighbours behind
        tail, waiting = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            now = _read(batch)
            sorted_rows = now[0], now[1], batch.column(3).to_numpy()
            if kept is None:
                head = tuple(x[:w] for x in now)
            else:
                if len(head[0]) < w:
                    head = tuple(np.concatenate([x, y])[:w] for x, y in zip(head, now, strict=True))
                now = tuple(np.concatenate([x, y]) for x, y in zip(kept, now, strict=True))
                sorted_rows = tuple(np.concatenate([x, y]) for x, y in zip(tail, sorted_rows, strict=True))
            a, b = _edges(*now, config)
            yield out(-1, np.zeros(len(a)), a, b, None)
            kept = tuple(x[-w:] for x in now)
            low, high = (0 if tail is None else len(tail[0])) - waiting, max(0, len(sorted_rows[0]) - w - 1)
            if high > low:
                ids, credit = sorted_rows[1][low:high], _credits(sorted_rows[0], sorted_rows[2], low, high, config)
                yield out(-2, np.zeros(len(ids)), ids, ids, None, credit)
            waiting = len(sorted_rows[0]) - max(low, high)
            tail = tuple(x[-(waiting + w + 1) :] for x in sorted_rows)
        if kept is not None:
            ids = tail[1][-waiting:]
            credit = _credits(tail[0], tail[2], len(tail[0]) - waiting, len(tail[0]), config)
            yield out(-2, np.zeros(len(ids)), ids, ids, None, credit)
            # what lies near either end of the partition meets the neighbours' ends again
            for border, place, (run, ids, marks) in ((part, 0, kept), (part - 1, 1, head)):
                yield out(border, run, ids, np.arange(len(ids)) + place * w, marks)

    schema = "border long, run long, a long, b long, signature binary, credit double"
    found = materialize(placed.mapInArrow(task, schema), "window-pairs")

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_tasks(batches):
            border = batch.column(0).to_numpy()
            for at in np.unique(border):
                own = batch.filter(pa.array(border == at))
                run, ids, marks = _read(own.select([1, 2, 4]))
                a, b = _edges(run, ids, marks, config)
                yield pa.record_batch([pa.array(a), pa.array(b)], names=["a", "b"])

    ends = found.filter("border >= 0").repartition("border").sortWithinPartitions("border", "b")
    edges = found.filter("border = -1 AND run = 0").select("a", "b").union(ends.mapInArrow(meet, "a long, b long"))
    credits = found.filter("credit IS NOT NULL").groupBy(F.col("a").alias("id")).agg(F.sum("credit").alias("credit"))
    return edges, credits


def proposed(classes: DataFrame, config: DedupConfig) -> DataFrame:
    """a, b: edges that lead from each of the classes (id, set, embedding) to all it is linked to."""
    left = classes.select("id", "set", "embedding", F.lit(0.0).alias("credit"))
    edges, turn = None, 0
    passes = config.passes(classes.groupBy("set").count().agg(F.max("count")).first()[0] or 0)
    while True:
        hashed = materialize(_hashes(left, passes, config, turn), "hashed")
        found, credits = candidate_edges(hashed, config)
        found = materialize(found, "candidates")
        edges = found if edges is None else edges.union(found)
        credits = credits.select(F.col("id").alias("_id"), F.col("credit").alias("_new"))
        left = left.join(credits, F.col("id") == F.col("_id"), "left").drop("_id")
        left = left.withColumn("_new", F.coalesce("_new", F.lit(0.0))).withColumn("credit", F.col("credit") + F.col("_new"))
        left = materialize(left, "crowded")
        lacks = F.col("credit") < config.need
        crowds = left.groupBy(F.col("set").alias("_set")).agg(
            F.count("*").alias("_all"),
            F.count(F.when(lacks, 1)).alias("_rows"),
            F.min(F.when(lacks, F.col("id"))).alias("_first"),
            F.avg(F.when(lacks, F.lit(config.need) - F.col("credit"))).alias("_lack"),
            (F.avg(F.when(lacks, F.col("_new"))) / passes).alias("_gain"),
        )
        # a set that fits into a window is done
        crowds = crowds.filter((F.col("_all") > config.window + 1) & (F.col("_rows") > 0))
        further = F.col("_lack") / F.nullif("_gain", F.lit(0.0))
        compare = F.coalesce(further * PASS_COST > F.col("_rows"), F.lit(True))
        crowds = crowds.select("_set", "_first", further.alias("_further"), compare.alias("_compare"))
        crowds = materialize(crowds, "crowds")
        # salted, so that the rows of a large set do not land in one task
        salted = crowds.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = left.filter(lacks).withColumn("_own", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
        crowded = rows.join(salted, (F.col("set") == F.col("_set")) & (F.col("_own") == F.col("_salt")))
        edges = edges.union(crowded.filter("_compare").select(F.col("id").alias("a"), F.col("_first").alias("b")))
        longest = crowds.filter("NOT _compare").agg(F.max("_further")).first()[0]
        if longest is None:
            return edges
        passes, turn = min(ROUND, math.ceil(longest)), turn + 1
        left = crowded.filter("NOT _compare").select("id", "set", "embedding", "credit")


def _near(threshold: float):
    def alike(vectors: list) -> np.ndarray:
        x = np.array(vectors, dtype=float)
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        return x @ x.T >= threshold

    return alike


def near_duplicates(embeddings: DataFrame, config: DedupConfig | None = None) -> DataFrame:
    """vec_id, n_links, component_id, kept, one row per vector."""
    config = config or DedupConfig()
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = (
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False))
        & F.coalesce(F.exists(vector, lambda x: x != 0), F.lit(False))
    )
    key = F.when(usable, F.md5(F.concat_ws("|", F.col("label").cast("string"), F.col("embedding").cast("string"))))
    rows = embeddings.select("vec_id", "label", vector.alias("embedding"), key.alias("key"))
    classes = rows.filter("key IS NOT NULL").groupBy("key").agg(
        F.min("vec_id").alias("rep"),
        F.count("*").alias("weight"),
        F.first("label").alias("label"),
        F.first("embedding").alias("embedding"),
    )
    # scaled so that no square overflows; the cosine stays the same
    peak = F.array_max(F.transform("embedding", F.abs))
    classes = classes.withColumn("embedding", F.transform("embedding", lambda x: x / peak))
    classes = classes.withColumn("set", F.xxhash64("label", F.size("embedding")))
    classes = global_index(classes, ["rep", "key"], "id")
    classes = materialize(classes, "classes")
    items = classes.select("id", "weight", "embedding")
    links, groups = exact_groups(proposed(classes, config), items, "embedding", _near(config.threshold), MOST)
    names = classes.select(F.col("id").alias("component"), F.col("rep").alias("component_id"))
    solved = classes.select("id", "key", "weight").join(links, "id", "left").join(groups, "id", "left")
    solved = solved.withColumn("component", F.coalesce("component", "id")).join(names, "component")
    solved = solved.select(
        "key", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component_id"
    )
    component = F.coalesce("component_id", "vec_id")
    return rows.select("vec_id", "key").join(solved, "key", "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept"),
    )
