"""Near-duplicate documents by a chosen-path similarity join on word shingles.

A document is the set of its runs of five words (words: white-space separated, in lower
case; a text with fewer words is one shingle). Documents with the same set are one class.
A class is embedded as 128 minwise values, one token per coordinate.

The join runs a forest of random trees. The root of each splits all classes by their value
at a coordinate of its own. In every further node each coordinate is chosen with
probability 1 / (0.8 * 128), by the hash of the node, and the classes of the node are split
by their value there, once per chosen coordinate, so a path is a sequence of shared
tokens. Nodes of up to ``bucket`` classes are compared. Of larger ones parts are compared
first; where that joins all but ``apart`` classes, as in a group of near copies, these few
are compared with the whole node. Others are split again, up to ``depth`` times. What is
still large then is compared too, in blocks that meet pairwise, so no bucket is dropped. The
number of trees is the one that finds a pair at the threshold with probability ``recall``
when its path needs all ``depth`` splits.

Buckets are compared by the share of equal coordinates, four standard deviations below
the threshold, and give one edge per class. Within each group that these edges join, all
pairs are verified by their exact Jaccard similarity over whole shingle sets, again in
blocks; pairs are counted, never listed.

Defined cases: a text that is null or has no words links with nothing and is kept; repeated
rows are copies; rows that share a doc_id but not the shingles are documents of their own;
a null doc_id comes before all others, and the group of a null id is null; an empty table
gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airstrata.llm.common import map_texts, text_key, text_slices
from airstrata.llm.links import BLOCK, components, dealt_rows, exact_groups, forest, in_blocks, whole_tasks
from airstrata.operators.ordering import global_index
from airstrata.session import materialize

COORDINATES = 128


@dataclass(frozen=True)
class JoinConfig:
    words: int = 5
    threshold: float = 0.8
    recall: float = 0.9999
    bucket: int = 120
    depth: int = 4
    seed: int = 5
    #: so many classes of a large node may be in no component with the others for it to be settled
    apart: int = 480

    @property
    def choice(self) -> float:
        return 1 / (self.threshold * COORDINATES)

    @property
    def trees(self) -> int:
        """A pair shares the root's coordinate with the threshold's chance; further splits keep it by any."""
        alive = 1.0
        for _ in range(self.depth - 1):
            alive = 1 - (1 - self.choice * alive * self.threshold) ** COORDINATES
        return math.ceil(math.log(1 - self.recall) / math.log(1 - self.threshold * alive))

    @property
    def least_equal(self) -> int:
        """Equal coordinates that a pair at the threshold has nearly surely."""
        spread = math.sqrt(self.threshold * (1 - self.threshold) * COORDINATES)
        return math.floor(self.threshold * COORDINATES - 4 * spread)


def _mix(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    split = [t.lower().split() for t in texts]
    counts = np.array([len(s) for s in split], dtype=np.int64)
    flat = [w for s in split for w in s]
    if not flat:
        return [np.zeros(0, np.uint64)] * len(texts)
    hashed = pd.util.hash_array(np.array(flat, dtype=object))
    # row i: hash of the words i to i + words - 1; shingles that leave their text are not read
    rolled = np.zeros(len(hashed), np.uint64)
    for k in range(words):
        rolled[: len(hashed) - k] += hashed[k:] * np.uint64(0x9E3779B97F4A7C15 + 2 * k * 0x632BE59BD9B4E019 & (2**64 - 1))
    rolled = _mix(rolled)
    sets, end = [], 0
    for n in counts.tolist():
        begin, end = end, end + n
        if n >= words:
            sets.append(np.unique(rolled[begin : end - words + 1]))
        elif n:
            short = xxhash.xxh3_64_intdigest(hashed[begin:end].tobytes(), seed=n)
            sets.append(np.array([short], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def minwise(shingles: np.ndarray, seed: int) -> np.ndarray:
    """The smallest of the shingles' hashes under each of the coordinates' hash functions."""
    numbers = np.random.Generator(np.random.Philox(seed)).integers(0, 1 << 63, (2, COORDINATES), dtype=np.uint64)
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for low in range(0, len(shingles), 4096):
        hashed = (shingles[low : low + 4096, None] ^ numbers[0]) * (numbers[1] | np.uint64(1))
        least = np.minimum(least, (hashed ^ (hashed >> np.uint64(32))).min(axis=0))
    return least


def _set_key(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def root_choices(config: JoinConfig) -> list[tuple[int, int]]:
    """(tree, coordinate) of the roots: different coordinates, while there are as many as trees."""
    rng = np.random.Generator(np.random.Philox(config.seed + 1))
    rounds = [rng.permutation(COORDINATES) for _ in range(0, config.trees, COORDINATES)]
    return list(enumerate(np.concatenate(rounds)[: config.trees].tolist()))


def embed(documents: DataFrame, config: JoinConfig) -> DataFrame:
    """doc_id, key, set_key (null without words), tokens (16 bits of each), nodes (first level)."""
    roots = root_choices(config)
    tree = np.array([t for t, _ in roots], np.uint64)
    at = np.array([c for _, c in roots], np.int64)
    schema = T.StructType(
        [
            documents.schema["doc_id"],
            T.StructField("key", T.StringType()),
            T.StructField("set_key", T.BinaryType()),
            T.StructField("tokens", T.BinaryType()),
            T.StructField("nodes", T.ArrayType(T.LongType())),
        ]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for a, z in text_slices(texts):
                keys, tokens, nodes = [], [], []
                for shingles in shingle_sets(texts[a:z], config.words):
                    if not len(shingles):
                        keys.append(None), tokens.append(None), nodes.append(None)
                        continue
                    least = minwise(shingles, config.seed)
                    keys.append(_set_key(shingles))
                    tokens.append((least & np.uint64(0xFFFF)).astype("<u2").tobytes())
                    path = _mix(least[at] + _mix(tree * np.uint64(COORDINATES) + at.astype(np.uint64)))
                    nodes.append(path.view(np.int64))
                yield pa.record_batch(
                    [
                        batch.column(0).slice(a, z - a),
                        batch.column(1).slice(a, z - a),
                        pa.array(keys, pa.binary()),
                        pa.array(tokens, pa.binary()),
                        pa.array(nodes, pa.list_(pa.int64())),
                    ],
                    names=schema.names,
                )

    given = documents.select("doc_id", text_key(F.col("text")).alias("key"), "text")
    return map_texts(given, task, schema)


def _split(rows: DataFrame, config: JoinConfig) -> DataFrame:
    """id, node: the children of rows (id, node, tokens) by the coordinates their nodes choose."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        column = np.arange(COORDINATES, dtype=np.uint64)
        bound = np.uint64(int(config.choice * 2**64))
        for batch in batches:
            ids, nodes = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            tokens = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<u2").reshape(len(ids), COORDINATES)
            chance = _mix(nodes[:, None] ^ _mix(column + np.uint64(1 << 40)))
            row, at = np.nonzero(chance < bound)
            children = _mix(chance[row, at] + tokens[row, at].astype(np.uint64))
            yield pa.record_batch([pa.array(ids[row]), pa.array(children.view(np.int64))], names=["id", "node"])

    return rows.select("id", "node", "tokens").mapInArrow(task, "id long, node long")


def _bucket_edges(rows: DataFrame, config: JoinConfig) -> DataFrame:
    """a, b: spanning edges of the pairs of each task whose tokens agree often enough.

    A task with one block gives the edges within it. A task with two blocks gives only
    what joins parts that are not yet joined within either, so a group of many blocks
    gives about one edge per item and one per pair of blocks.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_tasks(batches):
            run, ids = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            tokens = np.frombuffer(b"".join(batch.column(2).to_pylist()), "<u2").reshape(len(ids), COORDINATES)
            side, lone = batch.column(3).to_numpy(), batch.column(4).to_numpy(zero_copy_only=False)
            left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for step in range(1, len(run)):
                same = np.flatnonzero(run[:-step] == run[step:])
                if not len(same):
                    break
                for part in np.array_split(same, len(same) // 20_000 + 1):
                    equal = (tokens[part] == tokens[part + step]).sum(axis=1)
                    left.append(part[equal >= config.least_equal])
                    right.append(left[-1] + step)
            a, b, every = np.concatenate(left), np.concatenate(right), np.arange(len(ids))
            inside = side[a] == side[b]
            own = forest(len(ids), a[inside], b[inside])
            joined = forest(len(ids), own[a[~inside]], own[b[~inside]])
            root = np.where(lone, own, np.where(own == every, joined, every))
            tied = np.flatnonzero(root != every)
            yield pa.record_batch([pa.array(ids[tied]), pa.array(ids[root[tied]])], names=["a", "b"])

    return dealt_rows(rows, ["id", "tokens", "side", "lone"]).mapInArrow(task, "a long, b long")


def _parted(rows: DataFrame) -> DataFrame:
    """Large nodes in parts of about BLOCK rows, each compared by itself: a first look at who is joined."""
    blocks = F.ceil(F.col("_size") / BLOCK)
    rows = rows.withColumn("task", F.xxhash64("node", F.pmod(F.xxhash64("node", "id"), blocks)))
    return rows.withColumn("side", F.lit(0)).withColumn("lone", F.lit(True))


def _in_components(large: DataFrame, joined: DataFrame) -> DataFrame:
    """Adds component to the rows of large nodes: looked up once per class, not in every tree."""
    held = large.groupBy("id").agg(F.collect_list(F.struct("node", "_size")).alias("_nodes"), F.first("tokens").alias("tokens"))
    held = held.join(joined, "id", "left").withColumn("component", F.coalesce("component", "id"))
    rows = held.select("id", "tokens", "component", F.explode("_nodes").alias("_node"))
    return rows.select("_node.node", "id", "_node._size", "tokens", "component")


def _rest(rows: DataFrame) -> DataFrame:
    """node, most (the component with most rows of the node), rest (how many rows are apart from it)."""
    held = rows.groupBy("node", "component").agg(F.count("*").alias("_held"))
    of = held.groupBy("node").agg(F.sum("_held").alias("_all"), F.max(F.struct("_held", "component")).alias("_most"))
    return of.select("node", F.col("_most.component").alias("most"), (F.col("_all") - F.col("_most._held")).alias("rest"))


def _rest_tasks(rows: DataFrame) -> DataFrame:
    """Each row that is apart with all of its node; the others, which are joined, once.

    A part has as many rows as are apart, so a node makes about two rows for each of its own.
    """
    blocks = F.ceil(F.col("_size") / F.greatest(F.lit(BLOCK), "rest"))
    own, everywhere = F.pmod(F.xxhash64("node", "id"), blocks), F.sequence(F.lit(0).cast("long"), blocks - 1)
    apart = F.col("component") != F.col("most")
    rows = rows.withColumn("_block", F.explode(F.when(apart, everywhere).otherwise(F.array(own))))
    return rows.withColumn("task", F.xxhash64("node", "_block")).withColumn("side", F.lit(0)).withColumn("lone", F.lit(True))


def candidate_edges(classes: DataFrame, config: JoinConfig) -> DataFrame:
    """a, b: edges between classes (id, tokens, nodes) that met in a bucket of some tree.

    Only what the edges join counts, so classes that are joined already need not meet again.
    Of a large node, parts are compared first. If all but ``apart`` of its classes are in one
    component then, these few are compared with the whole node, which settles it: a group of
    near copies costs each tree a few rows per class. Other large nodes are split.
    """
    tokens = classes.select("id", "tokens")
    rows = classes.select("id", F.explode("nodes").alias("node"))
    edges = None
    for level in range(1, config.depth + 1):
        if level > 1:
            rows = materialize(rows, "paths")
        sizes = rows.groupBy("node").agg(F.count("*").alias("_size")).filter("_size > 1")
        met = materialize(rows.join(sizes, "node").join(tokens, "id"), "nodes")
        # the same pair of classes may meet in many trees
        meet = lambda tasks: materialize(_bucket_edges(tasks, config).distinct(), "met")
        dealt = ["task", "id", "tokens", "side", "lone"]
        small = in_blocks(met.filter(F.col("_size") <= config.bucket), "node", "id", F.col("_size"))
        large = met.filter(F.col("_size") > config.bucket)
        found = meet(small.select(*dealt).union(_parted(large).select(*dealt)))
        edges = found if edges is None else edges.union(found)
        if not large.limit(1).count():
            break
        joined = components(edges)
        large = materialize(_in_components(large, joined), "large")
        nodes = materialize(_rest(large), "rest")
        edges = joined.select(F.col("id").alias("a"), F.col("component").alias("b"))
        settled = large.join(nodes.filter(F.col("rest").between(1, config.apart)), "node")
        edges = edges.union(meet(_rest_tasks(settled).select(*dealt)))
        unsettled = nodes.filter(F.col("rest") > config.apart)
        if not unsettled.limit(1).count():
            break
        large = large.join(unsettled.select("node"), "node", "left_semi")
        if level == config.depth:
            edges = edges.union(meet(in_blocks(large, "node", "id", F.col("_size"))))
            break
        rows = _split(large, config)
    return edges


def _jaccard(threshold: float, columns: int = 16_384):
    """Which sets of a task are alike: intersections by products over parts of the shingles."""

    def alike(sets: list[bytes]) -> np.ndarray:
        shingles = [np.frombuffer(s, np.uint64) for s in sets]
        sizes = np.array([len(s) for s in shingles])
        owner = np.repeat(np.arange(len(sets)), sizes)
        values, place, times = np.unique(np.concatenate(shingles), return_inverse=True, return_counts=True)
        shared = np.cumsum(times > 1) - 1
        keep = (times > 1)[place]
        owner, place = owner[keep], shared[place[keep]]
        order = np.argsort(place, kind="stable")
        owner, place = owner[order], place[order]
        common = np.zeros((len(sets), len(sets)), np.float64)
        for low in range(0, int(place[-1]) + 1 if len(place) else 0, columns):
            a, z = np.searchsorted(place, [low, low + columns])
            held = np.zeros((len(sets), min(columns, int(place[-1]) + 1 - low)), np.float32)
            held[owner[a:z], place[a:z] - low] = 1
            common += held @ held.T
        union = sizes[:, None] + sizes[None, :] - common
        # 0.8 of a whole number of shingles, without rounding
        return common * 10_000 >= np.round(threshold * 10_000) * union

    return alike


def _sets(documents: DataFrame, classes: DataFrame, config: JoinConfig) -> DataFrame:
    """id, weight, shingles of the given classes, from the text of one of their documents."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column(2).to_pylist()]
            for a, z in text_slices(texts):
                sets = [s.tobytes() for s in shingle_sets(texts[a:z], config.words)]
                yield pa.record_batch(
                    [batch.column(0).slice(a, z - a), batch.column(1).slice(a, z - a), pa.array(sets, pa.binary())],
                    names=["id", "weight", "shingles"],
                )

    texts = documents.select(_name(F.col("doc_id"), text_key(F.col("text"))).alias("_name"), "text")
    one = texts.join(classes.select("id", "weight", "name"), F.col("_name") == F.col("name"))
    one = one.dropDuplicates(["_name"])
    return map_texts(one.select("id", "weight", "text"), task, "id long, weight long, shingles binary")


def _name(doc_id, key):
    """Names a document by id and text; never null."""
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), key)


def near_duplicates(documents: DataFrame, config: JoinConfig | None = None) -> DataFrame:
    """doc_id, key, class_id, n_links, group_id, kept, one row per document row.

    n_links counts the other documents that are alike, copies included. ``key`` is the MD5 of
    the text. One document of each group is kept (one row, where rows are repeated).
    """
    config = config or JoinConfig()
    embedded = materialize(embed(documents, config), "embedded")
    # one document stands for its class: the first by id and text
    first = F.struct(F.col("doc_id").isNotNull().alias("has_id"), "doc_id", "key")
    classes = embedded.filter("set_key IS NOT NULL").groupBy("set_key").agg(
        F.min(first).alias("first"),
        F.count("*").alias("weight"),
        F.first("tokens").alias("tokens"),
        F.first("nodes").alias("nodes"),
    )
    classes = classes.select("set_key", "first.doc_id", "first.key", "weight", "tokens", "nodes")
    classes = global_index(classes, ["doc_id", "key", "set_key"], "id")
    classes = materialize(classes.withColumn("name", _name(F.col("doc_id"), F.col("key"))), "classes")
    edges = materialize(candidate_edges(classes, config), "candidates")
    tied = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
    items = _sets(documents, classes.select("id", "weight", "name").join(tied, "id"), config)
    items = materialize(items, "shingles")
    links, groups = exact_groups(edges, items, "shingles", _jaccard(config.threshold))
    names = classes.select(F.col("id").alias("component"), F.col("doc_id").alias("group_id"), F.col("name").alias("_first"))
    solved = classes.select("set_key", F.col("doc_id").alias("class_id"), "weight", "id", "name")
    solved = solved.join(links, "id", "left").join(groups, "id", "left")
    solved = solved.withColumn("component", F.coalesce("component", "id")).join(names, "component")
    solved = solved.select(
        F.col("set_key").alias("_set"), "class_id", "group_id", "_first",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
    )
    rows = embedded.select("doc_id", "key", "set_key")
    joined = rows.join(solved, rows["set_key"] == solved["_set"], "left")
    alone = F.col("set_key").isNull()
    first_row = F.col("_first") == _name(F.col("doc_id"), F.col("key"))
    return joined.select(
        "doc_id",
        "key",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("group_id")).alias("group_id"),
        F.when(alone, F.lit(True)).otherwise(first_row).alias("kept"),
    )


def deduplicate(documents: DataFrame, config: JoinConfig | None = None) -> DataFrame:
    """The documents without near duplicates: of each group the document with the smallest id."""
    decided = near_duplicates(documents, config)
    keep = decided.filter("kept").select(_name(F.col("doc_id"), F.col("key")).alias("_keep")).distinct()
    # rows without words are no copies of each other; repeated rows with words are
    words = F.regexp_count(F.coalesce("text", F.lit("")), F.lit(r"\S")) > 0
    marked = documents.select(
        F.struct("*").alias("row"), _name(F.col("doc_id"), text_key(F.col("text"))).alias("_name"), words.alias("_words")
    )
    kept = marked.join(keep, F.col("_name") == F.col("_keep"), "left_semi")
    once = kept.filter("_words").dropDuplicates(["_name"])
    return once.union(kept.filter("NOT _words")).select("row.*")
