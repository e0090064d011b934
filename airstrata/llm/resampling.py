"""Importance resampling towards a target set, by scores of hashed features.

Features are hashed into buckets. Bucket counts of the corpus and of the target, both summed
by Spark, give an array of integer gains with one entry per bucket; a document's weight is
the sum of the gains of its features, read from that array. Gumbel noise from a keyed hash of
the id makes the highest scores a weighted draw without replacement.

The draw is found by weighted median-of-medians selection: every partition reports a median
of its remaining keys and their number, the median of these weighted by size splits the
keys, and the side without the cutoff, an eighth of the keys at least, is discarded. The
driver sees one row per partition and round, and in the end at most ``finish`` keys.
Only the winners are sorted.

Defined cases: a null or empty text has no features and weight 0; it still has a score, but is
too short to be drawn. A null id counts as the text "null" in the hash and comes first on ties.
Every row is a document: repeated rows score alike and each has a place of its own. An empty
target gives gains that favour rare buckets; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airstrata.llm.common import map_texts, text_slices
from airstrata.operators.ordering import global_index
from airstrata.session import materialize

# a word is a run of digits, lower-cased letters and bytes above ASCII; all else separates
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)


@dataclass(frozen=True)
class ResampleConfig:
    """``order``: longest run of words that is a feature. ``percent`` of the documents with at
    least ``least_words`` words are drawn. ``finish``: keys that the driver may sort."""

    order: int = 1
    buckets: int = 10_000
    seed: str = "2024"
    least_words: int = 20
    percent: int = 10
    finish: int = 4096


class _Buckets(dict):
    """Feature to bucket, for the features a task has met; starts anew when large."""

    def __init__(self, count: int, most: int = 200_000):
        super().__init__()
        self._count, self._most = count, most

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= self._most:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature) % self._count
        return bucket


def words(text: str) -> list[bytes]:
    return text.encode().translate(_FOLD).split()


def _features(found: list[bytes], order: int) -> Iterable[bytes]:
    yield from found
    for size in range(2, order + 1):
        for at in range(len(found) - size + 1):
            yield b" ".join(found[at : at + size])


def _bucket_runs(texts: list[str], known: _Buckets, order: int) -> Iterator[tuple[int, np.ndarray]]:
    """The number of words of each text and the buckets of its features."""
    for text in texts:
        found = words(text)
        features = found if order == 1 else list(_features(found, order))
        yield len(found), np.fromiter(map(known.__getitem__, features), np.int64, len(features))


def bucket_counts(texts: DataFrame, config: ResampleConfig) -> np.ndarray:
    """Features of all texts per bucket; a task sends one row per bucket it met."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts = _Buckets(config.buckets), np.zeros(config.buckets, np.int64)
        for batch in batches:
            found = [t or "" for t in batch.column(0).to_pylist()]
            for a, z in text_slices(found, 250_000):
                for _, buckets in _bucket_runs(found[a:z], known, config.order):
                    counts += np.bincount(buckets, minlength=config.buckets)
        met = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(met), pa.array(counts[met])], names=["bucket", "n"])

    partial = map_texts(texts.select("text"), task, "bucket long, n long")
    counts = np.zeros(config.buckets, np.int64)
    for row in partial.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        counts[row["bucket"]] = row["n"]
    return counts


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """The integer gain of each bucket, in thousandths of a nat."""
    size = float(len(corpus))
    whole, aim = float(corpus.sum()), float(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((t + 1.0) * (whole + size) / ((s + 1.0) * (aim + size))))
            for s, t in zip(corpus.tolist(), target.tolist(), strict=True)
        ],
        dtype=np.int64,
    )


def noise(seed: str, key: str) -> int:
    """Gumbel noise, in thousandths, from the hash of the key."""
    h = int(hashlib.sha256(f"{seed}:{key}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score(documents: DataFrame, target: DataFrame, config: ResampleConfig | None = None) -> DataFrame:
    """doc_id, text_key, n_words, n_features, weight, score, row of every document, stored.

    ``row`` numbers the stored rows, so that repeated rows have an order.
    """
    config = config or ResampleConfig()
    table = gains(bucket_counts(documents, config), bucket_counts(target, config))
    schema = T.StructType(
        [
            T.StructField("doc_id", documents.schema["doc_id"].dataType),
            *[T.StructField(c, T.LongType()) for c in ("n_words", "n_features", "weight", "score")],
            T.StructField("text_key", T.StringType()),
        ]
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Buckets(config.buckets)
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            names = batch.column("name").to_pylist()
            sizes, counts, weights = [], [], []
            for a, z in text_slices(texts, 250_000):
                for n, buckets in _bucket_runs(texts[a:z], known, config.order):
                    sizes.append(n)
                    counts.append(len(buckets))
                    weights.append(int(table[buckets].sum()))
            scores = [w + noise(config.seed, k) for w, k in zip(weights, names, strict=True)]
            figures = [pa.array(x, pa.int64()) for x in (sizes, counts, weights, scores)]
            yield pa.record_batch(
                [batch.column("doc_id"), *figures, batch.column("text_key")], names=schema.names
            )

    name = F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("name")
    key = F.md5(F.coalesce("text", F.lit(""))).alias("text_key")
    scored = map_texts(documents.select("doc_id", name, "text", key), task, schema)
    return materialize(scored.withColumn("row", F.monotonically_increasing_id()), "scores")


# the order of the draw: highest score, then smallest id (null first), then the stored row
_ORDER = ["down", "doc_id", "row"]


def _key(row) -> tuple:
    return row["down"], row["doc_id"] is not None, row["doc_id"] if row["doc_id"] is not None else 0, row["row"]


def _at_most(cut) -> Column:
    """True for rows whose key is not behind that of ``cut``."""
    down, known = F.col("down"), F.col("doc_id").isNotNull()
    if cut["doc_id"] is None:
        tie = ~known & (F.col("row") <= cut["row"])
    else:
        same = F.col("doc_id") == F.lit(cut["doc_id"])
        tie = ~known | (F.col("doc_id") < F.lit(cut["doc_id"])) | (same & (F.col("row") <= cut["row"]))
    return (down < cut["down"]) | ((down == cut["down"]) & tie)


def _weighted_median(medians: pa.Table) -> int:
    """The row of the table at half of the summed sizes, in the order of the draw."""
    order = pc.sort_indices(
        medians, sort_keys=[(c, "ascending") for c in _ORDER], null_placement="at_start"
    ).to_numpy()
    upto = np.cumsum(medians.column("size").to_numpy()[order])
    return int(order[np.searchsorted(upto, (upto[-1] + 1) // 2)])


def _medians(keys: DataFrame) -> list:
    """One row per partition: a median of its keys and how many there are.

    A partition takes the weighted median of the medians of its Arrow batches, so a task
    holds one batch and one key per batch.
    """
    schema = T.StructType([*keys.select(*_ORDER).schema.fields, T.StructField("size", T.LongType())])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = [], 0
        for batch in batches:
            if batch.num_rows:
                sized = pa.table([*batch.columns, pa.array(np.ones(batch.num_rows, np.int64))], schema=arrow)
                at = _weighted_median(sized)
                found.append(sized.slice(at, 1).set_column(3, "size", pa.array([batch.num_rows], pa.int64())))
                total += batch.num_rows
        if found:
            medians = pa.concat_tables(found)
            at = _weighted_median(medians)
            best = medians.slice(at, 1).set_column(3, "size", pa.array([total], pa.int64()))
            yield from best.cast(arrow).to_batches()

    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(schema)
    return keys.select(*_ORDER).mapInArrow(task, schema).collect()


def cutoff(keys: DataFrame, k: int, finish: int = 4096):
    """The k-th key (from 1) of a stored table with the columns of the order, as a row."""
    remaining, left = keys.select(*_ORDER), k
    size = stored = remaining.count()
    if not 0 < k <= size:
        raise ValueError(f"no key number {k} among {size}")
    while size > finish:
        medians = _medians(remaining)
        medians.sort(key=_key)
        upto = np.cumsum([m["size"] for m in medians])
        middle = medians[int(np.searchsorted(upto, (upto[-1] + 1) // 2))]
        ahead = remaining.filter(_at_most(middle)).count()
        if ahead == left:
            return middle
        if ahead > left:
            # the middle itself is behind the cutoff
            remaining, size = remaining.filter(_at_most(middle) & (F.col("row") != middle["row"])), ahead - 1
        else:
            remaining, size, left = remaining.filter(~_at_most(middle)), size - ahead, left - ahead
        if 4 * size <= stored:
            # later rounds read what is left, not the whole table
            remaining, stored = materialize(remaining, "remaining-keys"), size
    return sorted(remaining.collect(), key=_key)[left - 1]


def rank(scored: DataFrame, config: ResampleConfig) -> DataFrame:
    """Adds rank, 1 for the highest score, null for rows that are not drawn."""
    scored = scored.withColumn("down", -F.col("score"))
    long_enough = F.col("n_words") >= config.least_words
    eligible = scored.filter(long_enough)
    k = eligible.count() * config.percent // 100
    if not k:
        return scored.withColumn("rank", F.lit(None).cast("long")).drop("down")
    drawn = long_enough & _at_most(cutoff(eligible, k, config.finish))
    winners = global_index(scored.filter(drawn), _ORDER, "place")
    winners = winners.withColumn("rank", (F.col("place") + 1).cast("long")).drop("place")
    others = scored.filter(~drawn).withColumn("rank", F.lit(None).cast("long"))
    return others.unionByName(winners).drop("down")


def resample(documents: DataFrame, target: DataFrame, config: ResampleConfig | None = None) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every document."""
    config = config or ResampleConfig()
    ranked = rank(score(documents, target, config), config)
    return ranked.select("doc_id", "n_features", "weight", "score", "rank")


def draw(documents: DataFrame, target: DataFrame, config: ResampleConfig | None = None) -> DataFrame:
    """The drawn documents with all their columns, and ``draw_rank``.

    Rows that share id and text are one document; each time it is drawn gives a row.
    """
    config = config or ResampleConfig()
    ranked = rank(score(documents, target, config), config).filter("rank is not null")
    won = ranked.select(F.col("doc_id").alias("_id"), F.col("text_key").alias("_key"), F.col("rank").alias("_rank"))
    keyed = documents.select(
        F.struct("*").alias("row"), "doc_id", F.md5(F.coalesce("text", F.lit(""))).alias("text_key")
    ).dropDuplicates(["doc_id", "text_key"])
    match = [keyed["doc_id"].eqNullSafe(won["_id"]), keyed["text_key"] == won["_key"]]
    return keyed.join(won, match).select("row.*", F.col("_rank").alias("draw_rank"))
