r"""Training-order shards of token ids.

Texts are encoded with a byte-level BPE and packed, each followed by an end id, into
sequences of fixed length; the last sequence of an input partition is padded with end ids.
Sequences are numbered by input partition and place, 0 to N - 1. A keyed Feistel network
permutes the smallest domain of an even number of bits that holds N, and cycle-walking (go
on permuting until the number is below N) turns it into a permutation of 0 to N - 1: the
global slot of every sequence, without any sort or table. Range partitions over the shards
write them as files of little-endian 16-bit ids with a fixed stride, so slot s is at
``(s % per_shard) * 2 * length`` of shard ``s // per_shard``, and a reader resumes anywhere.

Every text is encoded once. The packed sequences are stored compressed; their number per
input partition, one row each, gives the first number of every partition. On the way to the
shards the sequences of a task that share a shard travel together, compressed, and the
writer puts each at its slot in a buffer of one shard. A shard is written under a name of
its attempt and then renamed, so repeated or speculative tasks leave one whole file.

Defined cases: a null text is empty and adds one end id; repeated rows are packed
each; an empty table gives no shards; doc_id and other columns are not needed.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airstrata.llm.common import map_texts, text_slices
from airstrata.llm.token_counts import byte_bpe
from airstrata.session import materialize

# ids of a stored row, and ids that a task holds before it passes them on
_ROW_IDS, _HELD_IDS = 1 << 19, 1 << 23
_LEVEL = 5


@dataclass(frozen=True)
class OrderConfig:
    ranks_path: str
    pattern: str
    end_id: int = 50256
    length: int = 1024
    per_shard: int = 4096
    key: int = 0x5EED
    rounds: int = 6


def _pack(ids: np.ndarray) -> bytes:
    return pa.Codec("zstd", compression_level=_LEVEL).compress(ids.tobytes(), asbytes=True)


def _unpack(data: bytes, n: int, length: int) -> np.ndarray:
    raw = pa.decompress(data, decompressed_size=2 * n * length, codec="zstd", asbytes=True)
    return np.frombuffer(raw, "<u2").reshape(n, length)


def permute(numbers: np.ndarray, count: int, key: int, rounds: int = 6) -> np.ndarray:
    """The slot of each number in 0..count-1 under the keyed permutation of that range."""
    half = max(1, ((max(count, 2) - 1).bit_length() + 1) // 2)
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = np.random.Generator(np.random.Philox(key)).integers(1, 1 << 63, rounds, dtype=np.uint64)

    def once(values: np.ndarray) -> np.ndarray:
        left, right = values >> shift, values & mask
        for round_key in keys:
            mixed = (right + round_key) * np.uint64(0x9E3779B97F4A7C15)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
            left, right = right, left ^ ((mixed ^ (mixed >> np.uint64(32))) & mask)
        return (left << shift) | right

    slots = once(numbers.astype(np.uint64))
    while len(outside := np.flatnonzero(slots >= np.uint64(count))):
        slots[outside] = once(slots[outside])
    return slots.astype(np.int64)


def encode(documents: DataFrame, config: OrderConfig) -> DataFrame:
    """part, at, n, data: packed sequences of each input partition, compressed in runs.

    A row holds ``n`` sequences, the first of which has place ``at`` in its partition.
    """
    per_row = max(1, _ROW_IDS // config.length)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, _ = byte_bpe(config.ranks_path, config.pattern)
        part, at, kept = TaskContext.get().partitionId(), 0, np.zeros(0, "<u2")

        def row(ids: np.ndarray) -> pa.RecordBatch:
            n = len(ids) // config.length
            arrays = [pa.array([part]), pa.array([at]), pa.array([n]), pa.array([_pack(ids)], pa.binary())]
            return pa.record_batch(arrays, names=["part", "at", "n", "data"])

        for batch in batches:
            texts = [t or "" for t in batch.column(0).to_pylist()]
            for a, z in text_slices(texts):
                flat: list[int] = []
                for text in texts[a:z]:
                    flat += encoding.encode_ordinary(text)
                    flat.append(config.end_id)
                kept = np.concatenate([kept, np.array(flat, "<u2")])
                while len(kept) >= per_row * config.length:
                    yield row(kept[: per_row * config.length])
                    at, kept = at + per_row, kept[per_row * config.length :]
        if len(kept):
            pad = np.full(-len(kept) % config.length, config.end_id, "<u2")
            yield row(np.concatenate([kept, pad]))

    return map_texts(documents.select("text"), task, "part long, at long, n long, data binary")


def _place(config: OrderConfig, first: dict[int, int], slots: int):
    """The task that gives every sequence its slot and gathers what goes to one shard."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            at = np.concatenate([x for x, _ in held])
            grid = np.concatenate([x for _, x in held])
            held.clear()
            order = np.argsort(at)
            shards = at[order] // config.per_shard
            cuts = [0, *(np.flatnonzero(np.diff(shards)) + 1).tolist(), len(at)]
            data = [
                at[order[a:z]].astype("<i8").tobytes() + _pack(grid[order[a:z]])
                for a, z in zip(cuts, cuts[1:], strict=False)
            ]
            counts = np.diff(cuts)
            arrays = [pa.array(shards[cuts[:-1]]), pa.array(counts), pa.array(data, pa.binary())]
            return pa.record_batch(arrays, names=["shard", "n", "data"])

        for batch in batches:
            for part, at, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                numbers = np.arange(first[part] + at, first[part] + at + n)
                held.append((permute(numbers, slots, config.key, config.rounds), _unpack(data, n, config.length)))
                if sum(len(x) for x, _ in held) * config.length >= _HELD_IDS:
                    yield flush()
        if held:
            yield flush()

    return task


def _shard_name(shard: int) -> str:
    return f"shard-{shard:09d}.bin"


def write_shards(documents: DataFrame, path: str, config: OrderConfig) -> int:
    """Writes all shards below ``path``, a URI that every executor reaches; returns N."""
    stored = materialize(encode(documents, config), "sequences")
    # one row per input partition comes to the driver
    sizes = stored.groupBy("part").agg(F.sum("n").alias("n")).collect()
    first, slots = {}, 0
    for r in sorted(sizes):
        first[r["part"]], slots = slots, slots + r["n"]
    if not slots:
        return 0
    shards = -(-slots // config.per_shard)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, folder = fs.FileSystem.from_uri(path)
        store.create_dir(folder, recursive=True)
        attempt = TaskContext.get().taskAttemptId()
        shard, content, filled = -1, None, None

        def close() -> pa.RecordBatch:
            if not filled.all():
                raise RuntimeError(f"shard {shard} lacks sequences")
            with store.open_output_stream(f"{folder}/.{shard}-{attempt}") as out:
                out.write(content.tobytes())
            store.move(f"{folder}/.{shard}-{attempt}", f"{folder}/{_shard_name(shard)}")
            return pa.record_batch([pa.array([shard])], names=["shard"])

        for batch in batches:
            for now, n, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now != shard:
                    if content is not None:
                        yield close()
                    shard, size = now, min(config.per_shard, slots - now * config.per_shard)
                    content, filled = np.zeros((size, config.length), "<u2"), np.zeros(size, bool)
                at = np.frombuffer(data[: 8 * n], "<i8") - shard * config.per_shard
                content[at], filled[at] = _unpack(data[8 * n :], n, config.length), True
        if content is not None:
            yield close()

    placed = stored.mapInArrow(_place(config, first, slots), "shard long, n long, data binary")
    # even ranges of shards; their borders are known, so nothing needs to be sampled
    ranges = min(shards, int(placed.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    spread = placed.repartitionById(ranges, F.floor(F.col("shard") * ranges / shards).cast("int"))
    written = spread.sortWithinPartitions("shard").mapInArrow(write, "shard long")
    if written.agg(F.countDistinct("shard")).first()[0] != shards:
        raise RuntimeError("shards are missing")
    return slots


def read_slots(spark: SparkSession, path: str, config: OrderConfig, from_slot: int = 0) -> DataFrame:
    """slot, shard, ids (binary) from ``from_slot`` on; earlier shards are not read."""
    stride = 2 * config.length
    files = spark.read.format("binaryFile").load(f"{path}/shard-*.bin")
    shard = F.regexp_extract("path", r"shard-(\d+)\.bin$", 1).cast("long")
    first = F.lit(from_slot // config.per_shard)
    rows = files.withColumn("shard", shard).filter(F.col("shard") >= first)
    count = (F.col("length") / stride).cast("int")
    rows = rows.select("shard", "content", F.explode(F.sequence(F.lit(0), count - 1)).alias("at"))
    slot = F.col("shard") * config.per_shard + F.col("at")
    ids = F.expr(f"substring(content, at * {stride} + 1, {stride})")
    return rows.select(slot.alias("slot"), "shard", ids.alias("ids")).filter(F.col("slot") >= from_slot)
