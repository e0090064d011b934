r"""Line removal through a sharded minimal perfect hash.

A line's key is the line without white space at both ends, A-Z in lower case; keys that at
least ``documents`` documents hold lose all their lines.

1. Documents are read in blocks. A block keeps the 128-bit hashes of its distinct keys, in how
   many of its documents each occurs, and for every line the number of its key: about twenty
   bytes a line. Texts are not kept.
2. Hashes are counted over all blocks and dealt into shards by their first bits. For each
   shard a task builds a minimal perfect hash (levels of bits; a key is at home in the first
   level where it has a bit for itself) with two arrays at its slots: a 32-bit fingerprint
   and the number of documents, in the narrowest type that holds it.
3. Every block sends its hashes once per shard to that shard's arrays, which answer with a bit
   per hash. A line in most documents is one hash per block, so no shard is hot.
4. The bits are put back on the lines of the block by number, and documents take them by key.

Every probed hash is in the table, so answers are exact but for equal 128-bit hashes of
different lines; for lines of other corpora (``probe``) the fingerprint lets one in 4 billion
unknown lines through.

Defined cases: a null or empty text is one empty line; keys shorter than ``least_chars`` are
never dropped; a carriage return before the line feed belongs to the stripped white space of
the key and stays in kept lines. Every row is a document, repeated rows too (they count each
and are returned each). A null id stays. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from airstrata.llm.common import map_texts, text_slices
from airstrata.session import materialize

_SPACE = b" \t\n\x0b\x0c\r"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_GAMMA = 2.0
_STEP = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class LineConfig:
    """``shard_keys``: distinct keys a shard holds on average, which bounds a task's arrays."""

    documents: int = 10
    least_chars: int = 1
    shard_keys: int = 200_000


def line_keys(text: str) -> list[bytes]:
    return [line.strip(_SPACE) for line in text.encode().translate(_LOWER).split(b"\n")]


# ---- minimal perfect hash ------------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _places(hashes: np.ndarray, level: int, size: int) -> np.ndarray:
    """Where the hashes (pairs of 64-bit words) fall among ``size`` bits of a level."""
    key = np.uint64((level + 1) * _STEP % 2**64)
    mixed = _mix(hashes[:, 0] + key) + _mix(hashes[:, 1] ^ key)
    return (_mix(mixed) % np.uint64(size)).astype(np.int64)


@dataclass(frozen=True)
class PerfectHash:
    """Levels of bits; the slot of a key is the number of set bits before its own."""

    levels: list[np.ndarray]
    fingerprints: np.ndarray
    counts: np.ndarray

    @classmethod
    def build(cls, hashes: np.ndarray, counts: np.ndarray) -> PerfectHash:
        levels, homes, before = [], np.zeros(len(hashes), np.int64), 0
        left = np.arange(len(hashes))
        while len(left):
            if len(levels) > 200:
                raise ValueError("equal hashes in a shard")
            size = max(8, int(_GAMMA * len(left)))
            at = _places(hashes[left], len(levels), size)
            alone = np.bincount(at, minlength=size) == 1
            settled = alone[at]
            homes[left[settled]] = before + (np.cumsum(alone) - 1)[at[settled]]
            before += int(alone.sum())
            levels.append(np.packbits(alone))
            left = left[~settled]
        kind = np.min_scalar_type(int(counts.max()) if len(counts) else 0)
        prints, slots = np.zeros(len(hashes), "<u4"), np.zeros(len(hashes), kind)
        prints[homes] = hashes[:, 1].astype("<u4")
        slots[homes] = counts
        return cls(levels, prints, slots)

    @cached_property
    def _slots(self) -> list[np.ndarray]:
        """Per level the slot at each place, -1 where no key is at home; made once per table."""
        opened, before, size = [], 0, len(self.counts)
        for packed in self.levels:
            bits = np.unpackbits(packed, count=max(8, int(_GAMMA * size))).astype(bool)
            opened.append(np.where(bits, before - 1 + np.cumsum(bits), -1).astype(np.int32))
            settled = int(bits.sum())
            before, size = before + settled, size - settled
        return opened

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The counts of the hashes, 0 for those whose fingerprint differs."""
        found, left = np.zeros(len(hashes), np.int64), np.arange(len(hashes))
        for number, level in enumerate(self._slots):
            if not len(left):
                break
            slots = level[_places(hashes[left], number, len(level))]
            home = slots >= 0
            mine, slots, left = left[home], slots[home], left[~home]
            same = self.fingerprints[slots] == hashes[mine, 1].astype("<u4")
            found[mine[same]] = self.counts[slots[same]]
        return found

    def pack(self) -> dict:
        return {
            "levels": [x.tobytes() for x in self.levels],
            "fingerprints": self.fingerprints.tobytes(),
            "counts": self.counts.tobytes(),
            "count_bytes": self.counts.dtype.itemsize,
        }

    @classmethod
    def unpack(cls, row: dict) -> PerfectHash:
        return cls(
            [np.frombuffer(x, np.uint8) for x in row["levels"]],
            np.frombuffer(row["fingerprints"], "<u4"),
            np.frombuffer(row["counts"], f"<u{row['count_bytes']}"),
        )


_TABLE = "shard long, levels array<binary>, fingerprints binary, counts binary, count_bytes int"
_PACKED = pa.schema(
    [
        ("shard", pa.int64()),
        ("levels", pa.list_(pa.binary())),
        ("fingerprints", pa.binary()),
        ("counts", pa.binary()),
        ("count_bytes", pa.int32()),
    ]
)


# ---- blocks of documents -------------------------------------------------------


def _doc_key(text: Column) -> Column:
    """Names a document by id and text, so that copies under other ids spread."""
    return F.md5(F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), text))


def line_blocks(documents: DataFrame, config: LineConfig) -> DataFrame:
    """One row per block of texts: its distinct key hashes and the key number of each line."""
    schema = (
        "block string, keys array<string>, sizes binary, lines binary, hashes binary, documents binary"
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        digest = xxhash.xxh3_128_digest
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            for a, z in text_slices(texts, 250_000):
                numbers: dict[bytes, int] = {}
                lines, sizes, holders = [], [], []
                for text in texts[a:z]:
                    mine = [numbers.setdefault(k, len(numbers)) for k in line_keys(text)]
                    sizes.append(len(mine))
                    lines += mine
                    holders += set(mine)
                keys = list(numbers)
                hashes = np.frombuffer(b"".join(map(digest, keys)), "<u8").reshape(-1, 2)
                counted = np.bincount(np.array(holders), minlength=len(keys))
                # keys that are too short count nowhere, so that they are never frequent
                counted[[len(k.decode()) < config.least_chars for k in keys]] = 0
                row = {
                    "block": uuid.uuid4().hex,
                    "keys": batch.column("key").slice(a, z - a).to_pylist(),
                    "sizes": np.array(sizes, "<u4").tobytes(),
                    "lines": np.array(lines, "<u4").tobytes(),
                    "hashes": hashes.tobytes(),
                    "documents": counted.astype("<u4").tobytes(),
                }
                yield pa.RecordBatch.from_pylist([row])

    text = F.coalesce("text", F.lit(""))
    keyed = documents.select(_doc_key(text).alias("key"), text.alias("text"))
    return materialize(map_texts(keyed, task, schema), "line-blocks")


def _unpacked(row: bytes) -> np.ndarray:
    return np.frombuffer(row, "<u8").reshape(-1, 2)


def _shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return ((hashes[:, 0] >> np.uint64(16)) % np.uint64(shards)).astype(np.int64)


def line_table(blocks: DataFrame, config: LineConfig) -> tuple[DataFrame, int]:
    """shard and its packed table, one row per shard, stored; and the number of shards."""
    hashes = F.length("hashes") / 16
    upper = blocks.agg(F.sum(hashes)).first()[0] or 0
    shards = int(upper) // config.shard_keys + 1

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found, counted in zip(batch.column(0), batch.column(1), strict=True):
                pair = _unpacked(found.as_py())
                counts = np.frombuffer(counted.as_py(), "<u4").astype(np.int64)
                signed = pair.view("<i8")
                yield pa.record_batch(
                    [pa.array(_shard_of(pair, shards)), pa.array(signed[:, 0]), pa.array(signed[:, 1]), pa.array(counts)],
                    names=["shard", "high", "low", "n"],
                )

    def build(part: pa.Table) -> pa.Table:
        pairs = np.stack([part.column(c).to_numpy() for c in ("high", "low")], axis=1).view("<u8")
        table = PerfectHash.build(pairs, part.column("n").to_numpy())
        row = {"shard": part.column("shard")[0].as_py(), **table.pack()}
        return pa.Table.from_pylist([row], schema=_PACKED)

    single = blocks.select("hashes", "documents").mapInArrow(unfold, "shard long, high long, low long, n long")
    counted = single.groupBy("shard", "high", "low").agg(F.sum("n").alias("n"))
    table = counted.groupBy("shard").applyInArrow(build, _TABLE)
    return materialize(table, "line-table"), shards


def probe(blocks: DataFrame, table: DataFrame, shards: int, config: LineConfig) -> DataFrame:
    """block, shard, frequent: a bit for each hash of the block in the shard, in their order.

    A shard's table and the hashes sent to it meet in one task, the table first, and are
    worked off as a stream: a task holds one table and one batch.
    """

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, found in zip(batch.column(0), batch.column(1), strict=True):
                pair = _unpacked(found.as_py())
                shard = _shard_of(pair, shards)
                order = np.argsort(shard, kind="stable")
                cuts = np.flatnonzero(np.diff(shard[order])) + 1
                parts = np.split(order, cuts)
                yield pa.record_batch(
                    [
                        pa.array([int(shard[p[0]]) for p in parts], pa.int64()),
                        pa.array([block.as_py()] * len(parts), pa.string()),
                        pa.array([pair[p].tobytes() for p in parts], pa.binary()),
                    ],
                    names=["shard", "block", "hashes"],
                )

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, current = None, None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["block"] is None:
                    shard, current = row["shard"], PerfectHash.unpack(row)
                    continue
                pair = _unpacked(row["hashes"])
                frequent = np.zeros(len(pair), bool)
                if row["shard"] == shard:
                    frequent = current.find(pair) >= config.documents
                out.append({"block": row["block"], "shard": shard, "frequent": np.packbits(frequent).tobytes()})
            if out:
                yield pa.RecordBatch.from_pylist(out)

    asked = blocks.select("block", "hashes").mapInArrow(split, "shard long, block string, hashes binary")
    both = asked.unionByName(table, allowMissingColumns=True)
    met = both.repartition("shard").sortWithinPartitions("shard", F.col("block").asc_nulls_first())
    return met.mapInArrow(answer, "block string, shard long, frequent binary")


def line_flags(blocks: DataFrame, answers: DataFrame, shards: int) -> DataFrame:
    """key and drop, a flag per line, of every document that loses a line."""

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                pair = _unpacked(row["hashes"])
                shard = _shard_of(pair, shards)
                frequent = np.zeros(len(pair), bool)
                for part in row["answers"]:
                    mine = np.flatnonzero(shard == part["shard"])
                    bits = np.unpackbits(np.frombuffer(part["frequent"], np.uint8), count=len(mine))
                    frequent[mine] = bits.astype(bool)
                drop = frequent[np.frombuffer(row["lines"], "<u4")]
                ends = np.cumsum(np.frombuffer(row["sizes"], "<u4").astype(np.int64))
                docs = [(k, f) for k, f in zip(row["keys"], np.split(drop, ends[:-1]), strict=True) if f.any()]
                if docs:
                    yield pa.record_batch(
                        [pa.array([k for k, _ in docs]), pa.array([f for _, f in docs], pa.list_(pa.bool_()))],
                        names=["key", "drop"],
                    )

    by_block = answers.groupBy("block").agg(F.collect_list(F.struct("shard", "frequent")).alias("answers"))
    whole = blocks.drop("documents").join(by_block, "block")
    flags = whole.mapInArrow(restore, "key string, drop array<boolean>")
    # rows that share id and text have the same flags
    return flags.dropDuplicates(["key"])


def drop_lines(documents: DataFrame, config: LineConfig | None = None) -> DataFrame:
    """doc_id, kept_text, n_lines (before dropping), n_dropped of every document."""
    config = config or LineConfig()
    blocks = line_blocks(documents, config)
    table, shards = line_table(blocks, config)
    flags = materialize(line_flags(blocks, probe(blocks, table, shards, config), shards), "line-flags")
    text = F.coalesce("text", F.lit(""))
    keyed = documents.select("doc_id", text.alias("text"), _doc_key(text).alias("key"))
    joined = keyed.join(flags, "key", "left")
    lines = F.split("text", "\n")
    kept = F.array_join(F.filter(lines, lambda _, at: ~F.get("drop", at)), "\n")
    return joined.select(
        "doc_id",
        F.when(F.col("drop").isNull(), F.col("text")).otherwise(kept).alias("kept_text"),
        (F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1).cast("long").alias("n_lines"),
        F.when(F.col("drop").isNull(), F.lit(0))
        .otherwise(F.size(F.filter("drop", lambda x: x)))
        .cast("long")
        .alias("n_dropped"),
    )


def digests(documents: DataFrame, config: LineConfig | None = None) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept_sha256 of every document."""
    kept = drop_lines(documents, config)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))
