"""Helpers that several corpus operators share."""

from __future__ import annotations

import ctypes
import gc
from array import array
from collections.abc import Callable, Collection, Iterator, Sequence
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: rows that a Python task gets at once; whole texts can be long
BATCH_ROWS = 1000


def map_texts(rows: DataFrame, task, schema) -> DataFrame:
    """mapInArrow over rows that hold whole texts, in batches of at most BATCH_ROWS.

    Lowers the session's batch size where it is larger: a batch is in memory several times,
    in the executor and in its Python task.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = rows.sparkSession.conf
    if not 0 < int(conf.get(name)) <= BATCH_ROWS:
        conf.set(name, str(BATCH_ROWS))

    def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from task(batches)
        finally:
            _give_back()

    return rows.mapInArrow(trimmed, schema)


def _give_back() -> None:
    """Return freed memory to the system: a Python worker waits for its next task, beside the JVM."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not every C library has it
        pass


def text_key(text: Column) -> Column:
    """Tells apart rows that share a doc_id; a null text counts as empty."""
    return F.md5(F.coalesce(text, F.lit("")))


def held_out(doc_id: Column) -> Column:
    """True for documents whose label is never learned from (a null id: never held out)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class _Numbers(dict):
    """Numbers chunks in the order they are first asked for."""

    def __missing__(self, chunk: str) -> int:
        number = self[chunk] = len(self)
        return number


class ChunkTable:
    """The distinct chunks that a task has met, each encoded once, with its ids.

    Starts anew once it holds ``most`` chunks, so its memory is bounded whatever the number
    of distinct chunks; results do not depend on that bound. With ``decode_many`` it holds
    the decoded text of each chunk's ids as well.
    """

    def __init__(
        self,
        encode_many: Callable[[list[str]], list[list[int]]],
        most: int = 150_000,
        decode_many: Callable[[list[list[int]]], list[str]] | None = None,
    ):
        self._encode, self._decode, self._most = encode_many, decode_many, most
        self._clear()

    def _clear(self) -> None:
        self._at = _Numbers()
        self._pool, self._start, self._count = array("I"), array("q"), array("q")
        self.texts: list[str] = []

    def find(self, chunks: Collection[str]) -> np.ndarray:
        """The table row of each chunk, by position; unknown chunks are encoded first.

        Rows of earlier calls are void after this call.
        """
        if len(self._at) >= self._most:
            self._clear()
        known = len(self._at)
        rows = np.fromiter(map(self._at.__getitem__, chunks), np.int64, len(chunks))
        if len(self._at) > known:
            found = self._encode(list(islice(self._at, known, None)))
            for ids in found:
                self._start.append(len(self._pool))
                self._count.append(len(ids))
                self._pool.extend(ids)
            if self._decode:
                self.texts += self._decode(found)
        return rows

    def counts(self, rows: np.ndarray) -> np.ndarray:
        return np.array(self._count, dtype=np.int64)[rows]

    def ids(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the given rows, end to end, and the number of ids up to each row's end."""
        counts = self.counts(rows)
        ends = np.cumsum(counts)
        shift = np.array(self._start, dtype=np.int64)[rows] - (ends - counts)
        places = np.repeat(shift, counts) + np.arange(ends[-1] if len(ends) else 0)
        return np.array(self._pool, dtype=np.uint32)[places], ends


def text_slices(texts: Sequence[str], chars: int = 1_000_000) -> Iterator[tuple[int, int]]:
    """Cuts a batch into runs of rows with about ``chars`` code points (one row at least)."""
    start = total = 0
    for at, text in enumerate(texts):
        if total and total + len(text) > chars:
            yield start, at
            start, total = at, 0
        total += len(text)
    if start < len(texts):
        yield start, len(texts)
