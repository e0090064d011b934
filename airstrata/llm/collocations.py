r"""Phrases whose words occur together more often than apart, by prefix-free parsing.

A text becomes a run of words with a break between pieces. A window of ``max_words - 1`` tokens
whose hash is 0 modulo ``modulus`` is a trigger: it ends a chunk and begins the next one, so
chunks overlap by one window, equal passages are cut alike wherever they stand, and a copied
text adds no new chunk. The distinct chunks of a language with their frequencies are the
dictionary. n-grams are counted inside distinct chunks, weighted by frequency; a chunk owns the
n-grams that begin before its last window, which are whole inside it, so an n-gram in an
overlap counts once. The text ends with a window of breaks, which ends its last chunk.

First the hashes of words and pairs are counted. A phrase that occurs often enough has only
parts that do, so a second pass over the dictionary takes the words, and the phrases all of
whose pairs, are in bitmaps of the frequent hashes, and counts these exactly, by their text.
The bitmaps have a fixed number of bits, whatever the corpus; hashes that share a bit only let
a phrase through to be counted.

Counts, cuts, containment and ranks are joins and aggregates over the frequent phrases.

Defined cases: a null or empty text has no words; a null language is ``und``; every row is a
document, repeated rows count each; a null id does not matter; phrases that tie on score and
count are in UTF-8 byte order; an empty table, or one without a frequent phrase, gives no rows;
other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from airstrata.llm.common import map_texts, text_slices
from airstrata.session import materialize

_BREAKS = b".,;:!?\n\x0b\x0c\r"
# A-Z in lower case, breaks as line feed, tabs as blanks
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else 10 if b in _BREAKS else 32 if b == 9 else b for b in range(256)
)
_BREAK = b"\n"
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class PhraseConfig:
    """Phrases of 2 to ``max_words`` words found ``least`` times; the first ``top`` of each language.

    ``covered``: a phrase inside a longer one that has this percentage of its occurrences goes.
    ``modulus``: tokens per chunk on average. ``bits``: size of the bitmap, as a power of two.
    """

    max_words: int = 5
    least: int = 100
    top: int = 2000
    covered: int = 100
    modulus: int = 48
    bits: int = 26


class _Hashes(dict):
    """Word to 64-bit hash, for the words a task has met; starts anew when large."""

    def __init__(self, most: int = 200_000):
        super().__init__()
        import xxhash

        self._digest, self._most = xxhash.xxh3_64_intdigest, most
        self[_BREAK] = 0

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self._most:
            self.clear()
            self[_BREAK] = 0
        # 0 marks a break
        value = self[word] = self._digest(word) or 1
        return value

    def of(self, tokens: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, tokens), np.uint64, len(tokens))


def tokens(text: str) -> list[bytes]:
    """The words of a text with a break behind each piece that has any."""
    found: list[bytes] = []
    for piece in text.encode().translate(_FOLD).split(_BREAK):
        words = piece.split()
        if words:
            found += words
            found.append(_BREAK)
    return found


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def _run_hashes(hashes: np.ndarray, size: int) -> np.ndarray:
    """The hash of each run of ``size`` tokens, by where it begins."""
    count = max(len(hashes) - size + 1, 0)
    run = np.zeros(count, np.uint64)
    for at in range(size):
        run = _mix(run * _STEP + hashes[at : at + count])
    return run


def parse(text: str, known: _Hashes, config: PhraseConfig) -> Iterator[tuple[bytes, int]]:
    """The chunks of a text and the words each owns."""
    width = config.max_words - 1
    run = tokens(text)
    if not run:
        return
    run += [_BREAK] * width
    hashes = known.of(run)
    last = len(run) - width
    cuts = np.flatnonzero(_run_hashes(hashes, width)[1:last] % np.uint64(config.modulus) == 0) + 1
    owned = np.concatenate([[0], np.cumsum(hashes != 0)])
    starts = [0, *cuts.tolist(), last]
    for a, z in zip(starts[:-1], starts[1:], strict=True):
        yield b" ".join(run[a : z + width]), int(owned[z] - owned[a])


def dictionary(documents: DataFrame, config: PhraseConfig) -> DataFrame:
    """lang, chunk, words (that it owns), freq: the distinct chunks of each language, stored."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            langs = batch.column("lang").to_pylist()
            for a, z in text_slices(texts, 250_000):
                met: dict[tuple[str, bytes, int], int] = {}
                for lang, text in zip(langs[a:z], texts[a:z], strict=True):
                    for chunk, words in parse(text, known, config):
                        key = (lang, chunk, words)
                        met[key] = met.get(key, 0) + 1
                if met:
                    lang, chunk, words = zip(*met, strict=True)
                    yield pa.record_batch(
                        [
                            pa.array(lang, pa.string()),
                            pa.array(chunk, pa.binary()).cast(pa.string()),
                            pa.array(words, pa.int64()),
                            pa.array(met.values(), pa.int64()),
                        ],
                        names=["lang", "chunk", "words", "freq"],
                    )

    given = documents.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    chunks = map_texts(given, task, "lang string, chunk string, words long, freq long")
    total = chunks.groupBy("lang", "chunk", "words").agg(F.sum("freq").alias("freq"))
    return materialize(total, "chunk-dictionary")


def _bitmap(frequent: DataFrame, size: int, bits: int) -> np.ndarray:
    """The bits of all hashes of ``size`` words; the driver gets 2**(bits - 6) words at most."""
    place = F.col("hash").bitwiseAND(F.lit((1 << bits) - 1))
    one = F.expr("shiftleft(1L, cast(hash & 63 as int))")
    cells = frequent.filter(F.col("size") == size).groupBy(F.shiftright(place, 6).alias("cell"))
    found = cells.agg(F.bit_or(one).alias("mask")).toArrow()
    words = np.zeros(1 << (bits - 6), np.uint64)
    words[found.column("cell").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    return words


def _known(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(len(bitmap) * 64 - 1)
    return (bitmap[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) != 0


class _Runs:
    """The chunks of one slice end to end: tokens, hashes, and which runs may be counted."""

    def __init__(self, texts: list[str], langs: list[str], freqs: np.ndarray, known: _Hashes, width: int):
        split = [text.encode().split(b" ") for text in texts]
        lengths = np.fromiter(map(len, split), np.int64, len(split))
        self.tokens = [t for part in split for t in part]
        count = len(self.tokens)
        self.hashes = known.of(self.tokens)
        ends = np.cumsum(lengths)
        self._owned = np.ones(count, bool)
        for back in range(1, width + 1):
            self._owned[ends - back] = False
        self.weight = np.repeat(freqs, lengths)
        self.names, lang_of = np.unique(np.array(langs, object), return_inverse=True)
        self.lang = np.repeat(lang_of, lengths)
        salts = known.of([b"\x00" + name.encode() for name in self.names])
        self._salt = salts[0] if len(salts) == 1 else salts[self.lang]
        # runs that begin where a chunk owns them and hold no break, by size
        self._free = self._owned & (self.hashes != 0)
        self._whole = {1: self._free}

    def whole(self, size: int) -> np.ndarray:
        """True where a run of ``size`` tokens is owned and within a piece."""
        if size not in self._whole:
            count = max(len(self.tokens) - size + 1, 0)
            self._whole[size] = self.whole(size - 1)[:count] & (self.hashes[size - 1 : size - 1 + count] != 0)
        return self._whole[size]

    def grams(self, size: int) -> np.ndarray:
        found = _run_hashes(self.hashes, size)
        salt = self._salt[: len(found)] if np.ndim(self._salt) else self._salt
        return _mix(found ^ salt)


def _slices(batches: Iterator[pa.RecordBatch], known: _Hashes, width: int) -> Iterator[_Runs]:
    for batch in batches:
        langs, texts = batch.column("lang").to_pylist(), batch.column("chunk").to_pylist()
        freqs = batch.column("freq").to_numpy()
        for a, z in text_slices(texts, 500_000):
            yield _Runs(texts[a:z], langs[a:z], freqs[a:z], known, width)


def _summed(hashes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct hashes and their summed weights."""
    order = np.argsort(hashes)
    hashes = hashes[order]
    firsts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]])) if len(hashes) else order
    return hashes[firsts], np.add.reduceat(weights[order], firsts) if len(firsts) else weights


def frequent_hashes(chunks: DataFrame, config: PhraseConfig, most: int = 1_000_000) -> DataFrame:
    """size (1, 2) and hash of the words and pairs that can be frequent.

    Equal hashes are counted together, so no frequent one is missing. A task sums up to
    ``most`` hashes before it passes them on.
    """
    width = config.max_words - 1

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Hashes()
        held = {size: [(np.zeros(0, np.uint64), np.zeros(0, np.int64))] for size in (1, 2)}

        def flush(size: int, end: bool) -> Iterator[pa.RecordBatch]:
            hashes, totals = _summed(*(np.concatenate(x) for x in zip(*held[size], strict=True)))
            held[size] = [(hashes, totals)]
            if len(hashes) and (end or 2 * len(hashes) > most):
                held[size] = [(hashes[:0], totals[:0])]
                columns = [np.full(len(hashes), size, np.int8), hashes.view(np.int64), totals]
                yield pa.record_batch([pa.array(c) for c in columns], names=["size", "hash", "n"])

        for runs in _slices(batches, known, width):
            for size in (1, 2):
                at = np.flatnonzero(runs.whole(size))
                held[size].append(_summed(runs.grams(size)[at], runs.weight[at]))
                if sum(len(h) for h, _ in held[size]) > most:
                    yield from flush(size, False)
        for size in (1, 2):
            yield from flush(size, True)

    found = map_texts(chunks.select("lang", "chunk", "freq"), task, "size byte, hash long, n long")
    total = found.groupBy("size", "hash").agg(F.sum("n").alias("n"))
    return materialize(total.filter(F.col("n") >= config.least).drop("n"), "frequent-hashes")


def frequent_phrases(chunks: DataFrame, config: PhraseConfig) -> DataFrame:
    """lang, size, phrase, n of all words and phrases with enough occurrences, stored."""
    width = config.max_words - 1
    hashes = frequent_hashes(chunks, config)
    words, pairs = (_bitmap(hashes, size, config.bits) for size in (1, 2))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for runs in _slices(batches, _Hashes(), width):
            linked = _known(pairs, runs.grams(2))
            for size in range(1, config.max_words + 1):
                good = runs.whole(size).copy()
                if size == 1:
                    good &= _known(words, runs.grams(1))
                for shift in range(size - 1):
                    good &= linked[shift : shift + len(good)]
                at = np.flatnonzero(good)
                if not len(at):
                    continue
                grams = runs.grams(size)[at]
                # a second hash tells apart phrases that share the first
                other = _mix(_run_hashes(runs.hashes + np.uint64(1), size)[at] + runs.lang[at].astype(np.uint64))
                order = np.argsort(grams)
                new = np.concatenate([[True], np.diff(grams[order]) != 0])
                if (np.diff(other[order])[~new[1:]] != 0).any():
                    order = np.lexsort((other, grams))
                    new = np.concatenate([[True], (np.diff(grams[order]) != 0) | (np.diff(other[order]) != 0)])
                firsts = np.flatnonzero(new)
                places = at[order][firsts]
                phrases = [b" ".join(runs.tokens[p : p + size]) for p in places.tolist()]
                yield pa.record_batch(
                    [
                        pa.array(runs.names[runs.lang[places]], pa.string()),
                        pa.array(np.full(len(places), size, np.int32)),
                        pa.array(phrases, pa.binary()).cast(pa.string()),
                        pa.array(np.add.reduceat(runs.weight[at][order], firsts)),
                    ],
                    names=["lang", "size", "phrase", "n"],
                )

    found = map_texts(chunks.select("lang", "chunk", "freq"), task, "lang string, size int, phrase string, n long")
    total = found.groupBy("lang", "phrase", "size").agg(F.sum("n").alias("n"))
    return materialize(total.filter(F.col("n") >= config.least), "phrases")


def _part(first, last):
    """The words ``first`` to ``last`` (from 1) of the split phrase, joined."""
    return F.array_join(F.slice("parts", first, last - first + 1), " ")


def score_phrases(phrases: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, phrase, size, a, l, r, n, score: every candidate by its lowest-scoring cut."""
    spread = phrases.filter("size > 1").withColumn("parts", F.split("phrase", " "))
    cuts = spread.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.select(
        "lang",
        "phrase",
        "size",
        F.col("n").alias("a"),
        "k",
        _part(F.lit(1), F.col("k")).alias("left"),
        _part(F.col("k") + 1, F.col("size")).alias("right"),
    )
    left = phrases.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l"))
    right = phrases.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r"))
    both = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"]).join(totals, "lang")
    wide = "decimal(18,0)"
    above = F.lit(1000).cast("decimal(4,0)") * F.col("a").cast("decimal(15,0)") * F.col("n").cast(wide)
    both = both.withColumn("_above", above).withColumn("_below", F.col("l").cast(wide) * F.col("r").cast(wide))
    scored = both.withColumn("score", F.expr("_above div _below"))
    best = F.min(F.struct("score", "k", "l", "r", "n")).alias("best")
    lowest = scored.groupBy("lang", "phrase", "size", "a").agg(best)
    return lowest.select("lang", "phrase", "size", "a", "best.l", "best.r", "best.n", "best.score")


def uncovered(candidates: DataFrame, config: PhraseConfig) -> DataFrame:
    """Candidates that no longer candidate covers."""
    parts = candidates.filter("size > 2").withColumn("parts", F.split("phrase", " "))
    parts = parts.withColumn("length", F.explode(F.sequence(F.lit(2), F.col("size") - 1)))
    parts = parts.withColumn("first", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("length") + 1)))
    inner = parts.select("lang", _part(F.col("first"), F.col("first") + F.col("length") - 1).alias("phrase"), "a")
    most = inner.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    joined = candidates.join(most, ["lang", "phrase"], "left")
    covered = 100 * F.col("most") >= config.covered * F.col("a")
    return joined.filter(~F.coalesce(covered, F.lit(False))).drop("most")


def collocations(documents: DataFrame, config: PhraseConfig | None = None) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first ``top`` phrases of each language."""
    config = config or PhraseConfig()
    chunks = dictionary(documents, config)
    totals = materialize(
        chunks.groupBy("lang").agg(F.sum(F.col("words") * F.col("freq")).alias("n")), "words-per-language"
    )
    phrases = frequent_phrases(chunks, config)
    candidates = materialize(score_phrases(phrases, totals), "candidates")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = uncovered(candidates, config).withColumn("rank", F.row_number().over(order))
    return ranked.filter(F.col("rank") <= config.top).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"
    )
