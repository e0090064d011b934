"""Language of words and documents by a linear-chain conditional random field.

Words are runs of letters, lower-cased. A word scores for each language by the weights of
its hashed affixes and character n-grams, its own hash, and the lexicon (the languages that
nearly own the word in the training sample); learned transitions join neighbours. Forward-
backward gives each word its posterior. A document's language is the one with the largest
mean posterior over all its words, which is its score.

Chains are sentences: they end at ``. ! ?`` and at a line feed. They run through the
recursions side by side, long ones in parts of 512 words: products of a part's step matrices
carry the forward and backward vectors over its ends, so posteriors are those of the whole
chain. Runs of more than 64 letters are cut into words of 64, so all letters count.

Training takes windows of at most ``window`` code points from ``per_label`` distinct texts of
each label, or all it has, picked by the hash of the text, so copies neither count nor crowd
out others. All are given to the driver: the bound of the sample is ``windows`` in all, dealt
evenly if there are so many labels that each gets less than ``per_label``; every label is
learned, with one window at least. Whole-document labels label words; some training chains
join sentences of two documents, so that transitions also see switches.

Defined cases: a text that is null or has no letters is `und` with score 0, as is every
text when nothing can be learned; ties go to the label first in order; a single label is
always predicted; repeated rows are predicted each; a null doc_id is never held out; an
empty table gives no rows. Other columns, and any clashing names, stay as they are.
"""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airstrata.llm.common import held_out, map_texts, text_slices
from airstrata.session import materialize

UNKNOWN = "und"
_TOKEN = re.compile(r"[^\W\d_]{1,64}|[.!?\n]")
_STOPS = {".", "!", "?", "\n"}
_CHAIN = 512


@dataclass(frozen=True)
class CrfConfig:
    per_label: int = 400
    window: int = 600
    windows: int = 80_000
    bits: int = 16
    epochs: int = 6
    batch: int = 256
    rate: float = 0.2
    seed: int = 7


@dataclass(frozen=True)
class CrfModel:
    labels: list[str]
    weights: np.ndarray  # (features, labels)
    transitions: np.ndarray  # (labels, labels), scores from row to column
    first: np.ndarray  # (labels,)
    lexicon: dict[str, int]
    bits: int


def _hash(name: str) -> int:
    return zlib.crc32(name.encode())


class _Grams(dict):
    """Hashes of short n-grams, each worked out once; starts anew beyond ``most`` of them."""

    def __init__(self, most: int = 200_000):
        self._most = most

    def __missing__(self, gram: str) -> int:
        if len(self) >= self._most:
            self.clear()
        found = self[gram] = _hash(gram)
        return found


_GRAMS = _Grams()


def word_features(word: str, lexicon: dict[str, int], bits: int) -> list[int]:
    """Hashed prefixes and suffixes up to 3, inner n-grams of 2 and 3, the word, its lexicon entry."""
    marked = f"<{word}>"
    grams = [f"p{marked[:2]}", f"p{marked[:3]}", f"p{marked[:4]}"]
    grams += [f"s{marked[-2:]}", f"s{marked[-3:]}", f"s{marked[-4:]}"]
    grams += [marked[i : i + 2] for i in range(1, len(marked) - 2)]
    grams += [marked[i : i + 3] for i in range(1, len(marked) - 3)]
    # a name counts once, in a fixed order, so that sums of weights agree between runs
    hashes = [*map(_GRAMS.__getitem__, dict.fromkeys(grams)), _hash(f"w{marked}")]
    if word in lexicon:
        hashes.append(_hash(f"lex{lexicon[word]}"))
    mask = (1 << bits) - 1
    return [h & mask for h in hashes]


def _steps(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Chains by falling length: their order, first words, and how many reach each step."""
    order = np.argsort(-lengths, kind="stable")
    starts = (np.cumsum(lengths) - lengths)[order]
    longest = int(lengths.max()) if len(lengths) else 0
    reach = len(lengths) - np.searchsorted(np.sort(lengths), np.arange(longest), "right")
    return order, starts, reach


def _carried(local: np.ndarray, lengths: np.ndarray, follows: np.ndarray, step: np.ndarray, first: np.ndarray):
    """The vectors that enter each part of a chain at its first word and leave it behind its last."""
    enter, leave = np.tile(first, (len(lengths), 1)), np.ones((len(lengths), len(first)))
    cut = np.flatnonzero(follows | np.append(follows[1:], False))
    if not len(cut):
        return enter, leave
    order, _, reach = _steps(lengths[cut])
    starts = (np.cumsum(lengths) - lengths)[cut][order]
    # product over a part of step times local scores, without the step to its first word
    through = np.eye(len(first)) * local[starts][:, None, :]
    for t, n in enumerate(reach[1:], 1):
        now = (through[:n] @ step) * local[starts[:n] + t][:, None, :]
        through[:n] = now / now.sum(axis=(1, 2), keepdims=True)
    through = through[np.argsort(order)]
    end = first
    for k, product in zip(cut, through, strict=True):
        if follows[k]:
            enter[k] = end @ step
        end = enter[k] @ product
        end /= end.sum()
    for k, product in zip(cut[::-1], through[::-1], strict=True):
        if follows[k]:
            back = step @ (product @ leave[k])
            leave[k - 1] = back / back.sum()
    return enter, leave


def forward_backward(scores: np.ndarray, lengths: np.ndarray, model: CrfModel, follows: np.ndarray | None = None):
    """Posteriors of all words, and the summed posteriors of neighbouring label pairs.

    ``scores`` holds the words of all chains end to end. ``follows`` marks those of the given
    lengths that go on with the chain before them.
    """
    local = np.exp(scores - scores.max(axis=1, keepdims=True))
    step, first = np.exp(model.transitions), np.exp(model.first)
    follows = np.zeros(len(lengths), bool) if follows is None else follows
    enter, leave = _carried(local, lengths, follows, step, first)
    order, starts, reach = _steps(lengths)
    alpha, beta = np.empty_like(local), np.ones_like(local)
    beta[np.cumsum(lengths) - 1] = leave
    before = None
    for t, n in enumerate(reach):
        at = starts[:n] + t
        now = (enter[order[:n]] if before is None else before[:n] @ step) * local[at]
        before = now / now.sum(axis=1, keepdims=True)
        alpha[at] = before
    pairs = np.zeros_like(step)
    for t in range(len(reach) - 1, 0, -1):
        at = starts[: reach[t]] + t
        ahead = local[at] * beta[at]
        back = ahead @ step.T
        total = (alpha[at - 1] * back).sum(axis=1, keepdims=True)
        pairs += (alpha[at - 1].T @ (ahead / total)) * step
        beta[at - 1] = back / back.sum(axis=1, keepdims=True)
    at = (np.cumsum(lengths) - lengths)[follows]
    ahead = local[at] * beta[at]
    total = (alpha[at - 1] * (ahead @ step.T)).sum(axis=1, keepdims=True)
    pairs += (alpha[at - 1].T @ (ahead / total)) * step
    posterior = alpha * beta
    return posterior / posterior.sum(axis=1, keepdims=True), pairs


def _parts(text: str) -> tuple[list[list[str]], list[bool]]:
    """The words of a text's chains in parts of at most 512, and which parts go on with the one before."""
    parts, follows, now, on = [], [], [], False
    for token in _TOKEN.findall(text.lower()):
        stop = token in _STOPS
        if now and (stop or len(now) == _CHAIN):
            parts.append(now)
            follows.append(on)
            now, on = [], not stop
        if stop:
            on = False
        else:
            now.append(token)
    if now:
        parts.append(now)
        follows.append(on)
    return parts, follows


def _chains(text: str) -> list[list[str]]:
    return _parts(text)[0]


def sample(documents: DataFrame, config: CrfConfig) -> list[tuple[str, str]]:
    """(label, window of text) of the training sample, in a fixed order."""
    known = documents.filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    text = F.coalesce("text", F.lit(""))
    hashed = F.xxhash64(text)
    start = F.floor(F.pmod(F.shiftright(hashed, 20), F.lit(1 << 20)) / float(1 << 20)
                    * F.greatest(F.length(text) - config.window, F.lit(0)))
    window = F.substring(text, (start + 1).cast("int"), F.lit(config.window))
    # distinct texts of each label; copies share a hash and count once
    texts = known.select("lang", hashed.alias("h")).distinct()
    texts = materialize(texts, "text-hashes")
    counts = texts.groupBy("lang").agg(F.count("*").alias("_texts"))
    counts = counts.collect()
    if not counts:
        return []
    per_label = max(1, min(config.per_label, config.windows // len(counts)))
    # a bound on the hashes that lets at least per_label texts of a label through, but for chance
    # of far less than 1e-9; the smallest per_label of those are taken
    rates = {r["lang"]: (per_label + 8 * math.sqrt(per_label) + 40) / r["_texts"] for r in counts}
    bounds = F.create_map(*[F.lit(x) for lang, rate in rates.items() for x in (lang, min(rate, 1.0))])
    chance = F.pmod(F.xxhash64(hashed), F.lit(1 << 40)) / float(1 << 40)
    few = texts.withColumn("u", F.pmod(F.xxhash64("h"), F.lit(1 << 40)) / float(1 << 40))
    few = few.filter(F.col("u") < F.element_at(bounds, F.col("lang"))).select("lang", "u", "h")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("u", "h"))
    last = few.withColumn("_place", place).filter(F.col("_place") <= per_label)
    last = last.groupBy("lang").agg(F.max("u").alias("u")).collect()
    bounds = F.create_map(*[F.lit(x) for r in last for x in (r["lang"], r["u"])])
    chosen = known.filter(chance <= F.element_at(bounds, F.col("lang"))).select("lang", hashed.alias("h"), window.alias("t"))
    chosen = chosen.dropDuplicates(["lang", "h"]).orderBy("h", "lang")
    return [(r["lang"], r["t"]) for r in chosen.collect()]


def train(rows: list[tuple[str, str]], config: CrfConfig) -> CrfModel:
    """Fits weights and transitions by Adagrad on the log-likelihood of the sample."""
    found = [(label, chain) for label, text in rows for chain in _chains(text)]
    labels = sorted({label for label, _ in found})
    count, rng = len(labels), np.random.default_rng(config.seed)
    index = {label: i for i, label in enumerate(labels)}
    seen: dict[str, Counter] = defaultdict(Counter)
    for label, chain in found:
        for word in set(chain):
            seen[word][index[label]] += 1
    lexicon = {}
    for word, by in seen.items():
        (top, n), total = by.most_common(1)[0], by.total()
        if n >= 3 and n >= 0.95 * total:
            lexicon[word] = top
    weights = np.zeros((1 << config.bits, count))
    model = CrfModel(labels, weights, np.zeros((count, count)), np.zeros(count), lexicon, config.bits)
    if count < 2:
        return model
    chains = []
    order = rng.permutation(len(found))
    for i, join in zip(order, rng.random(len(order)) < 0.3, strict=True):
        label, words = found[i]
        gold = [index[label]] * len(words)
        if join:
            label, more = found[int(rng.integers(len(found)))]
            words, gold = words + more, gold + [index[label]] * len(more)
        chains.append((words, gold))
    features = {w: np.array(word_features(w, lexicon, config.bits)) for w in seen}
    past = [np.full_like(p, 1e-6) for p in (weights, model.transitions, model.first)]
    for _ in range(config.epochs):
        for low in range(0, len(chains), config.batch):
            part = chains[low : low + config.batch]
            words = [w for ws, _ in part for w in ws]
            gold = np.array([g for _, gs in part for g in gs])
            lengths = np.array([len(ws) for ws, _ in part])
            flat = np.concatenate([features[w] for w in words])
            sizes = np.array([len(features[w]) for w in words])
            begins = np.cumsum(sizes) - sizes
            scores = np.add.reduceat(weights[flat], begins, axis=0)
            posterior, pairs = forward_backward(scores, lengths, model)
            error = posterior.copy()
            error[np.arange(len(gold)), gold] -= 1
            starts = np.cumsum(lengths) - lengths
            follows = np.ones(len(gold), bool)
            follows[starts] = False
            np.subtract.at(pairs, (gold[:-1][follows[1:]], gold[1:][follows[1:]]), 1)
            slope = np.zeros_like(weights)
            np.add.at(slope, flat, np.repeat(error, sizes, axis=0))
            slopes = (slope / len(part), pairs / len(part), error[starts].sum(axis=0) / len(part))
            for value, total, g in zip((weights, model.transitions, model.first), past, slopes, strict=True):
                total += g * g
                value -= config.rate * g / np.sqrt(total)
    return model


class _Emissions:
    """Scores of the distinct words a task has met, at most ``most`` at a time."""

    def __init__(self, model: CrfModel, most: int = 400_000):
        self._model, self._most = model, most
        self._at: dict[str, int] = {}
        self._rows = np.zeros((1024, len(model.labels)), np.float32)

    def of(self, words: list[str]) -> np.ndarray:
        new = [w for w in dict.fromkeys(words) if w not in self._at]
        if new and len(self._at) + len(new) > self._most:
            self._at.clear()
            new = list(dict.fromkeys(words))
        if new:
            model, n = self._model, len(self._at)
            found = [word_features(w, model.lexicon, model.bits) for w in new]
            sizes = np.array([len(f) for f in found])
            flat = np.fromiter(itertools.chain.from_iterable(found), np.int64, sizes.sum())
            if n + len(new) > len(self._rows):
                grown = np.zeros((2 * (n + len(new)), len(model.labels)), np.float32)
                grown[:n] = self._rows[:n]
                self._rows = grown
            self._rows[n : n + len(new)] = np.add.reduceat(model.weights[flat], np.cumsum(sizes) - sizes, axis=0)
            self._at.update(zip(new, range(n, n + len(new)), strict=True))
        return self._rows[np.fromiter(map(self._at.__getitem__, words), np.int64, len(words))]


def _posteriors(texts: list[str], model: CrfModel, emissions: _Emissions):
    """The words of all texts, their posteriors, and the number of words of each text."""
    words: list[str] = []
    lengths, follows, sizes = [], [], []
    for text in texts:
        chains, on = _parts(text)
        lengths += map(len, chains)
        follows += on
        before = len(words)
        for chain in chains:
            words += chain
        sizes.append(len(words) - before)
    if not words:
        return words, np.zeros((0, len(model.labels))), np.array(sizes)
    posterior, _ = forward_backward(emissions.of(words).astype(float), np.array(lengths), model, np.array(follows))
    return words, posterior, np.array(sizes)


def predict(documents: DataFrame, model: CrfModel, pred: str = "lang_pred", score: str = "score") -> DataFrame:
    """The documents with the predicted language and its mean posterior added."""
    fields = [T.StructField(pred, T.StringType()), T.StructField(score, T.DoubleType())]
    schema = T.StructType([*documents.schema.fields, *fields])
    place = documents.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emissions = _Emissions(model) if model.labels else None
        for batch in batches:
            texts = [t or "" for t in batch.column(place).to_pylist()]
            best, means = [], []
            for a, z in text_slices(texts):
                if emissions is None:
                    best += [UNKNOWN] * (z - a)
                    means += [0.0] * (z - a)
                    continue
                _, posterior, sizes = _posteriors(texts[a:z], model, emissions)
                upto = np.vstack([np.zeros((1, len(model.labels))), np.cumsum(posterior, axis=0)])
                ends = np.cumsum(sizes)
                mean = (upto[ends] - upto[ends - sizes]) / np.maximum(sizes, 1)[:, None]
                top = mean.argmax(axis=1)
                best += [model.labels[k] if n else UNKNOWN for k, n in zip(top, sizes, strict=True)]
                means += np.clip(mean.max(axis=1), 0, 1).tolist()
            columns = [*batch.columns, pa.array(best, pa.string()), pa.array(means, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_texts(documents, task, schema)


def tag_words(documents: DataFrame, model: CrfModel, key: str = "doc_id") -> DataFrame:
    """key, words: array of (word, lang, posterior), for code-switched text."""
    word = T.StructType(
        [T.StructField("word", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("posterior", T.DoubleType())]
    )
    schema = T.StructType([documents.schema[key], T.StructField("words", T.ArrayType(word))])
    kind = pa.list_(pa.struct([("word", pa.string()), ("lang", pa.string()), ("posterior", pa.float64())]))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emissions = _Emissions(model)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, z in text_slices(texts):
                words, posterior, sizes = _posteriors(texts[a:z], model, emissions)
                tags = [model.labels[k] for k in posterior.argmax(axis=1)] if words else []
                rows = list(zip(words, tags, posterior.max(axis=1).tolist() if words else [], strict=True))
                ends = np.cumsum(sizes)
                cut = [rows[e - n : e] for e, n in zip(ends, sizes, strict=True)]
                yield pa.record_batch([batch.column(0).slice(a, z - a), pa.array(cut, kind)], names=schema.names)

    return map_texts(documents.select(key, "text"), task, schema)


def fit(documents: DataFrame, config: CrfConfig | None = None) -> CrfModel:
    config = config or CrfConfig()
    return train(sample(documents, config), config)


def identify(documents: DataFrame, config: CrfConfig | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score of every document; learns from the others' labels."""
    model = fit(documents, config)
    given = documents.select("doc_id", "text")
    return predict(given, model).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
