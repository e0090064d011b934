"""Document quality by a regularised quadratic discriminant.

Every text gives a fixed vector of statistics, transformed to be roughly symmetric (logs of
counts, square roots of shares). Class means and covariances come from sums and products
over all labelled documents, in one aggregation. Each class covariance is shrunk towards
the pooled one and then towards a diagonal; its Cholesky factor is inverted once, so the
Mahalanobis distance of a document is the length of a product. The score is the posterior
of class 1: the logistic function of the log-density difference plus the log prior odds.

Defined cases: a null text is empty, and an empty text has the statistics zero; a class
without labelled documents gets the pooled mean and covariance, without any labels all
scores are 0.5; labels other than 0 and 1 are ignored; several labels of a document count
each; repeated rows are scored each; a null doc_id has no label and is never held out; an
empty table gives no rows. Other columns, and any clashing names, stay as they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airstrata.llm.common import held_out, map_texts

STATISTICS = (
    "chars", "words", "word_length", "upper", "lower", "digits", "spaces", "lines", "commas",
    "ends", "bars", "symbols", "wide", "distinct_words", "repeated_lines", "capital_words", "short_words",
)
# byte classes: upper, lower, digit, space, line feed, comma-like, sentence end, bar, other symbol, wide
_CLASS = np.full(256, 8, np.uint8)
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 9
for _codes, _kind in ((b" \t\r\x0b\x0c", 3), (b"\n", 4), (b",;:'\"()-", 5), (b".!?", 6), (b"|<>[]{}/\\_", 7)):
    _CLASS[list(_codes)] = _kind


@dataclass(frozen=True)
class QdaConfig:
    pooled: float = 0.1
    diagonal: float = 0.02
    accept: float = 0.7


@dataclass(frozen=True)
class QdaModel:
    """For class 0 and 1: mean, inverse Cholesky factor, log of the determinant, log prior."""

    means: np.ndarray
    factors: np.ndarray
    log_dets: np.ndarray
    log_priors: np.ndarray
    learned: int  # labels it rests on

    def score(self, values: np.ndarray) -> np.ndarray:
        density = []
        for k in (0, 1):
            spread = (values - self.means[k]) @ self.factors[k].T
            density.append(self.log_priors[k] - 0.5 * ((spread**2).sum(axis=1) + self.log_dets[k]))
        return 1 / (1 + np.exp(np.clip(density[0] - density[1], -700, 700)))


def statistics(text: str) -> list[float]:
    data = text.encode()
    if not data:
        return [0.0] * len(STATISTICS)
    size = len(data)
    kinds = np.bincount(_CLASS[np.frombuffer(data, np.uint8)], minlength=10) / size
    words, lines = text.split(), text.split("\n")
    n = max(1, len(words))
    capital = sum(map(str.isupper, words))
    short = sum(len(w) < 4 for w in words)
    upper, lower, digits, spaces, feeds, commas, ends, bars, symbols, wide = np.sqrt(kinds).tolist()
    return [
        np.log1p(len(text)), np.log1p(len(words)), np.log1p(len(text) / n), upper, lower, digits, spaces, feeds,
        commas, ends, bars, symbols, wide, np.sqrt(len(set(words)) / n),
        np.sqrt(1 - len(set(lines)) / len(lines)), np.sqrt(capital / n), np.sqrt(short / n),
    ]


def measure(documents: DataFrame) -> DataFrame:
    """doc_id and the statistics of every text."""
    schema = T.StructType([documents.schema["doc_id"], T.StructField("stats", T.ArrayType(T.DoubleType()))])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t or "") for t in batch.column(1).to_pylist()]
            yield pa.record_batch([batch.column(0), pa.array(rows, pa.list_(pa.float64()))], names=schema.names)

    return map_texts(documents.select("doc_id", "text"), task, schema)


def fit(documents: DataFrame, labels: DataFrame, config: QdaConfig | None = None) -> QdaModel:
    """Learns from all labelled documents that are not held out."""
    config = config or QdaConfig()
    known = labels.filter("quality IN (0, 1)").select(F.col("doc_id").alias("_id"), "quality")
    known = known.filter(~held_out(F.col("_id")))
    stats = measure(documents.filter(~held_out(F.col("doc_id"))))
    rows = stats.join(known, stats["doc_id"] == known["_id"])
    d = len(STATISTICS)
    x = [F.col("stats")[i] for i in range(d)]
    sums = [F.sum(v).alias(f"s{i}") for i, v in enumerate(x)]
    products = [F.sum(x[i] * x[j]).alias(f"p{i}_{j}") for i in range(d) for j in range(i + 1)]
    found = {r["quality"]: r for r in rows.groupBy("quality").agg(F.count("*").alias("n"), *sums, *products).collect()}
    counts, totals, squares = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
    for k, r in found.items():
        counts[k] = r["n"]
        totals[k] = [r[f"s{i}"] for i in range(d)]
        for i in range(d):
            for j in range(i + 1):
                squares[k, i, j] = squares[k, j, i] = r[f"p{i}_{j}"]
    return shrink(counts, totals, squares, config)


def shrink(counts: np.ndarray, totals: np.ndarray, squares: np.ndarray, config: QdaConfig) -> QdaModel:
    d, n = totals.shape[1], counts.sum()
    centre = totals.sum(axis=0) / max(n, 1)
    means = np.array([totals[k] / counts[k] if counts[k] else centre for k in (0, 1)])
    scatter = [squares[k] - counts[k] * np.outer(means[k], means[k]) for k in (0, 1)]
    pooled = sum(scatter) / max(n, 1)
    scale = np.where(np.diag(pooled) > 1e-12, np.diag(pooled), 1.0)
    factors, log_dets = [], []
    for k in (0, 1):
        own = scatter[k] / counts[k] if counts[k] else pooled
        cov = (1 - config.pooled) * own + config.pooled * pooled
        cov = (1 - config.diagonal) * cov + config.diagonal * np.diag(scale)
        lower = np.linalg.cholesky(cov + 1e-9 * np.diag(scale))
        factors.append(np.linalg.inv(lower))
        log_dets.append(2 * np.log(np.diag(lower)).sum())
    priors = np.log((counts + 1) / (n + 2))
    return QdaModel(means, np.array(factors).reshape(2, d, d), np.array(log_dets), priors, int(n))


def score(documents: DataFrame, model: QdaModel, name: str = "score") -> DataFrame:
    """The documents with the score of every whole text added."""
    schema = T.StructType([*documents.schema.fields, T.StructField(name, T.DoubleType())])
    place = documents.columns.index("text")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [statistics(t or "") for t in batch.column(place).to_pylist()]
            scores = model.score(np.array(rows).reshape(len(rows), len(STATISTICS)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64())], names=schema.names)

    return map_texts(documents, task, schema)


def classify(documents: DataFrame, labels: DataFrame, config: QdaConfig | None = None) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    config = config or QdaConfig()
    scored = score(documents.select("doc_id", "text"), fit(documents, labels, config))
    accept = F.when(F.col("score") >= config.accept, 1).otherwise(0)
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", accept.cast("int").alias("predicted")
    )
