"""Token counts of the parts of a document, from one encoding of the whole.

A document is given as its parts in order (fields, sections). The whole text is encoded
once with a byte-level BPE; every token has the span of code points that its bytes touch.
Token spans and part spans are both in order, so the interval join is a merge: each part
touches one run of tokens. A token that touches several parts is allocated by a rule:

    first   to the part in which it begins
    most    to the part that holds most of its code points, the earlier one in a tie
    share   to all of them, by their share of its code points

With every rule the allocated tokens of a document add up to its number of tokens. A
token that ends inside a character touches that character.

Defined cases: null or empty parts have no tokens and touch none; a null list of parts is
an empty document; names may be null or repeated, as parts go by their number; repeated
rows are counted each; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airstrata.llm.common import map_texts

RULES = ("first", "most", "share")
PARAGRAPH = "[^\n]*\n|[^\n]+"
_PART = T.StructType(
    [
        T.StructField("part", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        T.StructField("touching", T.LongType()),
        T.StructField("crossing", T.LongType()),
        T.StructField("tokens", T.DoubleType()),
    ]
)


def byte_bpe(ranks_path: str, pattern: str):
    """The tokenizer of a file of ranks, and the byte length of each id."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    lengths = np.zeros(max(ranks.values()) + 1, np.int64)
    for piece, rank in ranks.items():
        lengths[rank] = len(piece)
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), lengths


def token_spans(data: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First code point and end of each token, from the byte lengths of the tokens."""
    ends = np.cumsum(lengths)
    point = np.cumsum((np.frombuffer(data, np.uint8) & 0xC0) != 0x80) - 1
    return point[ends - lengths], point[ends - 1] + 1


def allocate(
    starts: np.ndarray, stops: np.ndarray, part_starts: np.ndarray, part_stops: np.ndarray, rule: str
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per part: tokens that touch it, those that also touch another one, tokens allocated.

    All four arrays are in order; parts follow each other without gap.
    """
    parts = len(part_starts)
    low = np.searchsorted(stops, part_starts, "right")
    high = np.maximum(np.searchsorted(starts, part_stops, "left"), low)
    high = np.where(part_starts < part_stops, high, low)
    touching = high - low
    part = np.repeat(np.arange(parts), touching)
    token = np.arange(touching.sum()) - np.repeat(np.cumsum(touching) - touching, touching) + np.repeat(low, touching)
    times = np.bincount(token, minlength=len(starts))
    crosses = times[token] > 1
    crossing = np.bincount(part[crosses], minlength=parts)
    given = np.bincount(part[~crosses], minlength=parts).astype(float)
    part, token = part[crosses], token[crosses]
    overlap = np.minimum(stops[token], part_stops[part]) - np.maximum(starts[token], part_starts[part])
    if rule == "share":
        given += np.bincount(part, overlap / (stops[token] - starts[token]), minlength=parts)
    elif len(part):
        rank = np.zeros(len(part)) if rule == "first" else -overlap
        best = np.lexsort((part, rank, token))
        winner = best[np.unique(token[best], return_index=True)[1]]
        given += np.bincount(part[winner], minlength=parts)
    return touching, crossing, given


def attribute(documents: DataFrame, parts: str, key: str, ranks_path: str, pattern: str, rule: str = "most") -> DataFrame:
    """key, n_tokens, parts: array of (part, name, n_chars, touching, crossing, tokens).

    ``parts`` names a column of type array<struct<name: string, text: string>>.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    schema = T.StructType(
        [
            T.StructField(key, documents.schema[key].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("parts", T.ArrayType(_PART)),
        ]
    )

    def document(texts: list[str], encoding, byte_lengths: np.ndarray):
        whole = "".join(texts)
        ids = np.array(encoding.encode_ordinary(whole), dtype=np.int64)
        ends = np.cumsum([len(t) for t in texts])
        spans = token_spans(whole.encode(), byte_lengths[ids])
        return len(ids), allocate(*spans, ends - [len(t) for t in texts], ends, rule)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, byte_lengths = byte_bpe(ranks_path, pattern)
        nothing = np.zeros(0)
        for batch in batches:
            counts, rows = [], []
            for given in batch.column(1).to_pylist():
                given = given or []
                texts = [p["text"] or "" for p in given]
                n, found = document(texts, encoding, byte_lengths) if any(texts) else (0, None)
                zeros = [np.zeros(len(given))] * 3 if given else [nothing] * 3
                touching, crossing, tokens = found or zeros
                counts.append(n)
                rows.append(
                    [
                        (i, p["name"], len(t), int(touching[i]), int(crossing[i]), float(tokens[i]))
                        for i, (p, t) in enumerate(zip(given, texts, strict=True))
                    ]
                )
            yield pa.record_batch(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(rows, _arrow_parts())],
                names=schema.names,
            )

    return map_texts(documents.select(key, parts), task, schema)


def _arrow_parts() -> pa.DataType:
    fields = [
        ("part", pa.int32()), ("name", pa.string()), ("n_chars", pa.int64()),
        ("touching", pa.int64()), ("crossing", pa.int64()), ("tokens", pa.float64()),
    ]
    return pa.list_(pa.struct(fields))


def document_parts(source: Column, lang: Column, text: Column) -> Column:
    """The fields of a document, then its paragraphs; each field ends with a space."""

    def field(name: str, value: Column) -> Column:
        return F.struct(F.lit(name).alias("name"), F.concat(F.coalesce(value, F.lit("")), F.lit(" ")).alias("text"))

    paragraphs = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(PARAGRAPH), F.lit(0))
    return F.concat(
        F.array(field("source", source), field("lang", lang)),
        F.transform(paragraphs, lambda p: F.struct(F.lit("paragraph").alias("name"), p.alias("text"))),
    )


def section_tokens(documents: DataFrame, ranks_path: str, pattern: str, rule: str = "most") -> DataFrame:
    """One row per part of every document: its tokens, and those that cross its borders."""
    given = documents.select(
        "doc_id", document_parts(F.col("source"), F.col("lang"), F.col("text")).alias("parts")
    )
    counted = attribute(given, "parts", "doc_id", ranks_path, pattern, rule)
    return counted.select("doc_id", "n_tokens", F.inline("parts"))
