"""SentencePiece encoding and decoding over a table of distinct chunks.

In a model none of whose pieces holds a white space marker behind another character,
merges never cross from one marked word to the next. So each distinct chunk (a run of
markers with the word that follows) is segmented once per task, and the ids of a text
are those of its chunks, joined back by position. The table of a task is bounded and
stays in the task: the chunks of a corpus grow with it, so a table of all of them can
be broadcast to nobody, and shuffling every (text block, chunk) pair there and back
costs more than segmenting a word again in another task.

Defined cases: a null or empty text has only the begin and end id and decodes to the
empty text; white space, line feeds, markers inside the text and characters outside the
vocabulary give what the library gives. Every row gives a row, repeated rows too; a null
id stays; other columns of the input are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airstrata.llm.common import ChunkTable, map_texts, text_slices

MARK = "▁"
_CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
_CROSSING = re.compile(f"[^{MARK}]{MARK}")


def check_model(processor) -> None:
    """Refuses models whose pieces can cross from one marked word to the next."""
    bad = [i for i in range(processor.vocab_size()) if _CROSSING.search(processor.id_to_piece(i))]
    if bad:
        raise ValueError(f"pieces cross white space markers: {bad[:5]}")


def _chunks(text: str) -> list[str]:
    return _CHUNK.findall(MARK + text.replace(" ", MARK)) if text else []


def _encode_texts(
    texts: list[str], table: ChunkTable, begin: int, end: int
) -> tuple[list[np.ndarray], list[list[int]]]:
    """The ids of each text and the table rows of its chunks."""
    chunks = [_chunks(t) for t in texts]
    rows = table.find([c for doc in chunks for c in doc])
    flat, upto = table.ids(rows)
    stops = np.cumsum([len(doc) for doc in chunks])
    ends = np.concatenate([[0], upto])[stops] if len(rows) else np.zeros(len(texts), np.int64)
    begins = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    ids = [
        np.concatenate([[begin], flat[a:z], [end]]).astype("<u4")
        for a, z in zip(begins, ends, strict=True)
    ]
    return ids, [part.tolist() for part in np.split(rows, stops[:-1])]


def encode(
    documents: DataFrame,
    model_path: str,
    text: str = "text",
    key: str = "doc_id",
    decoded: bool = False,
    most: int = 400_000,
) -> DataFrame:
    """key, n_tokens, ids (little-endian unsigned 32-bit integers with begin and end id).

    With ``decoded`` also the text that the library's decode makes of the ids: each distinct
    chunk's ids are decoded once, and the parts joined by position. A task's table starts
    anew at ``most`` chunks.
    """
    fields = [
        T.StructField(key, documents.schema[key].dataType),
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids", T.BinaryType()),
    ]
    if decoded:
        fields.append(T.StructField("decoded", T.StringType()))
    schema = T.StructType(fields)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=model_path)
        check_model(processor)
        lone = processor.piece_to_id(MARK)

        def segment(chunks: list[str]) -> list[list[int]]:
            # the library puts the first marker itself, but gives nothing for an empty text
            found = processor.encode([c[1:] for c in chunks], num_threads=1)
            return [ids or [lone] for ids in found]

        def spell(found: list[list[int]]) -> list[str]:
            # every chunk begins with a marked piece, whose marker decode drops: it is a space
            return [" " + part for part in processor.decode(found, num_threads=1)]

        table = ChunkTable(segment, most, spell if decoded else None)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for a, z in text_slices(texts, 500_000):
                ids, rows = _encode_texts(texts[a:z], table, processor.bos_id(), processor.eos_id())
                columns = [
                    batch.column(0).slice(a, z - a),
                    pa.array([len(x) for x in ids], pa.int64()),
                    pa.array([x.tobytes() for x in ids], pa.binary()),
                ]
                if decoded:
                    whole = ["".join(map(table.texts.__getitem__, part))[1:] for part in rows]
                    columns.append(pa.array(whole, pa.string()))
                yield pa.record_batch(columns, names=schema.names)

    return map_texts(documents.select(key, text), task, schema)


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """Adds decoded, the text that the library's decode makes of all ids of a row.

    Ids are cut before each piece that starts a marked word; every distinct run of ids is
    decoded once, and the parts are joined by position.
    """
    schema = T.StructType([*encoded.schema.fields, T.StructField("decoded", T.StringType())])
    place = encoded.columns.index("ids")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece

        processor = sentencepiece.SentencePieceProcessor(model_file=model_path)
        size = processor.vocab_size()
        pieces = [processor.id_to_piece(i) for i in range(size)]
        silent = np.array([processor.is_control(i) for i in range(size)])
        marked = np.array([p.startswith(MARK) for p in pieces])
        known: dict[bytes, str] = {}

        def part(run: bytes) -> str:
            # a run starts with a marked piece: its first marker, which decode drops, is a space
            text = known.get(run)
            if text is None:
                if len(known) > 100_000:
                    known.clear()
                text = known[run] = " " + processor.decode(np.frombuffer(run, "<u4").tolist())
            return text

        def whole(data: bytes) -> str:
            ids = np.frombuffer(data, "<u4")
            ids = ids[~silent[ids]]
            cuts = np.flatnonzero(marked[ids])
            if not len(cuts) or cuts[0]:
                return processor.decode(ids.tolist())
            raw, at = ids.tobytes(), (cuts * 4).tolist()
            return "".join(map(part, map(raw.__getitem__, map(slice, at, [*at[1:], None]))))[1:]

        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part_of = batch.slice(low, 500)
                texts = [whole(x.as_py()) for x in part_of.column(place)]
                yield pa.record_batch([*part_of.columns, pa.array(texts, pa.string())], names=schema.names)

    return map_texts(encoded, task, schema)


def digests(documents: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every whole text."""
    both = encode(documents, model_path, decoded=True)
    return both.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
