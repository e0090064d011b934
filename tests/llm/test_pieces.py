from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from airstrata.llm import pieces
from airstrata.llm.common import ChunkTable, text_slices
from tests.llm.helpers import documents, odd_rows

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def test_equals_the_library(spark):
    rng = random.Random(4)
    alphabet = [*"ab  \n\t▁é漢😀 .,<s>", "the ", "</s>", "   ", "ﬁ", "́", "<0x0A>", "▁▁"]
    rows = odd_rows() + [
        (100 + i, "".join(rng.choices(alphabet, k=rng.randrange(60))), *[None] * 6) for i in range(800)
    ]
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    want = []
    for doc_id, text, *_ in rows:
        ids = library.encode(text or "", add_bos=True, add_eos=True)
        packed, plain = np.array(ids, "<u4").tobytes(), library.decode(ids)
        want.append((doc_id, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(plain.encode()).hexdigest()))
    got = [tuple(r) for r in pieces.digests(documents(spark, rows), MODEL).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_empty_table(spark):
    assert pieces.digests(documents(spark, []), MODEL).count() == 0


def test_table_starts_anew_at_its_bound():
    calls = []

    def encode(chunks):
        calls.append(list(chunks))
        return [[ord(c) for c in chunk] for chunk in chunks]

    table = ChunkTable(encode, most=3)
    for chunks in (["a", "bb", "a"], ["c"], ["d", "a", "bb", "c", "e"], []):
        flat, ends = table.ids(table.find(chunks))
        assert "".join(map(chr, flat)) == "".join(chunks) and len(ends) == len(chunks)
    assert calls[0] == ["a", "bb"] and calls[1] == ["c"]


def test_models_that_cross_words_are_refused():
    class Crossing:
        vocab_size = lambda self: 1
        id_to_piece = lambda self, i: "a▁b"

    with pytest.raises(ValueError):
        pieces.check_model(Crossing())


def test_slices_cover_all_rows():
    assert list(text_slices(["aa", "b", "cccc", ""], 3)) == [(0, 2), (2, 3), (3, 4)]
    assert list(text_slices([], 3)) == []
