from __future__ import annotations

from collections import Counter

import public_tokenizers
import pytest

from airstrata.llm import token_counts
from tests.llm.helpers import documents, odd_rows

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
SCHEMA = "doc_id long, name string, parts array<struct<name: string, text: string>>"


def brute(texts, rule, encoding):
    """Code point by code point: which token touches which part."""
    whole = "".join(texts)
    at = [i for i, c in enumerate(whole) for _ in c.encode()]
    part_of = [k for k, t in enumerate(texts) for _ in t]
    touching, crossing, given = Counter(), Counter(), Counter()
    place = 0
    for token in encoding.encode_ordinary(whole):
        size = len(encoding.decode_single_token_bytes(token))
        points = sorted(set(at[place : place + size]))
        place += size
        held = Counter(part_of[i] for i in points)
        for k in held:
            touching[k] += 1
            crossing[k] += len(held) > 1
            given[k] += held[k] / len(points) if rule == "share" else 0
        if rule == "first":
            given[part_of[points[0]]] += 1
        if rule == "most":
            given[min(held, key=lambda k: (-held[k], k))] += 1
    return [(len(t), touching[k], crossing[k], pytest.approx(given[k])) for k, t in enumerate(texts)]


@pytest.mark.parametrize("rule", token_counts.RULES)
def test_against_brute_force(spark, rule):
    lists = [
        ["Hello", " wor", "ld, this", " ", " is", "é漢", "😀😀", "", "\n\nend"],
        ["token", "ization of un", "break", "able", "ness"],
        ["", ""],
        [],
        ["a"],
        ["漢", "字", "漢字" * 50],
        ["x " * 3000, "y" * 500],
    ]
    rows = [(i, "n", [("p", t or None) for t in texts]) for i, texts in enumerate(lists)] + [(99, None, None)]
    encoding, _ = token_counts.byte_bpe(RANKS, PATTERN)
    found = token_counts.attribute(spark.createDataFrame(rows, SCHEMA), "parts", "doc_id", RANKS, PATTERN, rule)
    for r in found.collect():
        texts = lists[r["doc_id"]] if r["doc_id"] < 99 else []
        assert r["n_tokens"] == len(encoding.encode_ordinary("".join(texts)))
        assert [(p["n_chars"], p["touching"], p["crossing"], p["tokens"]) for p in r["parts"]] == brute(texts, rule, encoding)
        assert sum(p["tokens"] for p in r["parts"]) == pytest.approx(r["n_tokens"])


def test_documents_add_up(spark):
    rows = token_counts.section_tokens(documents(spark), RANKS, PATTERN).collect()
    encoding, _ = token_counts.byte_bpe(RANKS, PATTERN)
    want = Counter((repr(r[0]), len(encoding.encode_ordinary(f"{r[3] or ''} {r[2] or ''} {r[1] or ''}"))) for r in odd_rows())
    assert Counter((repr(r["doc_id"]), r["n_tokens"]) for r in rows if r["part"] == 0) == want
    assert sum(r["tokens"] for r in rows) == sum(n * k for (_, n), k in want.items())
    assert token_counts.section_tokens(documents(spark, []), RANKS, PATTERN).count() == 0
    with pytest.raises(ValueError):
        token_counts.section_tokens(documents(spark), RANKS, PATTERN, "none")
