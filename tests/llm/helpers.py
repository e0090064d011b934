"""Small tables with awkward rows, for all corpus operators."""

from __future__ import annotations

import random

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long, key string, id string, score string"


def words(seed: int, count: int, vocabulary: int = 400) -> list[str]:
    rng = random.Random(seed)
    return [f"w{chr(97 + i % 26)}{i}" for i in (rng.randrange(vocabulary) for _ in range(count))]


def text(seed: int, count: int) -> str:
    found = words(seed, count)
    return "".join(w + (".\n" if i % 17 == 16 else ". " if i % 7 == 6 else " ") for i, w in enumerate(found))


def odd_rows() -> list[tuple]:
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    base = text(1, 120)
    rows = [
        (1, base, "en", "a", len(base)),
        (2, base, "en", "a", len(base)),
        (2, base, "en", "a", len(base)),
        (3, base.replace("w", "v", 1), None, "b", 3),
        (4, None, "de", "b", None),
        (5, "", None, None, 0),
        (6, " \n\t ", "de", None, 4),
        (7, "One.", "fr", "a", 4),
        (8, "12 34 !!", "fr", "c", 8),
        (None, text(2, 40), "fr", "c", 1),
        (None, None, None, None, None),
        (9, text(3, 30_000), "de", "a", 1),
        (10, "x" * 20_000, "en", "d", 1),
        (11, "é漢😀 ▁mark  two   three \r\n\n end", "fr", "", 1),
        (12, text(4, 3), "en", "a", 1),
        (2, text(5, 60), "en", "b", 1),
    ]
    return [(*r, "k", "i", "s") for r in rows]


def documents(spark, rows=None):
    return spark.createDataFrame(odd_rows() if rows is None else rows, DOCUMENTS)


def plain(frame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.collect()), key=repr)
