from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from airstrata.llm import collocations
from airstrata.llm.collocations import PhraseConfig
from tests.llm.helpers import documents, odd_rows


def pieces(value):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in value or "")
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", low)]


def counts(rows, most):
    found, total = Counter(), Counter()
    for r in rows:
        lang = "und" if r[2] is None else r[2]
        for words in pieces(r[1]):
            total[lang] += len(words)
            for size in range(1, most + 1):
                for i in range(len(words) - size + 1):
                    found[lang, tuple(words[i : i + size])] += 1
    return found, total


def brute(rows, config):
    found, total = counts(rows, config.max_words)
    kept = {}
    for (lang, words), a in found.items():
        if len(words) < 2 or a < config.least:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = found[lang, words[:k]], found[lang, words[k:]]
            cuts.append((1000 * a * total[lang] // (left * right), k, left, right))
        kept[lang, words] = (a, min(cuts))
    covered = set()
    for (lang, words), (a, _) in kept.items():
        for size in range(2, len(words)):
            for i in range(len(words) - size + 1):
                inner = kept.get((lang, words[i : i + size]))
                if inner and 100 * a >= config.covered * inner[0]:
                    covered.add((lang, words[i : i + size]))
    out = []
    for lang in total:
        mine = [(w, *v) for (g, w), v in kept.items() if g == lang and (g, w) not in covered]
        mine.sort(key=lambda x: (-x[2][0], -x[1], " ".join(x[0]).encode()))
        for rank, (words, a, (score, _, left, right)) in enumerate(mine[: config.top], 1):
            out.append((lang, rank, " ".join(words), a, left, right, total[lang], score))
    return sorted(out)


def corpus():
    rng = random.Random(4)
    vocabulary = [f"w{i}" for i in range(30)] + ["Été", "NEW", "\x01", " x"]
    rows = odd_rows()
    for i in range(150):
        words = rng.choices(vocabulary, weights=[1 + 40 // (1 + j) for j in range(len(vocabulary))], k=rng.randrange(60))
        for phrase in ("new york city hall", "of course", "a b c d e f g"):
            if rng.random() < 0.6:
                words[rng.randrange(len(words) + 1) : 0] = phrase.split()
        marked = [w + rng.choice(["", "", "", "", ".", ",\t", "\n", "\x0b", " "]) for w in words]
        rows.append((500 + i, " ".join(marked), rng.choice(["en", "en", "fr", None]), "s", 0, "", "", ""))
    copy = "same words in every copy of this text. new york city hall\nof course"
    rows += [(9000 + i, copy, "en", "hot", 0, "", "", "") for i in range(120)]
    rows += [(9500, "go " * 3000, "de", "hot", 0, "", "", "")] * 3
    return rows


@pytest.mark.parametrize(
    "config",
    [
        PhraseConfig(least=20, modulus=5),
        PhraseConfig(least=3, top=15, modulus=1, bits=12),
        PhraseConfig(max_words=2, least=10),
        PhraseConfig(max_words=3, least=2, covered=80, modulus=1000, bits=7),
    ],
)
def test_equals_brute_force(spark, config):
    rows = corpus()
    got = collocations.collocations(documents(spark, rows).repartition(3), config)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, config)


def test_every_owned_gram_is_in_one_chunk():
    config = PhraseConfig(modulus=3)
    known = collocations._Hashes()
    value = " ".join(f"w{i * i % 23}" + ("." if i % 11 == 3 else "") for i in range(400))
    run = collocations.tokens(value)
    chunks = list(collocations.parse(value, known, config))
    width = config.max_words - 1
    owned = [t for chunk, _ in chunks for t in chunk.split(b" ")[:-width]]
    assert owned == run  # without their last windows the chunks are the text
    assert sum(n for _, n in chunks) == 400
    for (one, _), (two, _) in zip(chunks, chunks[1:], strict=False):
        assert one.split(b" ")[-width:] == two.split(b" ")[:width]


def test_copies_add_no_chunk(spark):
    value = " ".join(f"w{i % 97}" for i in range(3000))
    rows = [(i, value, "en", "s", 0, "", "", "") for i in range(40)]
    one = collocations.dictionary(documents(spark, rows[:1]), PhraseConfig())
    many = collocations.dictionary(documents(spark, rows), PhraseConfig())
    assert many.count() == one.count()
    assert many.agg({"freq": "sum"}).first()[0] == 40 * one.agg({"freq": "sum"}).first()[0]


def test_nothing_to_find(spark):
    assert collocations.collocations(documents(spark, [])).collect() == []
    assert collocations.collocations(documents(spark, odd_rows()[:1])).collect() == []
