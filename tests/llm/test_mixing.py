from __future__ import annotations

import re
from collections import defaultdict

import pytest

from airstrata.llm import mixing
from tests.llm.helpers import documents, odd_rows, text


def sizes(rows):
    return [len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows]


def goals(rows):
    """Targets by repeated resharing, written out."""
    total = defaultdict(int)
    for r, n in zip(rows, sizes(rows), strict=True):
        total[r[3]] += n
    names = sorted(total, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, target, open_ = 1.5 * sum(total.values()), {}, list(names)
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = [s for s in open_ if weight[s] * level > 2 * total[s]]
        if not full:
            target |= {s: weight[s] * level for s in open_}
            break
        for s in full:
            target[s] = 2 * total[s]
            left -= 2 * total[s]
            open_.remove(s)
    return total, target


@pytest.mark.parametrize("block", [7, 256])
def test_targets_and_taken(spark, block):
    rows = odd_rows() + [(100 + i, text(i, 50 + i), None, "hot" if i % 3 else f"s{i % 11}", 0, "", "", "") for i in range(120)]
    total, target = goals(rows)
    found = mixing.taken_words(documents(spark, rows), mixing.MixConfig(block_words=block)).collect()
    assert sorted((repr(r["doc_id"]), r["size"]) for r in found) == sorted((repr(r[0]), n) for r, n in zip(rows, sizes(rows), strict=True))
    assert all(r["taken"] <= 2 * r["size"] for r in found)
    by = defaultdict(int)
    for r in found:
        by[(r["source_size"], round(r["target"], 6))] += r["taken"]
    wanted = defaultdict(int)
    for s in total:
        wanted[(total[s], round(target[s], 6))] += int(target[s] + 0.5)
    assert dict(by) == {k: v for k, v in wanted.items()}


def test_reruns_and_partitions_agree(spark):
    frame = documents(spark)
    take = lambda f: sorted(map(repr, mixing.taken_words(f).collect()))
    assert take(frame) == take(frame.repartition(7))


def test_mixed_documents_hold_what_is_taken(spark):
    frame = documents(spark)
    placed, pieces = mixing.mix(frame)
    mixed = mixing.mixed_documents(frame)
    assert mixed.columns == frame.columns
    got = mixed.select(mixing.word_count(mixed["text"]).alias("n"), "key", "n_chars", "text").collect()
    assert sum(r["n"] for r in got) == pieces.agg({"words": "sum"}).first()[0]
    assert all(r["key"] == "k" and r["n_chars"] == len(r["text"]) for r in got)
    starts = {(r[1] or "")[:40] for r in odd_rows()}
    assert all(r["text"][:40] in starts or any(s.startswith(r["text"]) for s in starts) for r in got)
    assert placed.count() == len(odd_rows())


def test_schedule_spreads_sources(spark):
    targets = spark.createDataFrame([("a", 10_000, 9000.0), ("b", 10_000, 900.0), (None, 10, 20.0)], "source string, source_size long, target double")
    config = mixing.MixConfig(block_words=10)
    rows = sorted(mixing.schedule(targets, config).collect())
    for source, need in (("a", 900), ("b", 90), (None, 2)):
        own = [r for r in rows if r["source"] == source]
        assert [r["rank"] for r in own] == list(range(need))
    seen = 0
    for i, r in enumerate(rows[:900], 1):
        seen += r["source"] == "b"
        assert abs(seen - i * 900 / 9920) < 4


def test_nothing_to_take(spark):
    assert mixing.taken_words(documents(spark, [])).count() == 0
    row = mixing.taken_words(documents(spark, [(1, None, *[None] * 6)])).first()
    assert (row["size"], row["target"], row["taken"]) == (0, 0.0, 0)
    assert mixing.mixed_documents(documents(spark, [(1, " ", *[None] * 6)])).count() == 0


def test_whole_documents_miss_a_target_by_half_a_document_at_most(spark):
    rows = odd_rows() + [(100 + i, text(i, 50 + 7 * i), None, f"s{i % 5}", 0, "", "", "") for i in range(60)]
    total, target = goals(rows)
    mixed = mixing.mixed_documents(documents(spark, rows), whole=True)
    got = mixed.collect()
    assert {r["text"] for r in got} <= {r[1] for r in rows}
    words = defaultdict(int)
    for r in got:
        words[r["source"]] += len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or ""))
    longest = defaultdict(int)
    for r, n in zip(rows, sizes(rows), strict=True):
        longest[r[3]] = max(longest[r[3]], n)
    assert all(abs(words[s] - target[s]) <= longest[s] / 2 + 1 for s in total)
