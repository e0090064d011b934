from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from airstrata.llm import line_dedup
from airstrata.llm.line_dedup import LineConfig, PerfectHash
from tests.llm.helpers import documents, odd_rows, text

SPACE = " \t\n\x0b\x0c\r"


def key(line):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in line.strip(SPACE))


def brute(rows, config):
    docs = [(r[1] or "").split("\n") for r in rows]
    held = Counter(k for lines in docs for k in {key(x) for x in lines})
    bad = {k for k, n in held.items() if n >= config.documents and len(k) >= config.least_chars}
    out = []
    for r, lines in zip(rows, docs, strict=True):
        kept = [x for x in lines if key(x) not in bad]
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((r[0], len(lines), len(lines) - len(kept), digest))
    return sorted(out, key=repr)


def corpus():
    rows = odd_rows()
    for i in range(60):
        shared = ["  All RIGHTS reserved\t", "É été\r", "x", f"rare {i // 9}", f"own {i}", "", " nbsp "]
        lines = shared[i % 3 :] + (["twice", "twice"] if i < 5 else [])
        rows.append((1000 + i, "\n".join(lines), "en", "hot", 0, "", "", ""))
    rows += [(3000, "Only here\nand here", "en", "hot", 0, "", "", "")] * 12
    rows.append((3001, "a\n" * 20_000 + "only here", "en", "hot", 0, "", "", ""))
    return rows


@pytest.mark.parametrize(
    "config",
    [LineConfig(), LineConfig(documents=2, shard_keys=7), LineConfig(documents=5, least_chars=2, shard_keys=50)],
)
def test_equals_brute_force(spark, config):
    rows = corpus()
    got = line_dedup.digests(documents(spark, rows).repartition(4), config)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "kept_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, config)


def test_kept_texts_and_empty_tables(spark):
    assert line_dedup.drop_lines(documents(spark, [])).collect() == []
    rows = [(i, f"mine {i}\n Shared \n{text(i, 5)}", "en", "a", 0, "", "", "") for i in range(10)]
    kept = {r["doc_id"]: r["kept_text"] for r in line_dedup.drop_lines(documents(spark, rows)).collect()}
    assert kept == {i: f"mine {i}\n{text(i, 5)}" for i in range(10)}


@pytest.mark.parametrize("count", [0, 1, 5, 20_000])
def test_perfect_hash(count):
    rng = np.random.default_rng(count)
    hashes = rng.integers(0, 2**63, (count, 2)).astype("<u8")
    counts = rng.integers(1, 70_000, count)
    table = PerfectHash.unpack(PerfectHash.build(hashes, counts).pack())
    assert len(table.counts) == count  # minimal: one slot a key
    order = rng.permutation(count)
    assert (table.find(hashes[order]) == counts[order]).all()
    others = rng.integers(0, 2**63, (1000, 2)).astype("<u8")
    assert (table.find(others) == 0).sum() >= 999
    assert table.counts.dtype.itemsize <= 4


def test_a_table_answers_for_lines_of_other_documents(spark):
    config = LineConfig(documents=3, shard_keys=4)
    known = documents(spark, [(i, f"common\nown {i}", "en", "a", 0, "", "", "") for i in range(20)])
    fresh = documents(spark, [(99, "new\nCOMMON\nown 3", "en", "a", 0, "", "", "")])
    table, shards = line_dedup.line_table(line_dedup.line_blocks(known, config), config)
    blocks = line_dedup.line_blocks(fresh, config)
    flags = line_dedup.line_flags(blocks, line_dedup.probe(blocks, table, shards, config), shards)
    assert [r["drop"] for r in flags.collect()] == [[False, True, False]]
