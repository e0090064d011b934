from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from airstrata.llm import resampling
from airstrata.llm.resampling import ResampleConfig
from tests.llm.helpers import documents, odd_rows, text

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(value, order):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in value or "")
    found = WORD.findall(low)
    runs = [" ".join(found[i : i + n]) for n in range(1, order + 1) for i in range(len(found) - n + 1)]
    return len(found), [zlib.crc32(f.encode()) for f in runs]


def brute(rows, target, config):
    """Every document's figures by the definition, and the draw by a full sort."""
    per_row = [features(r[1], config.order) for r in rows]
    corpus = Counter(f % config.buckets for _, fs in per_row for f in fs)
    wanted = Counter(f % config.buckets for t in target for f in features(t, config.order)[1])
    big, aim = corpus.total() + config.buckets, wanted.total() + config.buckets
    out = []
    for r, (n, fs) in zip(rows, per_row, strict=True):
        weight = sum(
            math.floor(1000 * math.log((wanted[b] + 1) * big / ((corpus[b] + 1) * aim)))
            for b in (f % config.buckets for f in fs)
        )
        key = "null" if r[0] is None else str(r[0])
        h = int(hashlib.sha256(f"{config.seed}:{key}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([r[0], len(fs), weight, weight + noise, None, n])
    fit = [o for o in out if o[5] >= config.least_words]
    fit.sort(key=lambda o: (-o[3], o[0] is not None, o[0] or 0))
    for place, o in enumerate(fit[: len(fit) * config.percent // 100], 1):
        o[4] = place
    return sorted((tuple(o[:5]) for o in out), key=repr)


def rows_of(frame):
    return sorted((tuple(r) for r in frame.collect()), key=repr)


def corpus():
    more = [(100 + i, text(i % 40, 10 + i % 50), None, "s", 0, "", "", "") for i in range(300)]
    repeated = [(7000, text(3, 60), "en", "s", 0, "", "", "")] * 60
    return odd_rows() + more + repeated


@pytest.mark.parametrize(
    "config",
    [ResampleConfig(finish=8), ResampleConfig(order=3, buckets=97, percent=55, least_words=1, finish=1)],
)
def test_equals_brute_force(spark, config):
    rows, target = corpus(), [text(900, 300), None, "", "Wa1 we2 été"]
    frame = documents(spark, rows).repartition(5)
    aims = spark.createDataFrame([(i, t, 1) for i, t in enumerate(target)], "item_id long, text string, n_words int")
    got = resampling.resample(frame, aims, config)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank"]
    assert rows_of(got) == brute(rows, target, config)


def test_no_documents_no_target_none_drawn(spark):
    empty = documents(spark, [])
    aims = spark.createDataFrame([], "text string")
    assert resampling.resample(empty, aims).collect() == []
    config = ResampleConfig(least_words=1_000_000)
    assert rows_of(resampling.resample(documents(spark), aims, config)) == brute(odd_rows(), [], config)


def test_the_cutoff_is_the_key_of_a_full_sort(spark):
    rng = np.random.default_rng(5)
    keys = [(int(d), int(i), n) for n, (d, i) in enumerate(zip(rng.integers(0, 6, 900), rng.integers(0, 40, 900), strict=True))]
    keys += [(3, None, 900 + i) for i in range(50)]
    frame = spark.createDataFrame(keys, "down long, doc_id long, row long").repartition(6)
    order = sorted(keys, key=lambda k: (k[0], k[1] is not None, k[1] or 0, k[2]))
    for k in (1, 2, 400, 500, 949, 950):
        cut = resampling.cutoff(frame, k, finish=3)
        assert (cut["down"], cut["doc_id"], cut["row"]) == order[k - 1]
    with pytest.raises(ValueError):
        resampling.cutoff(frame, 951)


def test_drawn_documents_keep_their_columns(spark):
    config = ResampleConfig(percent=40, finish=5)
    frame, aims = documents(spark, corpus()), spark.createDataFrame([(text(3, 50),)], "text string")
    drawn = resampling.draw(frame, aims, config)
    assert drawn.columns == [*frame.columns, "draw_rank"]
    ranks = [r["rank"] for r in resampling.resample(frame, aims, config).collect() if r["rank"]]
    assert sorted(r["draw_rank"] for r in drawn.collect()) == sorted(ranks) == list(range(1, len(ranks) + 1))
