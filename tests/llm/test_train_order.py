from __future__ import annotations

import numpy as np
import public_tokenizers
import pytest

from airstrata.llm import train_order
from airstrata.llm.token_counts import byte_bpe
from tests.llm.helpers import documents, odd_rows

CONFIG = train_order.OrderConfig(
    public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, length=64, per_shard=50
)


@pytest.mark.parametrize("count", [1, 2, 3, 5, 64, 1000, 4097])
def test_slots_are_a_permutation(count):
    slots = train_order.permute(np.arange(count), count, 17)
    assert sorted(slots.tolist()) == list(range(count))
    assert (train_order.permute(np.arange(count)[::-1], count, 17) == slots[::-1]).all()
    if count >= 64:
        assert (train_order.permute(np.arange(count), count, 18) != slots).any()


def test_shards_hold_the_packed_corpus(spark, tmp_path):
    path = f"file://{tmp_path}/shards"
    frame = documents(spark).coalesce(1)
    slots = train_order.write_shards(frame, path, CONFIG)
    encoding, _ = byte_bpe(CONFIG.ranks_path, CONFIG.pattern)
    stream = [i for r in odd_rows() for i in [*encoding.encode_ordinary(r[1] or ""), CONFIG.end_id]]
    assert slots == -(-len(stream) // CONFIG.length)
    stream += [CONFIG.end_id] * (slots * CONFIG.length - len(stream))
    want = np.array(stream, "<u2").reshape(slots, -1)
    rows = {r["slot"]: bytes(r["ids"]) for r in train_order.read_slots(spark, path, CONFIG).collect()}
    at = train_order.permute(np.arange(slots), slots, CONFIG.key)
    assert rows == {int(s): w.tobytes() for s, w in zip(at, want, strict=True)}
    names = sorted(p.name for p in (tmp_path / "shards").iterdir())
    assert names == [f"shard-{k:09d}.bin" for k in range(-(-slots // CONFIG.per_shard))]
    # a reader that resumes finds a slot by its offset alone
    slot = slots - 3
    raw = (tmp_path / "shards" / f"shard-{slot // 50:09d}.bin").read_bytes()
    assert raw[slot % 50 * 128 :][:128] == rows[slot]
    rest = train_order.read_slots(spark, path, CONFIG, slot).collect()
    assert sorted(r["slot"] for r in rest) == [slot, slot + 1, slot + 2]


def test_rows_and_holdings_of_any_size_agree(spark, tmp_path, monkeypatch):
    found = []
    for row, held in ((1, 1), (1000, 5000), (1 << 19, 1 << 25)):
        monkeypatch.setattr(train_order, "_ROW_IDS", row)
        monkeypatch.setattr(train_order, "_HELD_IDS", held)
        path = f"file://{tmp_path}/{row}"
        train_order.write_shards(documents(spark).coalesce(1), path, CONFIG)
        found.append(sorted((r["slot"], bytes(r["ids"])) for r in train_order.read_slots(spark, path, CONFIG).collect()))
    assert found[0] == found[1] == found[2]


def test_many_partitions(spark, tmp_path):
    path = f"file://{tmp_path}/shards"
    stored = f"{tmp_path}/docs"
    documents(spark).repartition(5).write.parquet(stored)
    slots = train_order.write_shards(spark.read.parquet(stored), path, CONFIG)
    assert sorted(r["slot"] for r in train_order.read_slots(spark, path, CONFIG).collect()) == list(range(slots))


def test_empty_table(spark, tmp_path):
    assert train_order.write_shards(documents(spark, []), f"file://{tmp_path}/shards", CONFIG) == 0
