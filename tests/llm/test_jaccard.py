from __future__ import annotations

import random
from collections import defaultdict

from airstrata.llm import jaccard_join as join
from airstrata.llm import links
from tests.llm.helpers import documents, odd_rows, words
from tests.llm.test_links import brute_components


def shingles(text, n=5):
    found = (text or "").lower().split()
    return frozenset(tuple(found[i : i + n]) for i in range(max(1, len(found) - n + 1))) if found else frozenset()


def brute(rows):
    sets = [shingles(r[1]) for r in rows]
    linked = defaultdict(list)
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 10 * len(sets[a] & sets[b]) >= 8 * len(sets[a] | sets[b]):
                linked[a].append(b)
                linked[b].append(a)
    parts = brute_components([(a, b) for a in linked for b in linked[a]])
    rank = lambda a: (rows[a][0] is not None, rows[a][0] or 0)
    best = {}
    for a, root in parts.items():
        best[root] = min(best.get(root, a), a, key=rank)
    return [(rows[a][0], len(linked[a]), rows[best[parts[a]]][0] if a in parts else rows[a][0]) for a in range(len(rows))]


def near_copies():
    rng = random.Random(8)
    rows = []
    for size, edits in ((2, 1), (9, 3), (2 * links.BLOCK + 40, 2), (25, 8)):
        base = words(rng.randrange(10**6), 150, 5000)
        for _ in range(size):
            copy = list(base)
            for _ in range(rng.randrange(edits + 1)):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
            rows.append(" ".join(copy))
    passage = " ".join(words(77, 60, 5000))
    rows += [" ".join(words(1000 + i, 80, 5000)) + " " + passage for i in range(150)]
    rows += [" ".join(words(2000 + i, 3 + i % 9, 50)) for i in range(100)]
    rng.shuffle(rows)
    return [(i, text, *[None] * 6) for i, text in enumerate(rows)]


def test_against_brute_force(spark):
    rows = near_copies()
    found = join.near_duplicates(documents(spark, rows)).collect()
    want = brute(rows)
    assert sorted((r["doc_id"], r["n_links"], r["group_id"]) for r in found) == sorted(want)
    assert all(r["kept"] == (r["doc_id"] == r["group_id"]) for r in found)


def large_group():
    """Near copies of one text, more than a bucket holds, and texts that share a passage with them."""
    rng = random.Random(3)
    base = words(5, 150, 5000)
    rows = []
    for _ in range(3 * links.BLOCK):
        copy = list(base)
        copy[rng.randrange(len(copy))] = f"e{rng.randrange(10**6)}"
        rows.append(" ".join(copy))
    rows += [" ".join(base[:60] + words(3000 + i, 40, 5000)) for i in range(60)]
    rng.shuffle(rows)
    return [(i, text, *[None] * 6) for i, text in enumerate(rows)]


def test_a_group_of_near_copies_is_settled_without_splits(spark, monkeypatch):
    made, split = [], join._split
    monkeypatch.setattr(join, "_split", lambda rows, config: made.append(rows.count()) or split(rows, config))
    rows = large_group()
    found = join.near_duplicates(documents(spark, rows)).collect()
    assert sorted((r["doc_id"], r["n_links"], r["group_id"]) for r in found) == sorted(brute(rows))
    assert not made


def test_components_are_looked_up_once_per_class_not_in_every_tree(spark, monkeypatch):
    frame, made = type(spark.range(0)), []
    plain = frame.join

    def counted(self, other, on=None, how=None):
        out = plain(self, other, on, how)
        if isinstance(on, str) and (on, how) == ("id", "left"):
            made.append(out.count())
        return out

    monkeypatch.setattr(frame, "join", counted)
    rows = large_group()
    found = join.near_duplicates(documents(spark, rows)).collect()
    assert sorted((r["doc_id"], r["n_links"], r["group_id"]) for r in found) == sorted(brute(rows))
    assert len(made) >= 3 and max(made) <= len(rows)


def test_large_nodes_settled_split_and_dealt_give_all_links(spark):
    rows = near_copies()
    for config in (join.JoinConfig(bucket=10, apart=20), join.JoinConfig(bucket=10, apart=0, depth=2)):
        found = join.near_duplicates(documents(spark, rows), config).collect()
        assert sorted((r["doc_id"], r["n_links"], r["group_id"]) for r in found) == sorted(brute(rows))


def test_odd_rows(spark):
    rows = odd_rows()
    found = join.near_duplicates(documents(spark)).collect()
    assert sorted(repr((r["doc_id"], r["n_links"], r["group_id"])) for r in found) == sorted(map(repr, brute(rows)))
    left = join.deduplicate(documents(spark))
    assert left.columns == documents(spark).columns
    kept = [(r["doc_id"], r["text"]) for r in left.collect()]
    assert len(kept) == len(odd_rows()) - 3  # of 1, 2, 2 and 3 only 1 stays
    assert all(r[1] is None or not r[1].strip() or kept.count(r) == 1 for r in kept)


def test_empty_table(spark):
    assert join.near_duplicates(documents(spark, [])).count() == 0
    assert join.deduplicate(documents(spark, [])).count() == 0


def test_exact_similarity_at_the_threshold():
    import numpy as np

    sets = [np.arange(9), np.arange(10), np.arange(2, 10), np.arange(100, 101)]
    alike = join._jaccard(0.8, columns=4)([s.astype(np.uint64).tobytes() for s in sets])
    assert alike.tolist()[:3] == [[True, True, False, False], [True, True, True, False], [False, True, True, False]]


def test_trees_reach_the_recall():
    config = join.JoinConfig()
    assert config.trees == join.JoinConfig(recall=0.9999).trees > join.JoinConfig(recall=0.9).trees
    assert 0 < config.least_equal < config.threshold * join.COORDINATES
    assert config.trees == join.JoinConfig(depth=4).trees > join.JoinConfig(depth=2).trees
    roots = join.root_choices(config)
    assert len(roots) == len({t for t, _ in roots}) == len({c for _, c in roots}) == config.trees


def test_recall_at_the_threshold_by_splits():
    import numpy as np

    config, rng, pairs = join.JoinConfig(), np.random.default_rng(6), 4000
    tokens = rng.integers(0, 1 << 16, (pairs, join.COORDINATES)).astype(np.uint64)
    shared = rng.random((pairs, join.COORDINATES)) < config.threshold
    tree, at = np.array(join.root_choices(config)).T
    pair, root = np.nonzero(shared[:, at])
    nodes = join._mix(tokens[pair, at[root]] + join._mix((tree[root] * join.COORDINATES + at[root]).astype(np.uint64)))
    column, bound = np.arange(join.COORDINATES, dtype=np.uint64), np.uint64(int(config.choice * 2**64))
    for splits in range(1, config.depth + 1):
        assert len(np.unique(pair)) >= 0.999 * pairs, splits
        chance = join._mix(nodes[:, None] ^ join._mix(column + np.uint64(1 << 40)))
        row, col = np.nonzero((chance < bound) & shared[pair])
        nodes, pair = join._mix(chance[row, col] + tokens[pair[row], col]), pair[row]
