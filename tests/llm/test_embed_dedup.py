from __future__ import annotations

import numpy as np

from airstrata.llm import embed_dedup
from tests.llm.test_links import brute_components

SCHEMA = "vec_id long, embedding array<float>, label int, id string, key string"


def table(spark, rows):
    return spark.createDataFrame([(i, v, k, "i", "k") for i, v, k in rows], SCHEMA)


def brute(rows):
    linked = {k: [] for k in range(len(rows))}
    usable = []
    for k, (i, v, label) in enumerate(rows):
        ok = i is not None and label is not None and v and None not in v and np.isfinite(v).all() and any(v)
        usable.append(np.array(v, dtype=np.float32).astype(float) if ok else None)
    for a in range(len(rows)):
        for b in range(a):
            x, y = usable[a], usable[b]
            if x is None or y is None or len(x) != len(y) or rows[a][2] != rows[b][2]:
                continue
            if x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= 0.93:
                linked[a].append(b)
                linked[b].append(a)
    parts = brute_components([(a, b) for a in linked for b in linked[a]])
    first = {}
    for a, root in parts.items():
        first[root] = min(first.get(root, rows[a][0]), rows[a][0])
    out = []
    for a, (i, _, _) in enumerate(rows):
        component = first[parts[a]] if a in parts else i
        out.append((i, len(linked[a]), component, i == component if i is not None else True))
    return sorted(out, key=repr)


def found(spark, rows):
    result = embed_dedup.near_duplicates(table(spark, rows))
    return sorted(((r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in result.collect()), key=repr)


def test_against_brute_force(spark):
    rng = np.random.default_rng(5)
    rows = []
    for group, (size, noise) in enumerate([(2, 0.02), (5, 0.1), (290, 0.03), (30, 0.2), (40, 0.3)]):
        centre = rng.normal(size=32)
        rows += [(None, (centre + noise * rng.normal(size=32)).tolist(), group % 2) for _ in range(size)]
    rows += [(None, rng.normal(size=32).tolist(), k % 3) for k in range(300)]
    rows += [(None, rows[0][1], 0)] * 7 + [(None, rows[0][1], 2)]
    order = rng.permutation(len(rows))
    rows = [(int(order[k]), v, label) for k, (_, v, label) in enumerate(rows)]
    want, got = brute(rows), found(spark, rows)
    assert [r[0] for r in got] == [r[0] for r in want]
    links = sum(r[1] for r in want)
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(r[1] for r in got) >= 0.999 * links


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (3, [2.0, 0.0], 1), (3, [2.0, 0.0], 1), (4, [1.0, 0.0], None),
        (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1), (8, [1.0, None], 1), (9, [nan, 1.0], 1), (10, [inf, 1.0], 1),
        (None, [1.0, 0.0], 1), (11, [1.0, 0.0, 0.0], 1), (12, [1e-30, 0.0], 1), (13, [3e38, 0.0], 1), (14, [-1.0, 0.0], 1),
        (15, [1.0, 0.0], 2),
    ]
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert embed_dedup.near_duplicates(table(spark, [])).count() == 0


def test_passes_grow_with_the_largest_label():
    config = embed_dedup.DedupConfig()
    assert config.passes(0) == config.passes(32) < config.passes(5_000) < config.passes(300_000)


def lean_vectors(rng, count, pairs, cosine, dim=64):
    """Vectors of which two have about this cosine, and pairs of them at about 0.94."""
    own = rng.normal(size=(count, dim)) / np.sqrt(dim)
    own[:, 0] = 0
    near = own[:pairs] + 0.0
    turn = rng.normal(size=(pairs, dim)) / np.sqrt(dim)
    turn[:, 0] = 0
    # the mean adds cosine to every product; the rest of 0.94 comes from the vectors' own parts
    share = (0.942 - cosine) / (1 - cosine)
    near = share * near + np.sqrt(1 - share * share) * turn
    both = np.vstack([own, near])
    both /= np.linalg.norm(both, axis=1, keepdims=True)
    both *= np.sqrt(1 - cosine)
    both[:, 0] = np.sqrt(cosine)
    return both.astype(np.float32)


def test_links_of_labels_that_lean_one_way(spark):
    rng = np.random.default_rng(8)
    rows, want = [], {}
    for label, cosine in enumerate((0.0, 0.6, 0.7, 0.85)):
        found = lean_vectors(rng, 3_000, 300, cosine)
        exact = found.astype(float)
        exact /= np.linalg.norm(exact, axis=1, keepdims=True)
        linked = (exact @ exact.T >= 0.93).sum(axis=1) - 1
        for k, vector in enumerate(found):
            want[len(rows)] = (label, int(linked[k]))
            rows.append((len(rows), vector.tolist(), label))
    got = {r["vec_id"]: r["n_links"] for r in embed_dedup.near_duplicates(table(spark, rows)).collect()}
    assert got.keys() == want.keys() and all(got[i] <= n for i, (_, n) in want.items())
    for label in range(4):
        ids = [i for i, (own, _) in want.items() if own == label]
        links = sum(want[i][1] for i in ids)
        assert links >= 300 and sum(got[i] for i in ids) >= 0.999 * links, (label, sum(got[i] for i in ids), links)


def test_further_rounds_until_all_rows_are_done(spark, monkeypatch):
    monkeypatch.setattr(embed_dedup, "PASS_COST", 0)
    found = lean_vectors(np.random.default_rng(9), 900, 100, 0.0)
    rows = [(k, v.tolist(), 1) for k, v in enumerate(found)]
    assert found_links(spark, rows) == sum(r[1] for r in brute(rows))


def found_links(spark, rows):
    return sum(r["n_links"] for r in embed_dedup.near_duplicates(table(spark, rows)).collect())
