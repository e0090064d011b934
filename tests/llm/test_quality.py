from __future__ import annotations

import numpy as np
import pytest

from airstrata.llm import quality_qda as qda
from tests.llm.helpers import documents, odd_rows

LABELS = "doc_id long, quality int, toxic int"


def test_score_is_the_posterior_of_two_normals():
    rng = np.random.default_rng(1)
    x = [rng.normal(size=(300, 3)), rng.normal(1, 2, size=(500, 3))]
    counts = np.array([300.0, 500.0])
    model = qda.shrink(
        counts, np.array([v.sum(axis=0) for v in x]), np.array([v.T @ v for v in x]), qda.QdaConfig(0.1, 0.02)
    )
    pooled = sum((v - v.mean(axis=0)).T @ (v - v.mean(axis=0)) for v in x) / 800
    values, density = rng.normal(size=(20, 3)), []
    for k, v in enumerate(x):
        cov = 0.98 * (0.9 * np.cov(v.T, bias=True) + 0.1 * pooled) + (0.02 + 1e-9) * np.diag(np.diag(pooled))
        d = values - v.mean(axis=0)
        density.append((counts[k] + 1) * np.exp(-0.5 * np.einsum("ij,jk,ik->i", d, np.linalg.inv(cov), d)) / np.sqrt(np.linalg.det(cov)))
    assert np.allclose(model.score(values), density[1] / (density[0] + density[1]))


def test_held_out_accuracy(spark):
    read = lambda name: spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet")
    found = qda.classify(read("documents"), read("labels")).join(read("labels"), "doc_id").filter("held_out")
    rows = found.select("score", "predicted", "quality").collect()
    good, bad = ([r["score"] for r in rows if r["quality"] == q] for q in (1, 0))
    auc = np.mean([np.mean(np.array(bad) < g) + np.mean(np.array(bad) == g) / 2 for g in good])
    assert auc > 0.98
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) > 0.98


def test_odd_rows(spark):
    labels = [(1, 1, 0), (1, 0, 0), (2, 1, None), (9, 0, 0), (10, 0, 0), (None, 1, 1), (4, None, 0), (5, 7, 0), (77, 1, 0)]
    found = qda.classify(documents(spark), spark.createDataFrame(labels, LABELS)).collect()
    assert len(found) == len(odd_rows())
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in found)


@pytest.mark.parametrize("labels", [[], [(1, 1, 0)]])
def test_few_labels(spark, labels):
    found = qda.classify(documents(spark), spark.createDataFrame(labels, LABELS)).collect()
    assert all(np.isclose(r["score"], 2 / 3 if labels else 0.5) for r in found)
    assert qda.classify(documents(spark, []), spark.createDataFrame(labels, LABELS)).count() == 0


def test_learning_ignores_held_out_labels(spark):
    frame = documents(spark)
    seen = {r["doc_id"] for r in qda.classify(frame, spark.createDataFrame([], LABELS)).collect() if r["held_out"]}
    assert seen
    model = qda.fit(frame, spark.createDataFrame([(i, 1, 0) for i in seen], LABELS))
    assert model.learned == 0
