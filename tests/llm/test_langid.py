from __future__ import annotations

import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from airstrata.llm import langid_crf as crf
from tests.llm.helpers import documents, odd_rows


def small_model(labels=("a", "b", "c")):
    rng = np.random.default_rng(2)
    n = len(labels)
    return crf.CrfModel(list(labels), rng.normal(size=(64, n)), rng.normal(size=(n, n)), rng.normal(size=n), {}, 6)


def test_forward_backward_against_all_paths():
    model, rng = small_model(), np.random.default_rng(3)
    lengths = np.array([4, 1, 3])
    scores = rng.normal(size=(8, 3))
    posterior, pairs = crf.forward_backward(scores, lengths, model)
    want, want_pairs, at = np.zeros((8, 3)), np.zeros((3, 3)), 0
    for n in lengths:
        paths = list(itertools.product(range(3), repeat=int(n)))
        weight = np.array([
            np.exp(model.first[p[0]] + sum(scores[at + t, k] for t, k in enumerate(p))
                   + sum(model.transitions[x, y] for x, y in itertools.pairwise(p)))
            for p in paths
        ])
        for p, w in zip(paths, weight / weight.sum(), strict=True):
            for t, k in enumerate(p):
                want[at + t, k] += w
            for x, y in itertools.pairwise(p):
                want_pairs[x, y] += w
        at += int(n)
    assert np.allclose(posterior, want) and np.allclose(pairs, want_pairs)


def test_switched_text_is_tagged_word_by_word(spark):
    rows = [("x", "alpha beta gamma delta epsilon. " * 8), ("y", "uno dos tres quatro cinco. " * 8)] * 10
    model = crf.train(rows, crf.CrfConfig(epochs=8, batch=16))
    frame = spark.createDataFrame([(1, "alpha gamma beta uno tres dos. Cinco!")], "doc_id long, text string")
    tags = crf.tag_words(frame, model).first()["words"]
    assert [(t["word"], t["lang"]) for t in tags] == [
        ("alpha", "x"), ("gamma", "x"), ("beta", "x"), ("uno", "y"), ("tres", "y"), ("dos", "y"), ("cinco", "y"),
    ]
    assert model.transitions[0, 0] > model.transitions[0, 1]


def test_held_out_accuracy(spark):
    given = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    found = crf.identify(given).join(given.select("doc_id", "lang"), "doc_id").filter("held_out")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98


def test_odd_rows(spark):
    found = {}
    for r in crf.identify(documents(spark)).collect():
        found.setdefault(r["doc_id"], []).append(r)
        assert 0 <= r["score"] <= 1
    assert sum(map(len, found.values())) == len(odd_rows())
    assert {(r["lang_pred"], r["score"]) for k in (4, 5, 6, 8) for r in found[k]} == {("und", 0.0)}
    assert found[1][0]["lang_pred"] == found[2][0]["lang_pred"] in {"en", "de", "fr"}
    assert not found[None][0]["held_out"]


@pytest.mark.parametrize("rows", [[], [(1, "text", None, *[None] * 5)], [(0, "only one", "en", *[None] * 5)]])
def test_few_labels(spark, rows):
    found = crf.identify(documents(spark, rows)).collect()
    assert [(r["lang_pred"], r["score"]) for r in found] == [("en", 1.0) if r[2] else ("und", 0.0) for r in rows]


def test_long_chains_are_cut_not_dropped():
    assert [len(c) for c in crf._chains("a " * 1200)] == [512, 512, 176]
    assert crf._chains("Ab1c! 12 _x_\né") == [["ab", "c"], ["x"], ["é"]]


def test_parts_of_a_chain_give_the_posteriors_of_the_whole():
    model, rng = small_model(), np.random.default_rng(4)
    scores = 3 * rng.normal(size=(1400, 3))
    whole, pairs = crf.forward_backward(scores, np.array([30, 1300, 70]), model)
    lengths, follows = np.array([30, 512, 512, 276, 1, 69]), np.array([0, 0, 1, 1, 0, 1], bool)
    got, got_pairs = crf.forward_backward(scores, lengths, model, follows)
    assert np.allclose(got, whole) and np.allclose(got_pairs, pairs)


def test_parts_know_which_chain_they_belong_to():
    parts, follows = crf._parts("a " * 512 + ". b " + "c " * 512 + "! ? d")
    assert [len(p) for p in parts] == [512, 512, 1, 1] and follows == [False, False, True, False]


def test_all_letters_of_a_long_run_count():
    assert crf._chains("x" * 150 + " y") == [["x" * 64, "x" * 64, "x" * 22, "y"]]
    rows = [("x", "aaab " * 20), ("y", "zzzw " * 20)] * 10
    model = crf.train(rows, crf.CrfConfig(epochs=8, batch=16))
    words, posterior, sizes = crf._posteriors(["q" * 64 + "aaab" * 30, "q" * 64 + "zzzw" * 30], model, crf._Emissions(model))
    ends = np.cumsum(sizes)
    assert [posterior[e - n : e].mean(axis=0).argmax() for e, n in zip(ends, sizes, strict=True)] == [0, 1]


def test_every_label_is_learned(spark):
    rows = [(None, f"wort{k:03d} rede{k:03d} satz{j}", f"l{k:03d}") for k in range(90) for j in range(4)]
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = crf.sample(given, crf.CrfConfig())
    assert len(found) == 360 and len({label for label, _ in found}) == 90
    few = crf.sample(given, crf.CrfConfig(windows=180))
    assert len(few) == 180 and len({label for label, _ in few}) == 90


def test_copies_do_not_crowd_out_their_label(spark):
    rows = [(k, f"common words of this language {k}", "en") for k in range(600)]
    # a label that is 99.9% copies of one text, and one that has few texts
    rows += [(k, "immer derselbe kurze satz", "de") for k in range(29_970)]
    rows += [(30_000 + k, f"andere worte dieser sprache {k}", "de") for k in range(30)]
    rows += [(40_000 + k, f"encore une langue {k}", "fr") for k in range(5)]
    given = spark.createDataFrame([(None, t, lang) for _, t, lang in rows], "doc_id long, text string, lang string")
    config = crf.CrfConfig()
    found = crf.sample(given, config)
    for label in ("de", "fr", "en"):
        texts = {t for _, t, lang in rows if lang == label}
        got = [t for lang, t in found if lang == label]
        assert len(got) == min(config.per_label, len(texts)) and set(got) <= texts
