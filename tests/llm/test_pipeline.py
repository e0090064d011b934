from __future__ import annotations

import hashlib

import numpy as np
import public_tokenizers
import sentencepiece

import corpus_pipeline
from airstrata.llm import quality_qda
from tests.llm.helpers import documents
from tests.llm.test_jaccard import shingles
from tests.llm.test_mixing import goals, sizes

SF = "/root/testdata/sf0.01"


def test_each_stage_on_its_own_input(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").cache()
    columns = docs.columns
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], SF).cache())
        if name != "encode":
            assert frames[-1].columns == columns, name
    rows = [[tuple(r) for r in f.collect()] for f in frames]
    # language: all these documents have a clear one
    assert len(rows[1]) >= 0.99 * len(rows[0])
    # quality: labelled good documents stay, bad ones go
    left = {r[0] for r in rows[2]}
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert np.mean([i in left for i in good]) > 0.98 and np.mean([i in left for i in bad]) < 0.05
    # near duplicates: against all pairs that share a shingle
    owners, sets = {}, {r[0]: shingles(r[1]) for r in rows[2]}
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in sorted(sets):
        for j in {j for s in sets[i] for j in owners.get(s, ())}:
            if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                up[b] = a
        for s in sets[i]:
            owners.setdefault(s, []).append(i)
    assert sorted(r[0] for r in rows[3]) == sorted({find(i) for i in sets})
    # mixture: every source meets its target to the word
    _, target = goals(rows[3])
    took = {}
    for r, n in zip(rows[4], sizes(rows[4]), strict=True):
        took[r[3]] = took.get(r[3], 0) + n
    assert took == {s: int(t + 0.5) for s, t in target.items()}
    # pieces: what the library gives
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = []
    for r in rows[4]:
        ids = library.encode(r[1], add_bos=True, add_eos=True)
        want.append((r[0], len(ids), np.array(ids, "<u4").tobytes(), hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted((r[0], r[1], bytes(r[2]), r[3]) for r in rows[5]) == sorted(want)


def test_odd_and_empty_input(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for rows in (None, []):
        frame = documents(spark, rows)
        frame.write.parquet(f"{tmp_path}/documents.parquet", mode="overwrite")
        out = corpus_pipeline.run(spark, str(tmp_path))
        assert out.columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
        assert bool(out.count()) == (rows is None)


def test_without_labels_nothing_is_rejected(spark, tmp_path):
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    frame = documents(spark)
    assert corpus_pipeline.quality(spark, frame, str(tmp_path)).count() == frame.count()
    assert quality_qda.QdaConfig().accept == 0.7
