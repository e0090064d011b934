"""The corpus pipeline: language, quality, near duplicates, mixing, pieces.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is stored and read
back as the docs of the next one. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airstrata.llm import jaccard_join, langid_crf, mixing, pieces, quality_qda
from airstrata.llm.common import table
from airstrata.session import materialize

#: a document is rejected if no language reaches this mean posterior
LEAST_LANGUAGE = 0.4


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents without letters and those of no clear language.

    If no document has a language label, nothing can be judged and all stay.
    """
    model = langid_crf.fit(docs)
    if not model.labels:
        return docs
    judged = langid_crf.predict(docs.select(F.struct("*").alias("row"), "text"), model)
    clear = (F.col("lang_pred") != langid_crf.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE)
    return judged.filter(clear).select("row.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejects documents that score below the accepted quality; without labels all stay."""
    config = quality_qda.QdaConfig()
    model = quality_qda.fit(docs, table(spark, sf_dir, "labels"), config)
    if not model.learned:
        return docs
    judged = quality_qda.score(docs.select(F.struct("*").alias("row"), "text"), model)
    return judged.filter(F.col("score") >= config.accept).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one with the smallest id, of each group of near duplicates."""
    return jaccard_join.deduplicate(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes documents by the weights of their sources, some twice, some not at all."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids, decoded_sha256 of every document of the mixture."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    both = pieces.encode(docs, model, decoded=True)
    return both.withColumn("decoded_sha256", F.sha2("decoded", 256)).drop("decoded")


STAGES = [
    ("language", language),
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

#: models are fitted and pieces encoded, which SQL cannot express
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
