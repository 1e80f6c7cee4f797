"""Corpus pipeline: each stage takes ``(spark, docs, sf_dir)`` and returns the rows that go on.

A stage's result is written as Parquet under ``spark.checkpoint.dir`` and read again as the next one's
``docs``. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from loanlens.llm import bpe, decontaminate, jaccard_join, mil_quality, secrets
from loanlens.llm.common import materialize, table


def quality(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    return mil_quality.keep_good(docs, mil_quality.fit_outside_fold(spark, docs, sf_dir))


def near_duplicates(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document, the one with the least id, of each group of similar ones."""
    return jaccard_join.keep_one(docs)


def decontamination(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that hold a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces secrets in the texts by a mark; ``n_chars`` follows. No document is dropped."""
    return secrets.redact(docs, secrets.fit(docs))


def encode(spark, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of every document that is left."""
    return bpe.round_trip_digests(docs, bpe.default_vocabulary())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("encode", encode),
]


def run(spark, sf_dir: str) -> DataFrame:
    """The stages in turn over all ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialize(docs)
    return docs


# Classifier and byte-pair merges have no SQL form; tests hold each stage against brute force.
ORACLE_SQL = None
