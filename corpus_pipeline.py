"""A corpus from raw documents to packed sequences, in five stages.

Each stage works on what the one before kept, and is written before the next one reads it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from reportmart.llm import exact_dedup, packing, pii, simhash, toxicity
from reportmart.llm.common import read
from reportmart.llm.queries import BYTE_BPE
from reportmart.sources.staging import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the threshold. The model learns from the labels of these
    documents, but for those that are held out."""
    model = toxicity.train(docs, read(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, model)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the document with the largest id."""
    return exact_dedup.deduplicate(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the document with the least id."""
    return simhash.one_of_each(docs)


def remove_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked and ``n_chars`` brought up to date."""
    cleaned = pii.sanitise(docs)
    if "n_chars" not in cleaned.columns:
        return cleaned
    return cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in sequences."""
    return packing.pack(docs, BYTE_BPE, keep_ids=False)


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash", drop_near_copies),
    ("pii", remove_personal_data),
    ("packing", pack_sequences),
]

#: Scores, fingerprints and identifiers can't be had from SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from the table ``documents`` on."""
    docs = read(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
