"""A corpus pipeline of five stages over ``documents``.

Each stage takes the documents that the one before it kept and was written as
Parquet; all but the last return the columns of documents.

Defined cases: documents with a null or empty text, or without a letter, have no
language and go with the first stage; a null language is a label that nothing is
learned from; a null doc_id, source or n_chars stays as it is (n_chars is counted anew
by the fourth stage), and a row without doc_id is nobody's copy; repeated rows of one
doc_id are one document from the second stage on; of equal copies the smallest doc_id
stays; very long texts are read whole; tables without rows give none; columns beyond
those of documents pass through all stages but the last, those named like a column
that an operator adds included.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from facetmill.llm import decontamination, langid, neardup, packing, secrets
from facetmill.session import materialise

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognised language; the labels of the rest are learned from."""
    field = langid.train(docs.select("doc_id", "text", "lang"))
    return langid.keep_identified(docs, field)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return neardup.drop_duplicates(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of benchmark words."""
    return decontamination.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets give way to a placeholder; n_chars is counted anew."""
    return secrets.redact(docs).withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and place."""
    pieces = packing.token_pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.pack(materialise(pieces, "token-pieces"))


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("near_dedup", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", redact_secrets),
    ("packing", pack_sequences),
]

# A fitted field and a packing are not SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one written to the shared scratch folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
