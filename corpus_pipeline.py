"""A training-corpus pipeline: language ID, near-dedup, decontamination, redaction and mixing, in that order.

Each stage reads all that the one before has kept. The first rejects documents whose most likely language has less than
half of the posterior, and those without text or letters. Nulls: a document without text goes at the first stage, a null
doc_id, lang or source is kept as it is. Equal rows (of one id and text) are judged alike, and near-dedup keeps one of
them. Empty tables give empty tables. Columns beyond those of documents pass through; a very long text has to fit in a
worker's memory.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orthoweave.llm import decontaminate, langid, mixing, near_dedup, pii
from orthoweave.llm.common import materialize, table

#: Trees, language models and mixes are not SQL's to express.
ORACLE_SQL = None


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is predicted with half of the posterior or more; learns from all that have a language."""
    return langid.recognised(docs, least=0.5)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, a similarity of 0.8 or more."""
    return near_dedup.drop_near_duplicates(docs, shingle=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pii.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the number of copies and of words taken."""
    return mixing.take(docs)


STAGES = [("language ID", language), ("near-dedup", deduplicate), ("decontamination", decontaminated), ("PII", redact), ("mixing", mix)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
