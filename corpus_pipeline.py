"""The corpus pipeline: identify languages, deduplicate, decontaminate, pack.

Each stage takes ``(spark, docs, sf_dir)`` and calls one operator of
``asterism.llm`` on all that its predecessor kept. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from asterism.llm import decontam, dedup, langid, packing, queries, simhash
from asterism.llm.common import spool

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    return langid.keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the largest doc_id) of each text."""
    return dedup.keep_one_of_each(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (the smallest doc_id) of each group of near-duplicates."""
    return simhash.keep_one_of_each(docs)


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.decontaminate(docs, queries.table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents with their places in sequences."""
    return packing.pack(docs, str(queries.VOCABULARY))


STAGES: list[tuple[str, Stage]] = [("language_id", language), ("exact_dedup", exact), ("simhash", near),
                                   ("decontamination", clean), ("packing", packed)]

#: Code lengths and fingerprints can't be expressed in SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each stored before the next."""
    docs = queries.table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = spool(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
