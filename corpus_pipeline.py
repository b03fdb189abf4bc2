"""Corpus pipeline over the documents of a data folder, in five stages of the training-data operators.

toxicity (toxic documents go), near-duplicates (one document of each group stays), benchmark decontamination
(documents that hold a benchmark item go), personal data (spans are masked), packing into training sequences.
Every stage works on all its predecessor kept, from a table written in between.

Nulls: a null text is an empty text for every stage and stays null in the documents; null ids, repeated rows
and further columns pass through as they come (of equal rows the near-duplicate stage keeps one). An empty
table gives empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from parcelle.llm import decontamination, order_minhash, pii_bootstrap, toxicity_kn, vector_packing
from parcelle.llm.common import has_place, materialise, table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the class-conditional models score below 0.3; learned from the labels of the documents given."""
    return toxicity_kn.reject(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: the one with the smallest id."""
    return order_minhash.keep_one(docs, stored=has_place(docs))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item within its edit budget."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data masked and n_chars counted anew."""
    return pii_bootstrap.redact(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece in the training sequences."""
    return vector_packing.pack(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontaminate), ("personal_data", personal_data), ("packing", packing)]

# no stage but the masking of base spans could be said in SQL; tests/llm compares the stages with plain versions
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents; what a stage returns is written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = materialise(docs, f"pipeline-{name}")
    return docs
