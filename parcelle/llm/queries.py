"""Registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from parcelle.llm import (bloom_lm, chunk_divergence, decontamination, gram_variants, histogram_sort, html_mincut, itq_dedup, mph_lines, order_minhash,
                          pii_bootstrap, toxicity_kn, vector_packing, warc_io)
from parcelle.llm import oracle_sql
from parcelle.llm.common import table


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_html_mincut(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_mincut.main_text(table(spark, sf_dir, "pages"))


def op3_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return histogram_sort.shard(table(spark, sf_dir, "documents"), shards=24)


def op4_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_bootstrap.extract(table(spark, sf_dir, "documents"))


def op5_toxicity_kn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_kn.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_vector_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_packing.pack(table(spark, sf_dir, "documents"))


def op7_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.near_duplicates(table(spark, sf_dir, "documents"), stored=True).select("doc_id", "class_id", "n_class", "kept")


def op8_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score(table(spark, sf_dir, "documents"))


def op9_itq_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return itq_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_io.round_trip(table(spark, sf_dir, "pages"), stored=True)


def op11_gram_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gram_variants.variants(table(spark, sf_dir, "documents"))


def op12_mph_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mph_lines.digest(mph_lines.dedup(table(spark, sf_dir, "documents"), stored=True))


def op13_chunk_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunk_divergence.divergence(table(spark, sf_dir, "documents"), stored=True)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_decontamination, op2_html_mincut, op3_histogram_sort, op4_pii_bootstrap, op5_toxicity_kn, op6_vector_packing, op7_order_minhash,
                            op8_bloom_lm, op9_itq_dedup, op10_warc, op11_gram_variants, op12_mph_lines, op13_chunk_divergence)
}

# DuckDB statements; the other operators are not SQL-expressible and are tested against brute force
ORACLE: dict[str, str] = dict(oracle_sql.ORACLE)
