"""End-to-end jobs: outputs per run / version, retries rewrite the same result."""

from __future__ import annotations

import csv
import gzip
import os

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from parcelle.plans.jobs import CleaningPaths, cleaning_run, open_data_run
from parcelle.sources import testdata
from tests.conftest import SF_SMALL

NOW = "2024-06-01 12:00:00"


def _ids(spark, path):
    return {r.Id for r in spark.read.parquet(path).select("Id").collect()}


def test_cleaning_run_batches_and_retry(spark, tmp_dir):
    raw_path = f"{tmp_dir}/raw"
    testdata.listings_raw(spark, SF_SMALL).write.parquet(raw_path)
    paths = CleaningPaths(raw_path, f"{tmp_dir}/clean", f"{tmp_dir}/rejected", f"{tmp_dir}/ledger")

    first = cleaning_run(spark, paths, "r1", limit=500, first_run=True)
    clean1, rejected1 = _ids(spark, first["clean"]), _ids(spark, first["rejected"])
    assert len(clean1) + len(rejected1) == 500
    assert _ids(spark, first["ledger"]) == clean1

    # a retried run selects the same batch and rewrites the same outputs
    again = cleaning_run(spark, paths, "r1", limit=500, first_run=True)
    assert _ids(spark, again["clean"]) == clean1
    assert _ids(spark, again["rejected"]) == rejected1

    # the next run skips the ids that r1 cleaned and those it rejected
    second = cleaning_run(spark, paths, "r2", limit=500)
    clean2, rejected2 = _ids(spark, second["clean"]), _ids(spark, second["rejected"])
    assert not clean2 & clean1
    assert not rejected1 & (rejected2 | clean2) and len(clean2) + len(rejected2) == 500
    with pytest.raises(AnalysisException):
        cleaning_run(spark, CleaningPaths(raw_path, paths.clean, paths.rejected, f"{tmp_dir}/mistyped"), "r3")
    ledger = spark.read.parquet(paths.ledger)
    assert {r.run_id for r in ledger.select(F.col("run_id").cast("string").alias("run_id")).distinct().collect()} \
        == {"r1", "r2"}


def _write_sales(spark, path: str) -> int:
    rows = testdata.sale_rows(spark, SF_SMALL).collect()
    with gzip.open(path, "wt", encoding="utf-8", newline="") as fh:
        w = csv.DictWriter(fh, fieldnames=list(rows[0].asDict()))
        w.writeheader()
        for r in rows:
            w.writerow(r.asDict())
    return len(rows)


def test_open_data_run_versions_and_retry(spark, tmp_dir):
    sale_file = os.path.join(tmp_dir, "2024.csv.gz")
    _write_sales(spark, sale_file)
    base, stats = f"{tmp_dir}/state", f"{tmp_dir}/stats"

    v0 = spark.read.parquet(open_data_run(spark, [sale_file], base, 0, NOW, stats, partitions=4))
    v1_path = open_data_run(spark, [sale_file], base, 1, NOW, stats, partitions=4)
    v1 = spark.read.parquet(v1_path)
    # the same files again: same keys, every counter increased by the key's rows
    assert v0.count() == v1.count() == v0.select("listing_url").distinct().count()
    joined = v0.alias("a").join(v1.alias("b"), "listing_url")
    assert joined.filter(F.col("b.update_count") != 2 * F.col("a.update_count")).count() == 0
    assert joined.filter(F.col("b.first_seen_at") != F.col("a.first_seen_at")).count() == 0

    counters = {r.version: r for r in spark.read.parquet(stats).collect()}
    assert counters[0].inserted == v0.count() and counters[0].modified == counters[0].scraped - counters[0].inserted
    assert counters[1].inserted == 0 and counters[1].modified == counters[1].scraped

    # a retried version rewrites its folders: same state, one counter row per version
    before = sorted(v1.select("listing_url", "update_count").collect())
    open_data_run(spark, [sale_file], base, 1, NOW, stats, partitions=4)
    assert sorted(spark.read.parquet(v1_path).select("listing_url", "update_count").collect()) == before
    assert spark.read.parquet(stats).count() == 2
