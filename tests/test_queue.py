"""Batches from a collection landed by day: each listing once, only open days are read."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelle.operators.clean import clean_listings
from parcelle.plans import queue
from parcelle.sources import testdata
from tests.conftest import SF_SMALL

DAYS = ["2024-01-01", "2024-01-02", "2024-01-03"]


def landed(spark, tmp_dir, days=DAYS):
    raw = testdata.listings_raw(spark, SF_SMALL).withColumn("landed", F.element_at(F.array(*map(F.lit, DAYS)), F.pmod(F.xxhash64("_id"), F.lit(3)).cast("int") + 1))
    raw.filter(F.col("landed").isin(days)).write.mode("append").partitionBy("landed").parquet(f"{tmp_dir}/raw")
    return raw


def outputs(spark, tmp_dir):
    return sorted((r.Id, r.reason) for r in spark.read.parquet(f"{tmp_dir}/done").select("Id", "reason").collect())


def test_batches_until_every_day_is_closed(spark, tmp_dir):
    raw = landed(spark, tmp_dir)
    paths = queue.QueuePaths(f"{tmp_dir}/raw", f"{tmp_dir}/done", f"{tmp_dir}/closed")
    total = queue.unprocessed_rows(raw).count()
    closed, runs = [], 0
    while len(closed) < 3:
        closed += queue.queue_run(spark, paths, f"r{runs}", limit=total // 5, before="2024-02-01")
        runs += 1
        assert runs < 9
    assert closed == DAYS and queue.open_days(spark, paths, "next") == []
    res = clean_listings(raw)
    want = sorted([(r.Id, None) for r in res.clean.select("Id").collect()] + [(r.Id, r.reason) for r in res.rejected.select("Id", "reason").collect()])
    assert outputs(spark, tmp_dir) == want
    assert queue.queue_run(spark, paths, "late", before="2024-02-01") == [] and outputs(spark, tmp_dir) == want


def test_a_run_again_replaces_its_batch(spark, tmp_dir):
    landed(spark, tmp_dir, DAYS[:1])
    paths = queue.QueuePaths(f"{tmp_dir}/raw", f"{tmp_dir}/done", f"{tmp_dir}/closed")
    queue.queue_run(spark, paths, "a", limit=100)
    first = outputs(spark, tmp_dir)
    assert len(first) == 100
    queue.queue_run(spark, paths, "a", limit=100)
    assert outputs(spark, tmp_dir) == first
    assert queue.queue_run(spark, paths, "b", before="2024-01-01") == []      # the day may still receive files
    landed(spark, tmp_dir, DAYS[1:2])
    assert queue.queue_run(spark, paths, "c", before="2024-01-03") == DAYS[:2]
    assert len(set(outputs(spark, tmp_dir))) == len(outputs(spark, tmp_dir))


def test_closed_days_are_not_read(spark, tmp_dir):
    landed(spark, tmp_dir, DAYS[:1])
    paths = queue.QueuePaths(f"{tmp_dir}/raw", f"{tmp_dir}/done", f"{tmp_dir}/closed")
    assert queue.queue_run(spark, paths, "a", before="2024-01-02") == DAYS[:1]
    landed(spark, tmp_dir, DAYS[1:2])
    days = queue.open_days(spark, paths, "b")
    assert days == DAYS[1:2]
    batch = queue.pending(spark, paths, days)
    assert {r.landed for r in batch.select("landed").distinct().collect()} == {"2024-01-02"}
    plan = batch._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.split("\n") if "FileScan parquet" in line]
    assert len(scans) == 2 and all("PartitionFilters: [" in s and "2024-01-02" in s.split("PartitionFilters")[1] for s in scans)
