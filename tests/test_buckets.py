"""Keyed state in hash buckets: results of the plain upsert, only touched buckets rewritten, no shuffle of the state."""

from __future__ import annotations

import os

import pytest
from pyspark.sql import functions as F

from parcelle.operators import buckets as bk
from parcelle.operators import state as st
from parcelle.sources import testdata
from tests.conftest import SF_SMALL


def rows(df):
    return sorted((tuple(str(x) for x in r) for r in df.select(sorted(df.columns)).collect()))


def bucket_files(base):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, fs in os.walk(f"{base}/data") for f in fs if f.endswith(".parquet")}


def batches(spark):
    raw = testdata.listings_raw(spark, SF_SMALL)
    null_key = raw.limit(1).withColumn("listing_url", F.lit(None).cast("string"))
    first = raw.filter("source <> 'collector_n'").unionByName(null_key)
    second = raw.filter("listing_url like '%7_1'").unionByName(null_key).unionByName(
        raw.limit(2).withColumn("listing_url", F.concat(F.lit("/new"), "listing_url")))
    return first, second, raw.filter("source = 'collector_n'").drop("description")


def test_upserts_equal_the_plain_ones(spark, tmp_dir):
    plain = None
    for version, batch in enumerate(batches(spark)):
        bk.apply_batch(spark, tmp_dir, batch, version, buckets=8)
        plain = st.upsert(plain, batch)
        assert rows(bk.read_state(spark, tmp_dir, version)) == rows(plain)
    assert rows(bk.read_state(spark, tmp_dir)) == rows(plain) and bk.latest_version(spark, tmp_dir) == 2


def test_only_touched_buckets_are_written(spark, tmp_dir):
    first, _, _ = batches(spark)
    assert bk.apply_batch(spark, tmp_dir, first, 0, buckets=32) == 32
    before = bucket_files(tmp_dir)
    assert len(before) == 32                                           # one file for each bucket
    key = first.filter("listing_url is not null").first().listing_url
    assert bk.apply_batch(spark, tmp_dir, first.filter(F.col("listing_url") == key), 1) == 1
    after = bucket_files(tmp_dir)
    assert before.items() <= after.items() and len(after) == 33
    assert bk.read_state(spark, tmp_dir).count() == bk.read_state(spark, tmp_dir, 0).count()


def test_a_version_applied_again_is_the_same(spark, tmp_dir):
    first, second, _ = batches(spark)
    bk.apply_batch(spark, tmp_dir, first, 0, buckets=4)
    bk.apply_batch(spark, tmp_dir, second, 1)
    once = rows(bk.read_state(spark, tmp_dir, 1))
    bk.apply_batch(spark, tmp_dir, second, 1)                          # as after a crash before the manifest
    assert rows(bk.read_state(spark, tmp_dir, 1)) == once
    with pytest.raises(ValueError):
        bk.apply_batch(spark, tmp_dir, second, 3)
    with pytest.raises(ValueError):
        bk.read_state(spark, f"{tmp_dir}/nothing")


def test_state_is_not_shuffled(spark, tmp_dir):
    """The join takes the bucket files as they lie, pruned to the batch's buckets."""
    first, second, _ = batches(spark)
    bk.apply_batch(spark, tmp_dir, first, 0, buckets=32)
    bk.apply_batch(spark, tmp_dir, second, 1)
    plan = bk.merged(spark, tmp_dir, 1)._jdf.queryExecution().executedPlan().toString()
    lines = plan.split("\n")
    scan = next(i for i, line in enumerate(lines) if "Bucketed: true" in line)
    join = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line)
    assert join < scan and not any("Exchange" in line for line in lines[join:scan])
    assert "PartitionFilters: [bucket" in lines[scan] or "PartitionFilters: [isnotnull(bucket" in lines[scan]


def test_a_batch_is_dealt_a_bucket_a_task(spark, tmp_dir):
    """Dealt by the bucket's number, several buckets met in one task; the number of buckets follows the rows."""
    batch = testdata.listings_raw(spark, SF_SMALL)
    bk.apply_batch(spark, tmp_dir, batch, 0, buckets=24)
    files = [(d.rsplit("=", 1)[1], f.split("-")[1]) for d, _, fs in os.walk(f"{tmp_dir}/batch") for f in fs if f.endswith(".parquet")]
    assert len(files) == 24 and all(int(bucket) == int(task) for bucket, task in files)
    assert [bk.buckets_for(n) for n in (0, 4_000_000, 4_000_001, 216_000_000)] == [8, 8, 9, 432]


def test_a_version_moves_its_batch_once_and_leaves_no_shuffle(spark, tmp_dir):
    """The batch was shuffled again to meet the state or to become one, and shuffles stayed on the disks after their jobs."""
    first, second, _ = batches(spark)
    names = ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.sources.bucketing.autoBucketedScan.enabled",
             "spark.sql.classic.shuffleDependency.fileCleanup.enabled")
    before = [spark.conf.get(n, None) for n in names]
    shuffles = lambda: spark._jvm.org.apache.spark.SparkEnv.get().mapOutputTracker().shuffleStatuses().size()
    held = shuffles()
    with bk.once(spark):
        first.repartition(3, "listing_url").write.parquet(f"{tmp_dir}/any")
    assert shuffles() <= held
    bk.apply_batch(spark, tmp_dir, first, 0, buckets=16)
    assert len(bucket_files(tmp_dir)) == 16
    bk.apply_batch(spark, tmp_dir, second, 1)
    assert "Exchange" not in bk.merged(spark, tmp_dir, 1)._jdf.queryExecution().executedPlan().toString()
    assert [spark.conf.get(n, None) for n in names] == before
