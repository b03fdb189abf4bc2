"""Incremental intake: each landed file is processed once, reruns add nothing."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelle.sources import testdata
from parcelle.streaming.intake import read_intake, run_intake
from tests.conftest import SF_SMALL


def test_available_now_intake_is_incremental(spark, tmp_dir):
    raw = testdata.listings_raw(spark, SF_SMALL)
    landing, out, ckpt = f"{tmp_dir}/landing", f"{tmp_dir}/out", f"{tmp_dir}/ckpt"
    first = raw.filter(F.col("source") == "collector_a")
    second = raw.filter(F.col("source") != "collector_a")
    first.write.mode("append").parquet(landing)
    run_intake(spark, landing, out, ckpt)
    n1 = read_intake(spark, out).count()
    run_intake(spark, landing, out, ckpt)                      # nothing new: no new rows
    assert read_intake(spark, out).count() == n1
    second.write.mode("append").parquet(landing)
    run_intake(spark, landing, out, ckpt)
    from parcelle.operators.clean import clean_listings
    res = clean_listings(raw)
    assert read_intake(spark, out).count() == res.clean.count()
    assert read_intake(spark, out, "rejected").count() == res.rejected.count()
    ids = read_intake(spark, out).select("Id")
    assert ids.distinct().count() == ids.count()


def test_default_checkpoint_per_source_and_output(spark, tmp_dir):
    from parcelle.streaming.intake import default_checkpoint
    a = default_checkpoint(spark, f"{tmp_dir}/landing_a", f"{tmp_dir}/out")
    b = default_checkpoint(spark, f"{tmp_dir}/landing_b", f"{tmp_dir}/out")
    assert a != b and a == default_checkpoint(spark, f"{tmp_dir}/landing_a", f"{tmp_dir}/out")
    from parcelle.session import ensure_checkpoint_dir
    assert a.startswith(ensure_checkpoint_dir(spark).rstrip("/"))


def test_two_sources_into_one_output(spark, tmp_dir):
    raw = testdata.listings_raw(spark, SF_SMALL)
    out = f"{tmp_dir}/out"
    for name, part in (("a", raw.filter(F.col("source") == "collector_a")), ("b", raw.filter(F.col("source") != "collector_a"))):
        part.write.parquet(f"{tmp_dir}/{name}")
        run_intake(spark, f"{tmp_dir}/{name}", out, f"{tmp_dir}/ckpt_{name}")
    from parcelle.operators.clean import clean_listings
    assert read_intake(spark, out).count() == clean_listings(raw).clean.count()


def listing(i, **fields):
    from parcelle.schema import LISTINGS_RAW
    row = dict.fromkeys(LISTINGS_RAW.names) | {"_id": i, "price": 200_000.0, "surface_m2": 50.0, "city": "Lyon", "property_type": "Maison",
                                               "rooms": 3, "postal_code": "69003", "scraped_at": "2024-05-01"} | fields
    return tuple(row[c] for c in LISTINGS_RAW.names)


def land(spark, path, rows):
    from parcelle.schema import LISTINGS_RAW
    spark.createDataFrame(rows, LISTINGS_RAW).coalesce(1).write.mode("append").parquet(path)


def ids(spark, out, part="clean"):
    return sorted(r.Id for r in read_intake(spark, out, part).collect())


def test_each_id_once_across_files_runs_and_checkpoints(spark, tmp_dir):
    landing, out = f"{tmp_dir}/landing", f"{tmp_dir}/out"
    land(spark, landing, [listing("1"), listing("2"), listing("p", processed=True), listing("bad", price=1.0)])
    land(spark, landing, [listing("1", price=210_000.0)])                      # the same id in a second file
    run_intake(spark, landing, out, f"{tmp_dir}/ckpt", max_files_per_trigger=1)
    assert ids(spark, out) == ["1", "2"] and ids(spark, out, "rejected") == ["bad"]
    land(spark, landing, [listing("2"), listing("3"), listing("bad", price=1.0)])   # after a restart
    run_intake(spark, landing, out, f"{tmp_dir}/ckpt")
    assert ids(spark, out) == ["1", "2", "3"] and ids(spark, out, "rejected") == ["bad"]
    first = {r.stream for r in read_intake(spark, out).select("stream").distinct().collect()}
    assert len(first) == 1
    before = {(r.Id, r.stream, r.batch_id, r.Price) for r in read_intake(spark, out).collect()}
    land(spark, landing, [listing("4")])
    run_intake(spark, landing, out, f"{tmp_dir}/lost")                         # a lost checkpoint: everything is read again
    after = {(r.Id, r.stream, r.batch_id, r.Price) for r in read_intake(spark, out).collect()}
    assert before <= after and sorted(r[0] for r in after) == ["1", "2", "3", "4"]
    assert ids(spark, out, "rejected") == ["bad"]


def test_a_batch_run_again_replaces_its_folder(spark, tmp_dir):
    from parcelle.schema import LISTINGS_RAW
    from parcelle.streaming.intake import clean_batch
    batch = spark.createDataFrame([listing("1"), listing("2", price=1.0)], LISTINGS_RAW)
    for _ in range(2):
        clean_batch(batch, 0, f"{tmp_dir}/out", "a")
    assert ids(spark, f"{tmp_dir}/out") == ["1"] and ids(spark, f"{tmp_dir}/out", "rejected") == ["2"]
    clean_batch(batch, 0, f"{tmp_dir}/out", "b")                               # another stream adds nothing and takes nothing away
    assert ids(spark, f"{tmp_dir}/out") == ["1"]


def test_own_output_is_not_scanned(spark, tmp_dir):
    """The ids of other streams only: the stream's own folders are pruned."""
    from parcelle.schema import LISTINGS_RAW
    from parcelle.streaming.intake import clean_batch, written_elsewhere
    batch = spark.createDataFrame([listing("1")], LISTINGS_RAW)
    for name in ("a", "b"):
        clean_batch(batch if name == "a" else batch.withColumn("_id", F.lit("2")), 0, f"{tmp_dir}/out", name)
    elsewhere = written_elsewhere(spark, f"{tmp_dir}/out", "a")
    assert [r.Id for r in elsewhere.collect()] == ["2"]
    assert "PartitionFilters: [isnotnull(stream" in elsewhere._jdf.queryExecution().executedPlan().toString()


def test_only_the_cleaning_fields_move(spark):
    """What the stream shuffles by id are the fields that cleaning reads."""
    from parcelle.operators.clean import CLEAN_INPUT_FIELDS
    from parcelle.schema import LISTINGS_RAW
    from parcelle.streaming.intake import new_listings
    landed = spark.createDataFrame([listing("1"), listing("1"), listing("p", processed=True), listing(None), listing(None)], LISTINGS_RAW)
    new = new_listings(landed)
    assert set(new.columns) == {*CLEAN_INPUT_FIELDS, "last_seen_at"}
    assert sorted(str(r._id) for r in new.collect()) == ["1", "None"]
