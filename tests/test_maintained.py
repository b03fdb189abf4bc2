"""Statistics carried along by upserts equal a recomputation over the whole state, to the bit."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelle.operators import buckets as bk
from parcelle.operators import stats
from parcelle.plans import jobs
from parcelle.sources import testdata
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(tuple(str(x) for x in r) for r in df.select(sorted(df.columns)).collect())


def test_sums_after_three_upserts_equal_recomputation(spark, tmp_dir):
    raw = testdata.listings_raw(spark, SF_SMALL)
    moved = (raw.filter("listing_url like '%3_2'").withColumn("price", F.col("price") / 3).withColumn("city", F.lit("Elsewhere"))
             .withColumn("last_seen_at", F.col("last_seen_at") + F.expr("interval 900 days")))
    gone = raw.filter("listing_url like '%1'").withColumn("price", F.lit(1.0)).withColumn("last_seen_at", F.col("last_seen_at") + F.expr("interval 950 days"))
    for version, batch in enumerate((raw.filter("source <> 'collector_n'"), raw.filter("source = 'collector_n'"), moved.unionByName(gone))):
        jobs.maintained_run(spark, tmp_dir, batch, version, bucket_count=16)
        state = bk.read_state(spark, f"{tmp_dir}/state", version)
        assert rows(jobs.kept_sums(spark, tmp_dir, version)) == rows(jobs.listing_sums(state))
    zipcodes, departments = testdata.zipcode_dim(spark, SF_SMALL), testdata.department_dim(spark, SF_SMALL)
    kept, anew = jobs.kept_sums(spark, tmp_dir, 2), jobs.listing_sums(state)
    for level in ("zipcode", "department", "region"):
        assert rows(stats.geo_stats_of(kept, level, zipcodes, departments)) == rows(stats.geo_stats_of(anew, level, zipcodes, departments))
    assert rows(stats.drilldown_of(kept, zipcodes, departments)) == rows(stats.drilldown_of(anew, zipcodes, departments))
    assert rows(stats.timeseries_of(kept)) == rows(stats.timeseries_of(anew))
    assert kept.filter("City = 'Elsewhere'").count() > 0 and kept.filter("_n <= 0").count() == 0


def test_an_upsert_again_gives_the_same_sums(spark, tmp_dir):
    raw = testdata.listings_raw(spark, SF_SMALL)
    jobs.maintained_run(spark, tmp_dir, raw, 0, bucket_count=4)
    for _ in range(2):
        jobs.maintained_run(spark, tmp_dir, raw.filter("rooms = 2"), 1)
    assert rows(jobs.kept_sums(spark, tmp_dir, 1)) == rows(jobs.listing_sums(bk.read_state(spark, f"{tmp_dir}/state", 1)))


def test_a_closing_run_writes_its_statistics_row(spark, tmp_dir):
    from parcelle.operators import state as st
    raw = testdata.listings_raw(spark, SF_SMALL)
    page = F.substring_index("listing_url", "_", 1)
    for version, (run, batch) in enumerate((("a", raw.filter("rooms <= 3")), ("b", raw.filter("rooms between 2 and 5")))):
        log = batch.groupBy(page.alias("page")).agg(F.count(F.lit(1)).alias("items"), F.min("last_seen_at").alias("fetched_at"))
        for _ in range(2):                                             # a run that is retried has one row
            row = jobs.collector_run(spark, tmp_dir, batch, log, run, version, "2001-06-01 00:00:00", "shutdown", bucket_count=8).collect()
        held = st.upsert(None, raw.filter("rooms <= 3")) if version else batch.limit(0)
        keys = held.select("listing_url").distinct()
        new = batch.select("listing_url").distinct().join(keys, "listing_url", "left_anti").count()
        assert len(row) == 1 and row[0].reason == "shutdown" and row[0].total_properties == batch.count()
        assert (row[0].new_properties, row[0].updated_properties) == (new, batch.count() - new)
        assert row[0].total_pages == batch.select(page).distinct().count()
    assert spark.read.parquet(f"{tmp_dir}/runs").count() == 2
    now = jobs.current_listings(spark, tmp_dir, 1, "1997-01-01 00:00:00")
    plain = st.deactivate(st.upsert(st.upsert(None, raw.filter("rooms <= 3")), raw.filter("rooms between 2 and 5")), "1997-01-01 00:00:00")
    assert rows(now) == rows(plain) and 0 < now.filter("is_active").count() < now.count()
