"""Cleaning boundaries (fixture F3 of FIXTURES.md)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from parcelle.operators.clean import CLEAN_COLUMNS, clean_listings, unprocessed

SCHEMA = ("_id string, price string, surface_m2 string, city string, property_type string, rooms string, "
          "scraped_at string, postal_code string, processed boolean, last_seen_at timestamp_ntz")
SEEN = dt.datetime(2024, 2, 1, 9, 0)


def row(i, price="50000", surface="50", ptype="Maison", rooms="3", date="2024-01-05", pc="75001",
        processed=False, city="Paris"):
    return (i, price, surface, city, ptype, rooms, date, pc, processed, SEEN)


def run(spark, rows):
    res = clean_listings(spark.createDataFrame(rows, SCHEMA))
    clean = {r.Id: r for r in res.clean.collect()}
    rejected = {r.Id: r.reason for r in res.rejected.collect()}
    return clean, rejected


def test_price_threshold_strict_and_dirty_values(spark):
    clean, rej = run(spark, [row("p1", price="10000"), row("p2", price="10000.01"), row("p3", price="NaN"),
                             row("p4", price="12 000"), row("p5", price=None)])
    assert set(clean) == {"p2"}
    assert rej == {"p1": "price", "p3": "price", "p4": "price", "p5": "price"}


def test_surface_threshold_inclusive(spark):
    clean, rej = run(spark, [row("s1", surface="8.99"), row("s2", surface="9")])
    assert set(clean) == {"s2"} and rej == {"s1": "surface"}


def test_postal_codes(spark):
    clean, rej = run(spark, [row("z1", pc="75 001"), row("z2", pc="7501"), row("z3", pc="75001A"),
                             row("z4", pc="75\u00a0001"), row("z5", pc=None), row("z6", pc="\t75001\n")])
    assert set(clean) == {"z1", "z6"}
    assert clean["z1"].ZipCode == "75001"
    # Java \s does not cover the no-break space, so that code stays invalid
    assert rej == {"z2": "postal_code", "z3": "postal_code", "z4": "postal_code", "z5": "postal_code"}


def test_types_and_studio_rooms(spark):
    clean, rej = run(spark, [row("t1", ptype=None), row("t2", ptype="Villa appartement"),
                             row("t3", ptype="Studio", rooms="3"), row("t4", ptype="château"),
                             row("t5", ptype="maison de ville"), row("t6", ptype="terrain"),
                             row("t7", ptype="Mas provençal")])
    assert clean["t2"].Logement == "maison"            # first keyword in list order wins
    assert clean["t3"].Logement == "appartement" and clean["t3"].Rooms == 1
    assert clean["t5"].Logement == "maison" and clean["t7"].Logement == "maison"
    assert clean["t2"].Name == "villa appartement"
    assert rej == {"t1": "type", "t4": "type", "t6": "type"}


def test_dates(spark):
    clean, _ = run(spark, [row("d1", date="2024-01-05"), row("d2", date="2024-01-05T10:00:00"),
                           row("d3", date=""), row("d4", date=None)])
    assert clean["d1"].Date == dt.date(2024, 1, 5)
    assert clean["d2"].Date == dt.date(2024, 1, 5)
    # missing scrape date falls back to the last-seen day
    assert clean["d3"].Date == dt.date(2024, 2, 1) and clean["d4"].Date == dt.date(2024, 2, 1)


def test_processed_flag(spark):
    clean, rej = run(spark, [row("f1", processed=True), row("f2", processed=False), row("f3", processed=None)])
    assert set(clean) == {"f2", "f3"} and rej == {}


def test_output_columns(spark):
    res = clean_listings(spark.createDataFrame([row("o1")], SCHEMA))
    assert res.clean.columns == ["Id", *CLEAN_COLUMNS]
    assert res.rejected.columns == ["Id", "reason"]


def test_limit_is_an_ordered_batch(spark):
    df = spark.createDataFrame([row(f"id{i}") for i in (5, 3, 9, 1)], SCHEMA)
    assert [r._id for r in unprocessed(df, limit=2).collect()] == ["id1", "id3"]


def test_clean_and_rejected_partition_the_unprocessed_rows(spark):
    from parcelle.sources import testdata
    from tests.conftest import SF_SMALL
    raw = testdata.listings_raw(spark, SF_SMALL)
    res = clean_listings(raw)
    n_unprocessed = unprocessed(raw).count()
    assert res.clean.count() + res.rejected.count() == n_unprocessed


def test_clean_thresholds_reach_the_parquet_scan(spark, tmp_dir):
    """The kept rows are a conjunction of checks, so the price and surface
    ranges become Parquet pushed filters (row-group skipping at scale), and the
    rejected side still names every failed row."""
    from parcelle.sources import files, testdata
    from tests.conftest import SF_SMALL
    path = f"{tmp_dir}/raw"
    testdata.listings_raw(spark, SF_SMALL).write.parquet(path)
    raw = files.read_listings(spark, path)
    res = clean_listings(raw)
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = res.clean._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = plan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThan(price,10000.0)" in pushed
    assert "GreaterThanOrEqual(surface_m2,9.0)" in pushed
    unprocessed_rows = raw.filter(~F.coalesce(F.col("processed"), F.lit(False))).count()
    assert res.clean.count() + res.rejected.count() == unprocessed_rows
