"""Keyed state (fixture F2 of FIXTURES.md) and its invariants."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from parcelle.operators import state as st

SCHEMA = ("_id string, listing_url string, source string, price double, first_seen_at timestamp_ntz, "
          "last_seen_at timestamp_ntz, is_active boolean, update_count long, processed boolean")
T0, T1, T2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 2, 1), dt.datetime(2024, 3, 1)


def state_df(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def by_key(df):
    return {r.listing_url: r for r in df.collect()}


def current(spark):
    return state_df(spark, [
        ("s1", "u1", "a", 100.0, T0, T0, True, 2, True),
        ("s2", "u2", "a", 200.0, T0, T0, False, 1, None),   # inactive, will be re-seen
        ("s3", "u3", "a", 300.0, T0, T0, True, 1, False),   # untouched
        ("s4", None, "a", 400.0, T0, T0, True, 1, None),    # null key
    ])


def batch(spark):
    return state_df(spark, [
        ("b1", "u1", "b", 110.0, T1, T1, True, 1, None),
        ("b2", "u2", "b", 210.0, T1, T1, True, 1, None),
        ("b3", "u5", "b", 500.0, T1, T1, True, 1, None),     # new key, three times
        ("b4", "u5", "b", 510.0, T2, T2, True, 1, None),
        ("b5", "u5", "b", 505.0, T0, T1, True, 1, None),
        ("b6", None, "b", 410.0, T1, T1, True, 1, None),     # null key matches null key
    ])


def test_upsert(spark):
    out = by_key(st.upsert(current(spark), batch(spark)))
    assert set(out) == {"u1", "u2", "u3", "u5", None}
    u1 = out["u1"]
    assert (u1._id, u1.price, u1.source, u1.first_seen_at, u1.update_count, u1.processed) == \
        ("s1", 110.0, "b", T0, 3, True)
    assert out["u2"].is_active is True and out["u2"].update_count == 2
    assert out["u3"].price == 300.0 and out["u3"].update_count == 1 and out["u3"].source == "a"
    u5 = out["u5"]   # latest sighting wins, earliest first-seen kept, counter = sightings
    assert (u5.price, u5.last_seen_at, u5.first_seen_at, u5.update_count, u5.processed) == (510.0, T2, T0, 3, None)
    assert out[None].price == 410.0 and out[None].update_count == 2 and out[None]._id == "s4"


def test_counters(spark):
    c = st.upsert_counters(current(spark), batch(spark)).first()
    assert (c.scraped, c.inserted, c.modified) == (6, 1, 5)


def test_upsert_twice_changes_only_the_counter(spark):
    once = st.upsert(current(spark), batch(spark))
    twice = st.upsert(once, batch(spark))
    cols = [c for c in once.columns if c != "update_count"]
    assert once.select(*cols).exceptAll(twice.select(*cols)).count() == 0
    diff = once.alias("a").join(twice.alias("b"), F.col("a._id") == F.col("b._id")) \
        .select((F.col("b.update_count") - F.col("a.update_count")).alias("d"), F.col("a.listing_url").alias("k"))
    added = {r.k: r.d for r in diff.collect()}
    assert added == {"u1": 1, "u2": 1, "u3": 0, "u5": 3, None: 1}


def test_initial_load(spark):
    out = by_key(st.upsert(None, batch(spark)))
    assert out["u5"].update_count == 3 and out["u5"].first_seen_at == T0 and out["u5"].is_active


def test_deactivate(spark):
    now = dt.datetime(2024, 3, 31, 12, 0)
    df = state_df(spark, [
        ("d1", "a", "x", 1.0, T0, now - dt.timedelta(days=30), True, 1, None),              # exactly 30 days
        ("d2", "b", "x", 1.0, T0, now - dt.timedelta(days=30, seconds=1), True, 1, None),   # one second older
        ("d3", "c", "x", 1.0, T0, None, True, 1, None),
        ("d4", "d", "x", 1.0, T0, T0, False, 1, None),
    ])
    out = {r._id: r.is_active for r in st.deactivate(df, now).collect()}
    assert out == {"d1": True, "d2": False, "d3": True, "d4": False}


def test_dedupe_keeps_first_id_and_unique_keys(spark):
    df = state_df(spark, [
        ("i3", "k", "x", 1.0, T0, T0, True, 1, None), ("i1", "k", "x", 2.0, T0, T0, True, 1, None),
        ("i2", "k", "x", 3.0, T0, T0, True, 1, None), ("j1", "m", "x", 4.0, T0, T0, True, 1, None),
        ("n2", None, "x", 5.0, T0, T0, True, 1, None), ("n1", None, "x", 6.0, T0, T0, True, 1, None),
    ])
    kept = st.dedupe(df)
    assert sorted(r._id for r in kept.collect()) == ["i1", "j1", "n1"]
    assert st.key_violations(kept).count() == 0
    assert sorted(r._id for r in st.delete_candidates(df).collect()) == ["i2", "i3", "n2"]
    groups = {r.listing_url: (r.doc_id, r["count"]) for r in st.duplicate_groups(df).collect()}
    assert groups == {"k": ("i1", 3), None: ("n1", 2)}


def test_dedupe_on_a_hot_key_spreads_over_partitions(spark):
    """A key holding most rows is joined back on (key, id), not ranked in one
    window partition: the plan has no Window operator."""
    rows = [(f"h{i:05d}", "hot", "x", float(i), T0, T0, True, 1, None) for i in range(3000)]
    rows += [(f"c{i:05d}", f"k{i}", "x", 1.0, T0, T0, True, 1, None) for i in range(1000)]
    df = state_df(spark, rows).repartition(8)
    kept = st.dedupe(df)
    assert kept.count() == 1001
    assert "Window" not in kept._jdf.queryExecution().executedPlan().toString()


def test_mark_processed_and_incremental_batch(spark):
    raw = state_df(spark, [
        ("r1", "a", "x", 1.0, T0, T0, True, 1, None), ("r2", "b", "x", 1.0, T0, T0, True, 1, False),
        ("r3", "c", "x", 1.0, T0, T0, True, 1, True),
    ]).withColumn("surface_m2", F.lit(10.0)).withColumn("city", F.lit("c")).withColumn("property_type", F.lit("maison")) \
      .withColumn("rooms", F.lit(1)).withColumn("scraped_at", F.lit(None).cast("string")) \
      .withColumn("postal_code", F.lit("75001"))
    ids = spark.createDataFrame([("r1",)], "Id string")
    flags = {r._id: r.processed for r in st.mark_processed(raw, ids).collect()}
    assert flags == {"r1": True, "r2": False, "r3": True}
    pending = st.incremental_batch(raw, ids)
    assert [r._id for r in pending.collect()] == ["r2"]


def test_upsert_with_differing_columns(spark):
    cols = "listing_url string, source string, price double, last_seen_at timestamp, first_seen_at timestamp"
    at = __import__("datetime").datetime(2024, 1, 1)
    full = spark.createDataFrame([("a", "s", 1.0, at, at, ["x"]), ("b", "s", 2.0, at, at, ["y"])], cols + ", features array<string>")
    old = st.upsert(None, full)
    new = st.upsert(old, spark.createDataFrame([("a", "t", 3.0, at, at, "Lyon")], cols + ", city string"))
    got = {r.listing_url: (r.source, r.price, r.features, r.city) for r in new.collect()}
    assert got == {"a": ("t", 3.0, ["x"], "Lyon"), "b": ("s", 2.0, ["y"], None)}


def test_a_loaded_state_is_joined_where_it_lies(spark):
    """Two upserts shuffle each row once; null and repeated keys as in the null-safe join."""
    fields = "listing_url string, price double, first_seen_at timestamp, last_seen_at timestamp"
    first = spark.createDataFrame([("a", 1.0, None, None), (None, 2.0, None, None), ("", 3.0, None, None), ("=", 4.0, None, None), ("a", 5.0, None, None)], fields)
    second = spark.createDataFrame([("a", 6.0, None, None), (None, 7.0, None, None), ("b", 8.0, None, None), (None, 9.0, None, None)], fields)
    plain = st.upsert(st.upsert(None, first), second)
    keyed = st.upsert(st.upsert(None, first, keyed=True), second)
    assert keyed.columns == plain.columns and sorted(map(str, keyed.collect())) == sorted(map(str, plain.collect()))
    again = st.upsert(plain, first, keyed=True).drop(st.STORED_KEY)
    assert sorted(map(str, again.collect())) == sorted(map(str, st.upsert(plain, first).collect()))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        shuffles = [df._jdf.queryExecution().sparkPlan().toString() and df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
                    for df in (st.upsert(st.upsert(None, first, keyed=True), second), st.upsert(st.upsert(None, first), second))]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shuffles == [2, 4]
