"""Aggregations (fixtures F4, F5 of FIXTURES.md) and plan shape."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from parcelle.operators import stats
from parcelle.sources import testdata
from tests.conftest import SF_SMALL

CLEAN = "Id string, Name string, Price double, M2 double, City string, Logement string, Rooms int, Date date, ZipCode string"


def test_timeseries_mean_of_ratios(spark):
    d = dt.date
    df = spark.createDataFrame([
        ("1", "m", 100.0, 10.0, "Paris", "maison", 1, d(2024, 1, 5), "75001"),
        ("2", "m", 300.0, 10.0, "PARIS", "maison", 1, d(2024, 1, 20), "75001"),
        ("3", "m", 100.0, 0.0, "paris", "maison", 1, d(2024, 1, 21), "75001"),   # M2 = 0 ignored
        ("4", "m", 500.0, 10.0, "Paris", "maison", 1, d(2024, 3, 1), "75001"),
        ("5", "m", 500.0, 10.0, "Lyon", "maison", 1, d(2024, 3, 1), "69001"),
        ("6", "m", 500.0, 10.0, "Paris", "maison", 1, None, "75001"),
    ], CLEAN)
    out = [(r.month, r.price_m2) for r in stats.timeseries(df, city="paris").collect()]
    assert out == [(None, 50.0), (d(2024, 1, 1), 20.0), (d(2024, 3, 1), 50.0)]
    ranged = stats.timeseries(df, city="Paris", start="2024-01-01", end="2024-01-31").collect()
    assert [(r.month, r.price_m2) for r in ranged] == [(d(2024, 1, 1), 20.0)]
    per_city = stats.timeseries(df)
    assert per_city.columns == ["city", "month", "price_m2"] and per_city.count() == 4


def test_geo_stats_total_is_sum_of_types(spark):
    raw_clean = testdata.listings_raw(spark, SF_SMALL)
    from parcelle.operators.clean import clean_listings
    clean = clean_listings(raw_clean).clean
    s = stats.geo_stats(clean, "region", testdata.zipcode_dim(spark, SF_SMALL),
                        testdata.department_dim(spark, SF_SMALL))
    tot = s.filter(F.col("logement_type") == "total").select("region_name", F.col("nb_annonces").alias("t"))
    parts = s.filter(F.col("logement_type") != "total").groupBy("region_name").agg(F.sum("nb_annonces").alias("p"))
    assert tot.join(parts, "region_name").filter(F.col("t") != F.col("p")).count() == 0
    assert tot.count() == 5


def test_geo_stats_aggregates_before_the_dimension_join(spark):
    """The fact rows are pre-aggregated per postal code; the dimension join
    sits above that aggregate in the plan."""
    from parcelle.operators.clean import clean_listings
    clean = clean_listings(testdata.listings_raw(spark, SF_SMALL)).clean
    s = stats.geo_stats(clean, "department", testdata.zipcode_dim(spark, SF_SMALL),
                        testdata.department_dim(spark, SF_SMALL))
    plan = s._jdf.queryExecution().optimizedPlan().toString()
    first_join = plan.find("Join")
    assert first_join != -1 and plan.find("Aggregate", first_join) != -1
    with pytest.raises(ValueError):
        stats.geo_stats(clean, "department")


def test_influence_constant_column_is_undefined(spark):
    df = spark.createDataFrame([(1.0, 5.0, 2.0, 10), (2.0, 5.0, 4.0, 20), (3.0, 5.0, None, 30), (4.0, 5.0, 8.0, 40)],
                               "avg_price double, avg_rooms double, avg_m2 double, nb_annonces long")
    out = [(r.feature, r.correlation) for r in stats.influence(df).collect()]
    assert out[0] == ("avg_m2", 1.0) and out[1] == ("nb_annonces", 1.0)
    assert out[2] == ("avg_rooms", None)     # constant column sorts last, not an error


def test_bounds_truncate_toward_zero(spark):
    df = spark.createDataFrame([(2.7, -1.5), (9.9, 3.2)], "a double, b double")
    r = stats.bounds(df, ["a", "b"]).first()
    assert (r.a_min, r.a_max, r.b_min, r.b_max) == (2, 9, -1, 3)


def test_distinct_values_sorted_non_null(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",), ("b",)], "d string")
    assert [r.d for r in stats.distinct_values(df, "d").collect()] == ["a", "b"]


def test_run_metrics_denominators(spark):
    t = dt.datetime(2024, 1, 1)
    log = spark.createDataFrame([("r1", 0, t), ("r1", 0, t + dt.timedelta(seconds=10)), ("r2", 4, t)],
                                "run_id string, items int, fetched_at timestamp_ntz")
    out = {r.run_id: r for r in stats.run_metrics(log).collect()}
    assert out["r1"].total_pages == 0 and out["r1"].properties_per_page == 0.0
    assert out["r1"].time_per_property == 10.0 and out["r2"].properties_per_page == 4.0


def test_word_frequencies(spark):
    docs = spark.createDataFrame([("Le chat, le CHIEN; l'été été",), ("chat",)], "text string")
    out = [(r.word, r.n) for r in stats.word_frequencies(docs, top=3).collect()]
    assert out == [("chat", 2), ("le", 2), ("été", 2)]


def test_unknown_and_repeated_codes(spark):
    import pytest
    rows = spark.createDataFrame([("10000", 1), ("99999", 2)], "ZipCode string, n int")
    z = spark.createDataFrame([("10000", "10")], "ZipCode string, Department string")
    d = spark.createDataFrame([("10", "Aube", "Est")], "ID string, Name string, Region string")
    out = {r.ZipCode: r.region_name for r in stats.attach_geography(rows, z, d, "region").collect()}
    assert out == {"10000": "Est", "99999": "unknown"}
    with pytest.raises(Exception, match="repeated code"):
        stats.attach_geography(rows, z.unionAll(z), d, "region").collect()
