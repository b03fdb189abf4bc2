"""Search filters (the source's two tests restated on results, plus the
boundary cases of the filter dictionary)."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from parcelle.operators import filters as flt

ROWS = [
    # Id, City, Logement, Price, Date
    ("a", "Paris", "appartement", 100000.0, dt.date(2024, 1, 1)),
    ("b", "PARIS 15", "Appartement", 200000.0, dt.date(2024, 12, 31)),
    ("c", "Paris", "maison", 150000.0, dt.date(2024, 6, 1)),
    ("d", "Lyon", "appartement", 150000.0, dt.date(2024, 6, 1)),
    ("e", "Paris", "appartement", 200000.01, dt.date(2024, 6, 1)),
    ("f", "Paris", "appartement", 150000.0, dt.date(2025, 1, 1)),
    ("g", "Pa%ris", "appartement", 150000.0, dt.date(2024, 6, 1)),
    ("h", None, "appartement", 150000.0, None),
]
SCHEMA = "Id string, City string, Logement string, Price double, Date date"


@pytest.fixture(scope="module")
def listings(spark):
    return spark.createDataFrame(ROWS, SCHEMA)


def ids(df):
    return sorted(r.Id for r in df.collect())


def test_no_filters_keeps_everything(spark, listings):
    assert flt.search_predicates(listings, flt.SearchFilters()) == []
    assert ids(flt.apply_filters(listings, flt.SearchFilters())) == sorted(r[0] for r in ROWS)


def test_no_filters_with_cap_is_ordered_limit(listings):
    out = flt.apply_filters(listings, flt.SearchFilters(), limit=3, order_by=["Id"])
    assert ids(out) == ["a", "b", "c"]


def test_all_filters(listings):
    f = flt.SearchFilters(city="Paris", property_type="Appartement", price_min=100000, price_max=200000,
                          start_date="2024-01-01", end_date="2024-12-31")
    assert len(flt.search_predicates(listings, f)) == 4
    # both range ends inclusive; city is a case-insensitive substring
    assert ids(flt.apply_filters(listings, f)) == ["a", "b"]


def test_all_types_disables_type_filter(listings):
    f = flt.SearchFilters(property_type="Tous")
    assert flt.search_predicates(listings, f) == []


def test_zero_bound_disables_price_range(listings):
    f = flt.SearchFilters(price_min=0, price_max=120000)
    assert flt.search_predicates(listings, f) == []


def test_one_range_end_is_ignored(listings):
    assert flt.search_predicates(listings, flt.SearchFilters(start_date="2024-01-01")) == []
    assert flt.search_predicates(listings, flt.SearchFilters(price_max=5)) == []


def test_city_wildcards_are_live(listings):
    # '%' in the input acts as a wildcard, '_' matches any one character
    assert ids(flt.apply_filters(listings, flt.SearchFilters(city="p%s"))) == ["a", "b", "c", "e", "f", "g"]
    assert ids(flt.apply_filters(listings, flt.SearchFilters(city="pa_ris"))) == ["g"]


def test_date_range_on_timestamp_column_ends_at_midnight(spark):
    df = spark.createDataFrame([("x", dt.datetime(2024, 12, 31, 0, 0)), ("y", dt.datetime(2024, 12, 31, 10, 0))],
                               "Id string, Date timestamp_ntz")
    f = flt.SearchFilters(start_date="2024-01-01", end_date="2024-12-31")
    assert ids(flt.apply_filters(df, f)) == ["x"]


def test_range_filter_bounds_inclusive_and_null_fails(spark):
    df = spark.createDataFrame([("a", 10.0, 5), ("b", 20.0, 50), ("c", None, 60), ("d", 20.5, 60)],
                               "zipcode_name string, avg_price double, nb_annonces long")
    out = flt.range_filter(df, {"avg_price": (10, 20)}, min_count=5)
    assert sorted(r.zipcode_name for r in out.collect()) == ["a", "b"]


def test_in_filter_skipped_when_empty(spark):
    df = spark.createDataFrame([("1",), ("2",)], "Department string")
    assert flt.in_filter(df, "Department", []).count() == 2
    assert flt.in_filter(df, "Department", ["2"]).count() == 1


def test_drop_missing_coordinates(spark):
    df = spark.createDataFrame([(1.0, 2.0), (None, 2.0), (1.0, None)], "lat double, lon double")
    assert flt.drop_missing_coordinates(df).count() == 1
    assert flt.drop_missing_coordinates(df.drop("lon")).count() == 3


def test_stats_lookup_exact_case(spark):
    df = spark.createDataFrame([("Paris", "total"), ("paris", "total"), ("Paris", "maison")],
                               "region_name string, logement_type string")
    assert flt.stats_lookup(df, "region", "Paris").count() == 1


def test_level_dispatch():
    assert flt.normalise_level("department") == "department"
    assert flt.normalise_level("region") == "region"
    assert [flt.normalise_level(x) for x in ("Code postal", "Département", "Région")] == ["zipcode", "department", "region"]
    with pytest.raises(ValueError):
        flt.normalise_level("pays")


def test_threshold_pads_and_repairs_department(spark):
    df = spark.createDataFrame(
        [("1", "Ain", "total", 1.0, 10), ("20", "Corse", "total", 1.0, 10), ("201", "X", "total", 1.0, 10),
         ("202", "Y", "total", 1.0, 10), ("971", "Z", "total", 1.0, 10), ("5", "W", "total", 1.0, 9)],
        "department_id string, department_name string, logement_type string, avg_price double, nb_annonces long")
    out = flt.stats_threshold(df, "department", "total", 10)
    assert sorted(r.department_id for r in out.collect()) == ["01", "2A", "2A", "2B", "971"]
    assert out.columns == ["department_id", "department_name", "avg_price", "nb_annonces"]


def test_existing_columns_requires_target_and_feature(spark):
    df = spark.createDataFrame([(1.0, 2.0)], "avg_price double, avg_m2 double")
    assert flt.existing_columns(df, ["nb_annonces", "avg_m2", "avg_price"]) == ["avg_m2", "avg_price"]
    with pytest.raises(ValueError):
        flt.existing_columns(df.drop("avg_m2"), ["nb_annonces", "avg_m2", "avg_price"])


def test_filters_reach_the_parquet_scan(spark, tmp_dir):
    path = f"{tmp_dir}/l"
    spark.createDataFrame(ROWS, SCHEMA).write.parquet(path)
    df = spark.read.parquet(path)
    out = flt.apply_filters(df, flt.SearchFilters(price_min=1, price_max=150000)).select("Id")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "Price" in plan and "GreaterThanOrEqual" in plan
    assert F is not None
