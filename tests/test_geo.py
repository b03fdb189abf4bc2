"""Geography joins (fixtures F6, F7 of FIXTURES.md)."""

from __future__ import annotations

from parcelle.operators import geo


def test_dept_stats_join_pads_ids_and_keeps_unmatched(spark):
    stats = spark.createDataFrame([("01", "Ain", 10.0, 5), ("2A", "Corse", 20.0, 6), ("99", "Nowhere", 1.0, 1)],
                                  "department_id string, department_name string, avg_price double, nb_annonces long")
    deps = spark.createDataFrame([(1, "Auvergne"), (20, "Corse")], "ID int, Region string")
    out = {r.department_id: r for r in geo.dept_stats_join(stats, deps).collect()}
    assert out["01"].Region == "Auvergne" and out["01"].department_label == "Ain - Auvergne"
    # repaired 2A does not meet the unrepaired dimension id 20; unknown code stays with null label
    assert out["2A"].Region is None and out["2A"].department_label is None
    assert out["99"].department_label is None


def test_geo_inner_join_drops_unmatched_on_both_sides(spark):
    features = spark.createDataFrame([("1", "Ain", "{}"), ("3", "Allier", "{}")], "code string, nom string, geometry string")
    stats = spark.createDataFrame([("01", 10.0), ("02", 20.0)], "department_id string, avg_price double")
    out = geo.geo_inner_join(features, stats).collect()
    assert [(r.code, r.nom) for r in out] == [("01", "Ain")]


def test_region_join_is_case_insensitive(spark):
    features = spark.createDataFrame([("84", "Auvergne-Rhône-Alpes", "{}"), ("11", "Île-de-France", "{}")],
                                     "code string, nom string, geometry string")
    stats = spark.createDataFrame([("AUVERGNE-RHÔNE-ALPES", 5.0), ("Bretagne", 1.0)], "region_name string, avg_price double")
    out = geo.region_ci_join(features, stats).collect()
    assert [(r.nom, r.region_name) for r in out] == [("auvergne-rhône-alpes", "auvergne-rhône-alpes")]


def test_zip_left_join_null_code_matches_nothing(spark):
    stats = spark.createDataFrame([("75001", 1.0), (None, 2.0)], "zipcode_name string, avg_price double")
    zips = spark.createDataFrame([("75001", "75"), (None, "??")], "ZipCode string, Department string")
    out = {r.avg_price: r.Department for r in geo.zip_left_join(stats, zips).collect()}
    assert out == {1.0: "75", 2.0: None}


def test_preview_drops_geometry(spark):
    df = spark.createDataFrame([(i, "{}") for i in range(10)], "code int, geometry string")
    out = geo.drop_geometry_preview(df, 5, order_by=["code"])
    assert out.columns == ["code"] and [r.code for r in out.collect()] == [0, 1, 2, 3, 4]
