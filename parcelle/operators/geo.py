"""Joins between statistics, geography dimensions and map features.

Dimension tables (departments, regions, map features) are small and bounded
by geography, not by listing volume; the joins are written as plain equi-joins
and Spark's size-checked broadcast (``autoBroadcastJoinThreshold`` plus AQE's
runtime statistics) decides whether a side is broadcast. Nothing is
force-broadcast, so a dimension that outgrows the threshold falls back to a
shuffle join instead of failing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelle.functions.geo import pad_code
from parcelle.functions.text import label_join


def dept_stats_join(dept_stats: DataFrame, departments: DataFrame) -> DataFrame:
    """Department statistics LEFT JOIN department table on padded ids, plus
    the ``name - region`` label (null when the region is unknown)."""
    d = departments.select(pad_code(F.col("ID")).alias("ID"), "Region")
    out = dept_stats.join(d, pad_code(dept_stats["department_id"]) == d["ID"], "left")
    return out.withColumn("department_label", label_join(F.col("department_name"), F.col("Region")))


def geo_inner_join(features: DataFrame, dept_stats: DataFrame) -> DataFrame:
    """Map features INNER JOIN department statistics on ``code = department_id``
    (codes padded to two characters first)."""
    f = features.withColumn("code", pad_code(F.col("code")))
    return f.join(dept_stats, f["code"] == dept_stats["department_id"], "inner")


def region_ci_join(features: DataFrame, region_stats: DataFrame) -> DataFrame:
    """Region features INNER JOIN region statistics on lower-cased names; both
    name columns come out lower-cased."""
    f = features.withColumn("nom", F.lower(F.col("nom")))
    s = region_stats.withColumn("region_name", F.lower(F.col("region_name")))
    return f.join(s, f["nom"] == s["region_name"], "inner")


def zip_left_join(zip_stats: DataFrame, zipcodes: DataFrame) -> DataFrame:
    """Postal-code statistics LEFT JOIN postal-code table (SQL null semantics:
    a null code matches nothing)."""
    return zip_stats.join(zipcodes, zip_stats["zipcode_name"] == zipcodes["ZipCode"], "left")


def drop_geometry_preview(df: DataFrame, n: int = 5, *, order_by) -> DataFrame:
    """First ``n`` rows in the given order, without the geometry column."""
    return df.drop("geometry").orderBy(*order_by).limit(n)
