"""Table reader: plain scans, no state between calls."""

from __future__ import annotations

import pytest

from parcelle.sources.tables import read_table, table_path
from tests.conftest import SF_SMALL


def test_one_scan_per_table(spark):
    from parcelle.plans.queries import QUERIES
    plan = QUERIES["dvf_normalise"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    scans = plan.count("FileScan parquet") + plan.count("Scan parquet")
    assert scans <= 10 and "RoundRobin" not in plan


def test_appended_rows_are_seen(spark, tmp_dir):
    path = table_path(tmp_dir, "nation")
    rows = spark.read.parquet(table_path(SF_SMALL, "nation"))
    rows.write.parquet(path)
    n = read_table(spark, tmp_dir, "nation").count()
    rows.write.mode("append").parquet(path)
    assert read_table(spark, tmp_dir, "nation").count() == 2 * n
    with pytest.raises(ValueError):
        read_table(spark, tmp_dir, "other")
