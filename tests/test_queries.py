"""Every registered query against its DuckDB statement on the smallest tables
(the driver runs the same comparison at sf0.01)."""

from __future__ import annotations

import math
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as contract
from parcelle.plans.oracle_sql import ORACLE as LIBRARY_ORACLE
from parcelle.plans.queries import QUERIES as LIBRARY
from parcelle.sources.tables import TABLES
from tests.conftest import SF_SMALL

QUERIES, ORACLE = dict(LIBRARY), dict(LIBRARY_ORACLE)


def norm(v):
    if isinstance(v, float) and math.isnan(v):
        return None
    if hasattr(v, "item"):
        return v.item()
    return v


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries()) and set(ORACLE) <= set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = QUERIES[name](spark, SF_SMALL)
    s_rows = Counter(tuple(norm(x) for x in r) for r in sdf.collect())
    res = duck.execute(ORACLE[name])
    d_cols = [d[0] for d in res.description]
    assert sorted(d_cols) == sorted(sdf.columns)
    order = [d_cols.index(c) for c in sdf.columns]
    d_rows = Counter(tuple(norm(r[i]) for i in order) for r in res.fetchall())
    assert s_rows == d_rows


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_types_match_oracle(spark, duck, name):
    s = {f.name: str(f.type) for f in QUERIES[name](spark, SF_SMALL).toArrow().schema}
    d = {f.name: str(f.type) for f in duck.sql(ORACLE[name]).to_arrow_table().schema}
    assert s == d


def test_entry_smoke(spark):
    df = contract.entry(spark)
    assert df.count() > 0
    assert df.columns == ["region_name", "logement_type", "avg_price", "avg_price_m2", "avg_m2", "avg_rooms",
                          "nb_annonces"]
