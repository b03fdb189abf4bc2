from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    from parcelle.session import build_session
    return build_session("local[4]", app_name="parcelle-llm-tests", shuffle_partitions=4)


@pytest.fixture()
def make_docs(spark):
    def make(texts, ids=None):
        ids = list(range(len(texts))) if ids is None else ids
        return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in zip(ids, texts, strict=True)], DOCS)
    return make


@pytest.fixture()
def odd_docs(spark, make_docs):
    """Nulls, empty and long texts, ties, repeated rows, and a further column with an awkward name."""
    docs = make_docs([None, "", "  \n", "a b c d e f g", "a b c d e f g", "x " * 30_000, "plain words stand here", "plain words stand here", "1 " * 2000],
                     [None, 1, 2, 3, 3, 5, 6, 7, 8])
    from pyspark.sql import functions as F
    return docs.withColumn("row", F.lit("clash")).withColumn("_base", F.lit(1)).withColumn("a.b", F.lit(2))
