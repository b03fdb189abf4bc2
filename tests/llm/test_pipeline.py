"""The pipeline stage by stage against plain versions, and the registered queries."""

from __future__ import annotations

import __spark_entry__ as contract
import corpus_pipeline
from parcelle.llm import decontamination, order_minhash, toxicity_kn

SF = "/root/testdata/sf0.001"


def test_registered():
    names = list(contract.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))


def test_stages(spark):
    from parcelle.llm.common import materialise
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("labels", "benchmark"))
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = materialise(stage(spark, kept, SF), name)
        assert out.dtypes == docs.dtypes
        before, after = {r.doc_id for r in kept.collect()}, {r.doc_id for r in out.collect()}
        assert after <= before
        if name == "toxicity":
            assert before - after == {r.doc_id for r in toxicity_kn.score(kept, labels).where("predicted = 1").collect()}
        elif name == "near_duplicates":
            assert after == {r.class_id for r in order_minhash.near_duplicates(kept).collect()}
        elif name == "decontamination":
            items = [decontamination.fold(r.text) for r in bench.collect()]
            assert before - after >= {r.doc_id for r in kept.collect() if any(i in decontamination.fold(r.text or "") for i in items)}
            assert before - after == {r.doc_id for r in decontamination.matches(kept, bench).collect()}
        else:
            assert after == before and all(r.n_chars == len(r.text) for r in out.collect())
        kept = out
    packed = corpus_pipeline.STAGES[-1][1](spark, kept, SF)
    assert {r.doc_id for r in packed.collect()} == {r.doc_id for r in kept.collect()}
