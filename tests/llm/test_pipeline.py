"""The pipeline's stages on the smallest tables: columns, effects, and every operator query registered."""

from __future__ import annotations

import corpus_pipeline
from tideledger.llm import decontaminate, queries
from tideledger.llm.common import stored, table

SMALL = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = table(spark, SMALL, "documents")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, SMALL), f"test-{name}")
        assert docs.columns == columns
        seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert set(seen["lines"]) == set(seen["language"]) and set(seen["near_copies"]) < set(seen["lines"])
    assert not any(r["contaminated"] for r in decontaminate.report(docs, table(spark, SMALL, "benchmark")).collect())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, SMALL).collect()
    assert {r["doc_id"] for r in packed} == set(seen["benchmark"])
    whole = corpus_pipeline.run(spark, SMALL).collect()
    key = lambda r: (r["doc_id"], r["piece"], r["ids_crc32"])
    assert sorted(map(key, whole)) == sorted(map(key, packed))


def test_every_operator_is_registered():
    assert {n.split("_")[0] for n in queries.QUERIES} == {f"op{i}" for i in range(1, 14)} | {"pipeline"}
