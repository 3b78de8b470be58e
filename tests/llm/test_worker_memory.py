"""What stays in a Python worker between the steps, and how much reaches it at once."""

from __future__ import annotations

import corpus_pipeline
from tideledger.llm import common, packing
from tideledger.llm.queries import tokenizer_file


def test_encoders_go_when_another_step_releases():
    path = tokenizer_file()
    made = packing.encoder(path)
    common.release(keep=path)
    assert packing.encoder(path) is made
    common.release()
    assert packing.encoder(path) is not made
    common.release()


def test_stages_ask_for_small_batches(spark):
    docs = spark.createDataFrame([(i, f"some words of text number {i}", "en") for i in range(30)], "doc_id long, text string, lang string").selectExpr("*", "cast(length(text) as long) as n_chars")
    name, cleanup = "spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = {k: spark.conf.get(k) for k in (name, cleanup)}
    for stage in ("language", "lines", "near_copies", "packing"):
        try:
            spark.conf.set(name, 10_000)
            spark.conf.set(cleanup, False)
            dict(corpus_pipeline.STAGES)[stage](spark, docs, "").collect()
            assert int(spark.conf.get(name)) <= 1_000 and spark.conf.get(cleanup) == "true"
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
