"""From documents to packed training sequences: five stages, each over all its predecessor kept.

Each stage is written as Parquet and read again, so a lost executor costs no more than the stage at hand.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tideledger.llm import decontaminate, language, linededup, nearcopies, packing
from tideledger.llm.common import stored, table
from tideledger.llm.queries import tokenizer_file

BATCH = 1_000  # texts that go to a Python worker at a time; the executor and the worker each hold a batch, read and made


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings of the stages: small batches, and shuffle files that go when their query ends, not when the driver collects its garbage."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH)
    spark.conf.set("spark.sql.classic.shuffleDependency.fileCleanup.enabled", True)
    return spark


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is found; those that the classifier rejects go."""
    prepared(spark)
    return language.accepted(docs, language.fit(language.training_rows(docs)))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that are not blank stay at their first place only, near-equal ones of 30 characters or more included."""
    prepared(spark)
    return linededup.without_repeats(docs, shortest=1)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of texts whose SimHash fingerprints differ in two bits or less, or whose five-word shingles are alike by 0.8 or more."""
    prepared(spark)
    return nearcopies.representatives(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    prepared(spark)
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed into sequences of 2048."""
    prepared(spark)
    return packing.pack(docs, tokenizer_file())


STAGES = [
    ("language", identify_language),
    ("lines", drop_repeated_lines),
    ("near_copies", drop_near_copies),
    ("benchmark", drop_benchmark),
    ("packing", pack_sequences),
]

# SQL has neither the dictionaries, the fingerprints nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
