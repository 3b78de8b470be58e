"""The operators as registered queries over the given tables, with SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from . import ann, decontaminate, dialogue, imatch, language, linededup, lmscore, packing, phrases, pii, secretscan, sharding, simhash
from .common import table

QUERIES: dict = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.find(table(spark, sf_dir, "documents")))


@query
def op2_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), shards=40)


@query
def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(table(spark, sf_dir, "documents"))


@query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secretscan.digest(secretscan.find(table(spark, sf_dir, "documents")))


@query
def op5_benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


@query
def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.classes(table(spark, sf_dir, "documents"), shingle=3, radius=2)


@query
def op7_best_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_file(), limit=2048)


@query
def op8_near_equal_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.classes(table(spark, sf_dir, "documents"), short=1)


@query
def op9_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lmscore.score_corpus(table(spark, sf_dir, "documents"))


@query
def op10_cross_polytope(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.neighbours(table(spark, sf_dir, "embeddings"), k=5, every=50)


@query
def op11_imatch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return imatch.fingerprints(table(spark, sf_dir, "documents"))


@query
def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(table(spark, sf_dir, "documents"), top=2000)


@query
def op13_dialogue_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.audit(table(spark, sf_dir, "conversations"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


ORACLES = {"op5_benchmark_windows": decontaminate.ORACLE, "op12_phrases": phrases.ORACLE}
