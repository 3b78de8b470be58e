"""Language identification by compression.

For every language a raw-content zstandard dictionary is cut from labelled training
texts. A text is encoded once with each dictionary, in blocks so that its own
repetitions cannot stand in for the dictionary, and the language with the
smallest total wins. A half byte at most goes to the share of words a dictionary holds, which
settles ties on very short texts. The score is the margin to the next language;
narrow margins are rejected.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from . import shipped
from .common import release

shipped(__name__)

UNKNOWN = "und"
EXCERPT = 1_024      # characters one text may give to it
SAMPLE = 400         # texts asked for per language: the documented bound of the training sample
BLOCK = 1_024        # bytes compressed at a time
NARROW = 0.002       # margin, as a share of the next best size, under which a text is rejected
OUT = "doc_id long, held_out boolean, lang_pred string, score double, rejected boolean"


def remainder(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4))


def fit(labelled: DataFrame, sample: int = SAMPLE) -> dict[str, bytes]:
    """A dictionary per language from ``labelled`` (text, lang), at most ``sample`` texts of each; it holds all their excerpts.

    The sample takes the distinct texts whose hash is least, so it depends neither on partitions nor on copies. Null texts and languages are left out.
    """
    rows = labelled.where("lang is not null and text is not null").select("lang", "text", F.xxhash64("text").alias("h"))
    # Texts, not rows, are ranked: copies count once. Each partition passes on its ``sample`` least hashes of a language only.
    ranked = rows.select("lang", "h").distinct().withColumn("at", F.expr("row_number() over (partition by lang order by h)")).where(F.col("at") <= sample)
    chosen = rows.sparkSession.createDataFrame(ranked.collect(), "lang string, h long, at int")  # at most languages x sample hashes
    # A middle excerpt of each text.
    start = F.greatest(F.lit(1), ((F.length("text") - EXCERPT) / 2).cast("int"))
    least = rows.join(F.broadcast(chosen), ["lang", "h"]).groupBy("lang", "at").agg(F.min(F.substring(F.col("text"), start, F.lit(EXCERPT))).alias("part"))
    content: dict[str, list[str]] = {}
    for r in least.orderBy("lang", "at").collect():  # at most languages x sample excerpts
        content.setdefault(r["lang"], []).append(r["part"])
    return {lang: "\n".join(parts).lower().encode("utf-8", "replace") for lang, parts in content.items()}


class Classifier:
    """Encoders of all languages; built once per task from the dictionaries."""

    def __init__(self, dictionaries: dict[str, bytes]):
        settings = zstandard.ZstdCompressionParameters(
            strategy=zstandard.STRATEGY_LAZY, min_match=4, search_log=3, hash_log=18, chain_log=18, window_log=21,
            target_length=32, write_content_size=0, write_checksum=0, write_dict_id=0)
        self.langs = sorted(dictionaries)
        self.encoders, self.words = [], []
        for lang in self.langs:
            held = zstandard.ZstdCompressionDict(dictionaries[lang], dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            held.precompute_compress(compression_params=settings)
            self.encoders.append(zstandard.ZstdCompressor(compression_params=settings, dict_data=held).compress)
            self.words.append(set(dictionaries[lang].split()))

    def classify(self, text: str | None) -> tuple[str, float]:
        """Language and margin in 0..1; ``und`` for a null text, one without letters, or without any language learned."""
        if not text or not self.langs or not any(map(str.isalpha, text)):
            return UNKNOWN, 0.0
        data = text.lower().encode("utf-8", "replace")
        blocks = [data[i:i + BLOCK] for i in range(0, len(data), BLOCK)]
        words = data.split() if len(data) <= BLOCK else []
        sizes = [
            sum(len(encode(b)) for b in blocks) - (0.5 * sum(w in held for w in words) / len(words) if words else 0)
            for encode, held in zip(self.encoders, self.words)
        ]
        best = int(np.argmin(sizes))
        others = [s for i, s in enumerate(sizes) if i != best]
        margin = 1.0 if not others else (min(others) - sizes[best]) / max(min(others), 1e-9)
        return self.langs[best], float(min(1.0, max(0.0, margin)))


def predict(docs: DataFrame, dictionaries: dict[str, bytes], narrow: float = NARROW) -> DataFrame:
    """doc_id, held_out, lang_pred, score and rejected of every row; only the text takes part in the prediction.

    Null and empty texts are ``und`` and rejected; repeated and null doc_ids are rows like others; other columns are ignored.
    """
    def run(batches):
        classifier = Classifier(dictionaries)
        for batch in batches:
            made = [classifier.classify(t) for t in batch["text"]]
            yield pd.DataFrame({
                "doc_id": batch["doc_id"].astype("Int64"), "held_out": batch["held_out"].astype(bool),
                "lang_pred": [lang for lang, _ in made], "score": [score for _, score in made],
                "rejected": [lang == UNKNOWN or score < narrow for lang, score in made],
            })

    held = F.coalesce(remainder(F.col("doc_id")) == 2, F.lit(False)).alias("held_out")
    return docs.select("doc_id", "text", held).mapInPandas(run, OUT)


def accepted(docs: DataFrame, dictionaries: dict[str, bytes], narrow: float = NARROW) -> DataFrame:
    """The rows of ``docs``, with all their columns, whose language is found by more than a narrow margin."""
    def run(batches):
        import pyarrow as pa

        release()  # what tasks of other steps have left
        classifier = Classifier(dictionaries)
        for batch in batches:
            text = batch.column("text")
            made = (classifier.classify(text[i].as_py()) for i in range(len(text)))  # one text at a time as a Python string
            yield batch.filter(pa.array([lang != UNKNOWN and score >= narrow for lang, score in made], pa.bool_()))
        del classifier
        release()

    return docs.mapInArrow(run, docs.schema)


def training_rows(docs: DataFrame) -> DataFrame:
    """The labelled rows a model may learn from: those of documents that are not held out."""
    return docs.where(remainder(F.col("doc_id")) != 2).select("text", "lang")


def identify(docs: DataFrame) -> DataFrame:
    return predict(docs, fit(training_rows(docs)))
