"""The near-copy stage links by SimHash fingerprints as well as by shingle sets."""

from __future__ import annotations

import corpus_pipeline
from tideledger.llm import nearcopies, simhash

SCHEMA = "doc_id long, text string"


def kept(spark, rows):
    return sorted(r["doc_id"] for r in corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, SCHEMA), "").collect())


def test_fingerprints_link_what_shingle_sets_do_not(spark):
    common = "alpha beta gamma " * 60
    a, b = common + "one two three four five six", common + "seven eight nine ten eleven twelve"
    x, y = (set(nearcopies.shingles(simhash.split_words(t)).tolist()) for t in (a, b))
    bits = simhash.fingerprint(simhash.split_words(a), 3) ^ simhash.fingerprint(simhash.split_words(b), 3)
    assert len(x & y) < 0.8 * len(x | y) and bits.bit_count() <= 2
    other = " ".join(f"other{i}" for i in range(60))
    assert kept(spark, [(4, a), (2, b), (9, other), (None, other)]) == [2, 9]


def test_shingle_sets_link_what_fingerprints_do_not(spark):
    words = [f"word{i}" for i in range(100)]
    edited = [*words[:50], "changed", *words[51:], "and", "more", "words", "here"]
    bits = simhash.fingerprint(words, 3) ^ simhash.fingerprint(edited, 3)
    assert bits.bit_count() > 2
    assert kept(spark, [(1, " ".join(words)), (5, " ".join(edited)), (7, " ".join(reversed(words)))]) == [1, 7]


def test_a_chain_of_both_kinds_is_one_group(spark):
    common = "alpha beta gamma " * 60
    tail = [f"tail{i}" for i in range(80)]
    b = common + " ".join(tail[:6])
    c = common + " ".join(tail[:7])
    assert kept(spark, [(3, common + "one two three four five six"), (2, b), (8, c), (6, None), (7, "")]) == [2, 6]
