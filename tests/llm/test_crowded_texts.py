"""Texts that share a band with many others: the same links, without comparing each with each or keeping every text's shingles."""

from __future__ import annotations

import random

import pytest

from tideledger.llm import nearcopies

from test_whole_job import grams, word

SCHEMA = "doc_id long, text string"


def edited(rnd, base, edits):
    words = list(base)
    for _ in range(edits):
        words[rnd.randrange(len(words))] = word(rnd)
    return " ".join(words)


def counted(monkeypatch):
    """The tables that the stage writes, by label."""
    made, stored = {}, nearcopies.stored
    monkeypatch.setattr(nearcopies, "stored", lambda df, label: made.setdefault(label, []).append(stored(df, label)) or made[label][-1])
    return made


@pytest.mark.parametrize("crowd", [2, 64])
def test_crowded_bands_lose_no_link(spark, crowd, monkeypatch):
    monkeypatch.setattr(nearcopies, "CROWD", crowd)
    made, rnd = counted(monkeypatch), random.Random(3)
    base = [word(rnd) for _ in range(90)]
    texts = sorted({edited(rnd, base, rnd.randrange(1, 9)) for _ in range(220)})
    docs = spark.createDataFrame([*enumerate(texts), (500, texts[0]), (None, None)], SCHEMA)
    sets, parent = [grams(t) for t in texts], list(range(len(texts)))
    for i, x in enumerate(sets):
        for j in range(i):
            if parent[i] != parent[j] and len(x & sets[j]) >= 0.8 * len(x | sets[j]):
                a, b = sorted((parent[i], parent[j]))
                parent = [a if p == b else p for p in parent]
    assert 20 < len(set(parent)) < len(texts) - 20
    assert sorted(r["doc_id"] for r in nearcopies.representatives(docs).where("doc_id is not null").collect()) == sorted(set(parent))
    assert made["near-crowd"][0].count() > 50


def test_pairs_fetched_do_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    fetched, rnd, verified = [], random.Random(4), nearcopies._verified
    monkeypatch.setattr(nearcopies, "_verified", lambda pairs, sets, similar: fetched.append(pairs.count()) or verified(pairs, sets, similar))
    base = [word(rnd) for _ in range(90)]
    texts = [edited(rnd, base, 4) for _ in range(300)]
    kept = nearcopies.representatives(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).count()
    assert kept > 250 and sum(fetched) < 5 * len(texts)


def test_shingle_sets_are_made_for_texts_that_may_be_copies_only(spark, monkeypatch):
    made, rnd = counted(monkeypatch), random.Random(6)
    base = [word(rnd) for _ in range(90)]
    texts = [" ".join(word(rnd) for _ in range(90)) for _ in range(200)] + [" ".join(base), edited(rnd, base, 1)]
    assert nearcopies.representatives(spark.createDataFrame(list(enumerate(texts)), SCHEMA)).count() == 201
    assert "grams" not in made["near-sketches"][0].columns
    assert sum(t.count() for t in made["near-sets"]) == 2
