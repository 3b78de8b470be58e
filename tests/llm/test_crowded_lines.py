"""Lines that share a key with many others: the same links, without comparing each with each."""

from __future__ import annotations

import collections
import random

import pytest

from tideledger.llm import linededup

from tests.llm.test_operators import edits


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_finer_keys_lose_no_link(spark, distance, monkeypatch):
    monkeypatch.setattr(linededup, "CROWD", 1)
    rnd = random.Random(distance)
    every = {"".join(rnd.choice("abé") for _ in range(rnd.randrange(1, 9))) for _ in range(60)}
    for size in (5, 14, 40):
        base = [rnd.choice("abé 1") for _ in range(size)]
        for _ in range(40):
            line = list(base)
            for _ in range(rnd.randrange(0, 4)):
                at, kind = rnd.randrange(len(line)), rnd.randrange(3)
                line[at:at + (kind < 2)] = [] if kind == 1 else [rnd.choice("ab1")] + ([line[at]] if kind == 2 else [])
            every.add("x" + "".join(line) + "x")
    every = sorted(every)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(every)] + [(500, every[0]), (None, None)], "doc_id long, text string")
    links = collections.Counter()
    for i, a in enumerate(every):
        for b in every[:i]:
            if abs(len(a) - len(b)) <= distance and edits(a, b) <= distance:
                links.update((a, b))
    got = {r["doc_id"]: r["links"] for r in linededup.classes(docs, distance, short=1).collect()}
    assert {every[i]: got[i] for i in range(len(every))} == {a: links[a] for a in every}


def test_candidates_do_not_grow_with_the_square_of_a_group(spark, monkeypatch):
    rnd, base = random.Random(1), "one form letter, sent to the holder of number "
    numbers = {f"{rnd.randrange(10 ** 9):09d}" for _ in range(300)}
    docs = spark.createDataFrame([(i, f"{base}{n}, who should answer it soon.") for i, n in enumerate(sorted(numbers))], "doc_id long, text string")
    kept, stored = {}, linededup.stored
    monkeypatch.setattr(linededup, "stored", lambda df, label: kept.setdefault(label, stored(df, label)) if label == "line-pairs" else stored(df, label))
    linededup.links(docs)
    assert kept["line-pairs"].count() < 10 * len(numbers)
