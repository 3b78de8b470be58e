"""Operators that return the caller's rows leave every column's value as it was, whatever its name."""

from __future__ import annotations

from tideledger.llm import decontaminate, linededup, nearcopies, simhash

NAMES = ("doc", "drop", "drop_id", "own_key", "own_at", "hit_key", "keep_id", "keep_key", "key", "row", "own_doc", "new_text", "component", "class", "line", "node")
SCHEMA = "doc_id long, text string, n_chars long, " + ", ".join(f"{n} string" for n in NAMES)
LONG = "one quite long line that is said again and again in this place"


def rows():
    texts = ["alpha beta\n" + LONG, LONG + "\ngamma delta", "gamma delta epsilon zeta eta theta iota", None, "", "words of a benchmark item that nobody may learn from at all today"]
    return [(i, t, len(t or ""), *(f"{n}-{i}" for n in NAMES)) for i, t in enumerate(texts)]


def values(df):
    assert df.columns == ["doc_id", "text", "n_chars", *NAMES]
    return {r["doc_id"]: tuple(r[n] for n in NAMES) for r in df.collect()}


def test_values_stay(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    want = {r[0]: r[3:] for r in rows()}
    lines = linededup.without_repeats(docs, shortest=1)
    assert values(lines) == want
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in lines.collect()}[1] == ("gamma delta", 11)
    items = spark.createDataFrame([("b1", "benchmark item that nobody may learn from at all today")], "item_id string, text string")
    clean = values(decontaminate.clean(docs, items))
    assert clean == {i: v for i, v in want.items() if i != 5}
    for found in (values(simhash.representatives(docs)), values(nearcopies.representatives(docs))):
        assert found and all(want[i] == v for i, v in found.items())
