"""I-Match fingerprints against a plain version."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import pytest
import xxhash

from tideledger.llm import imatch

SCHEMA = "doc_id long, text string, lang string, slot long, guest string, next_text string, hashes string, edited string, h string, name string, df int"


def table(spark, rows):
    return spark.createDataFrame([(*r, "en", 1, "g", "n", "h", "e", "x", "m", 2) for r in rows], SCHEMA)


def h64(word):
    return xxhash.xxh64_intdigest(word.encode(), 42)


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def chained(values):
    """Hash of an array of 64-bit numbers: each one's hash is the next one's seed."""
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(v.to_bytes(8, "little"), seed)
    return seed


def distinct(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    return {h64(w) for w in re.split(r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+", low) if w}


def brute(rows):
    texts = [(i, t or "") for i, t in rows]
    df = collections.Counter(n for _, t in texts for n in distinct(t))
    band = {n for n, c in df.items() if len(texts) / 100 <= c <= len(texts) / 8}
    mask = (1 << 18) - 1
    flags = {n >> s & mask for n in band for s in (0, 18, 36)}

    def fingerprint(t):
        names = distinct(t)
        inside = {n for n in names if all(n >> s & mask in flags for s in (0, 18, 36))}
        kept = sorted(names if len(inside) < 8 else inside, key=signed)
        out, shift = [], 0
        for e, n in [(3, 8), *((e, 16) for e in range(5, 12))]:
            for j in range(n):
                subset = [n for n in kept if n >> shift & ((1 << e) - 1) == j]
                out.append(max(1, chained(subset) & 0x7FFF) if subset else 0)
            shift += e
        return out

    def like(a, b):
        told = [x == y for x, y in zip(a, b) if x or y]
        return sum(told) / len(told) if told else 1.0

    order = sorted(texts, key=lambda r: (r[0] is None, -(r[0] or 0), signed(h64(r[1])), r[1].encode()))
    out = []
    for (i, t), (_, after) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        new = t[:len(t) - half] + after[:half]
        a, b, c = map(fingerprint, (t, new, after))
        shown = lambda v: "".join(f"{x:04x}" for x in v)
        out.append((i, len(t), hashlib.sha256(new.encode()).hexdigest(), shown(a), shown(b), like(a, b), like(a, c)))
    return collections.Counter(out)


def corpus():
    rnd = random.Random(9)
    vocabulary = [f"w{i}" for i in range(900)] + "été straße 😀 Of THE and".split()
    weights = [1 / (i + 3) for i in range(len(vocabulary))]
    rows = [(i * 3, " ".join(rnd.choices(vocabulary, weights, k=rnd.randrange(1, 150)))) for i in range(600)]
    rows += [(5000 + i, rows[7][1]) for i in range(60)] + [(None, rows[i][1]) for i in range(40)] + [(7, f"{rows[i][1]} again") for i in range(120)]
    rows += [(6000, None), (6001, ""), (6002, "!!! ..."), (6003, "a"), (6004, "😀é" * 5), (6005, "x y " * 20_000), (6006, None), rows[3], rows[3], (None, None), (-(1 << 63), "low"), ((1 << 63) - 1, "w1 high")]
    rnd.shuffle(rows)
    return rows


def answers(df):
    return collections.Counter(tuple(r[c] for c in ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")) for r in df.collect())


@pytest.mark.parametrize("slot_rows", [4096, 37])
def test_equals_plain_version(spark, slot_rows):
    rows = corpus()
    assert answers(imatch.fingerprints(table(spark, rows).repartition(6), slot_rows)) == brute(rows)


def test_parts_of_ranges(spark, monkeypatch):
    monkeypatch.setattr(imatch, "MOST_RANGES", 3)
    rows = corpus()
    assert answers(imatch.fingerprints(table(spark, rows), 20)) == brute(rows)


def test_likeness_follows_the_edit(spark):
    rnd = random.Random(1)
    vocabulary = [f"w{i}" for i in range(2000)]
    rows = [(i, " ".join(rnd.choices(vocabulary, k=200))) for i in range(300)]
    got = imatch.fingerprints(table(spark, rows)).collect()
    mean = lambda name: sum(r[name] for r in got) / len(got)
    assert mean("near_edited") > 0.08 > 5 * mean("near_next") and sum(r["near_edited"] > r["near_next"] for r in got) > 0.97 * len(got)


def test_small_tables(spark):
    assert imatch.fingerprints(table(spark, [])).count() == 0
    (one,) = imatch.fingerprints(table(spark, [(1, "a b c d")])).collect()
    assert one["near_next"] == 1.0 and one["edited_sha256"] == hashlib.sha256(b"a b a b").hexdigest()
