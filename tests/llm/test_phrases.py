"""Phrase mining against plain counting."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pyarrow as pa

from tideledger.llm import phrases

SCHEMA = "doc_id long, text string, lang string, a string, l int, total string, part string, name string, phrase string, size string, n int"


def brute(rows, top=2000, support=30, longest=4):
    count, totals = collections.defaultdict(collections.Counter), collections.Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", low):
            ws = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(ws)
            for size in range(1, longest + 1):
                for i in range(len(ws) - size + 1):
                    count[lang][tuple(ws[i:i + size])] += 1
    out = []
    for lang, f in count.items():
        kept = []
        wide = [(p, a) for p, a in f.items() if len(p) > 2 and a >= support]
        held = collections.Counter()
        for p, a in wide:
            for m in range(2, len(p)):
                for b in range(len(p) - m + 1):
                    held[p[b:b + m]] = max(held[p[b:b + m]], a)
        for p, a in f.items():
            if len(p) < 2 or a < support or (p in held and 100 * held[p] >= 80 * a):
                continue
            score, _, left, right = min((2000000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        kept.sort()
        out += [(lang, i, p.decode(), -a, left, right, totals[lang], -score) for i, (score, a, p, left, right) in enumerate(kept[:top], 1)]
    return sorted(out)


def corpus():
    rnd = random.Random(3)
    common = "the of and a to river stone cloud Paper GREEN seven été straße 😀 don't".split()
    rows = []
    for i in range(1200):
        ws = [rnd.choice(common) if rnd.random() < 0.8 else f"w{rnd.randrange(4000)}" for _ in range(rnd.randrange(1, 80))]
        text = "".join(w + rnd.choice([" "] * 9 + ["  ", "\t", ". ", ", ", "\n", "!?", "\r\n"]) for w in ws)
        rows.append((i, text, rnd.choice(["en", "en", "en", "fr", None])))
    rows += [(900 + i, "we agree to the terms of use. " * 3, "en") for i in range(40)] + [(1000 + i, "la la la la la", "fr") for i in range(20)]
    rows += [(2000, None, "en"), (2001, "", "de"), (2002, " \t\n.,", "de"), (2003, "alone", "xx"), (2004, "go on " * 30_000, "en"), (None, "the river stone", "en"), (5, "x", None)]
    rows += [(3000 + i, "big copy of many words here\x0bnow \x01  x", "en") for i in range(60)] + [rows[3]] * 3
    return rows


def table(spark, rows):
    return spark.createDataFrame([(*r, "a", 1, "t", "p", "n", "q", "s", 2) for r in rows], SCHEMA)


def answers(df):
    return sorted(tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in df.collect())


def test_equals_plain_counting(spark):
    rows = corpus()
    want = brute(rows)
    got = phrases.collocations(table(spark, rows))
    assert {c: t for c, t in got.dtypes if t != "bigint"} == {"lang": "string", "rank": "int", "phrase": "string"}
    assert answers(got) == want and len(want) > 100
    assert answers(phrases.collocations(table(spark, rows), top=7)) == brute(rows, top=7)


def test_many_shards_give_the_same(spark):
    rows = corpus()
    for shard in (40_000, 1_500):  # local supports of about 5, and of 1
        assert answers(phrases.collocations(table(spark, rows).repartition(5), shard=shard)) == brute(rows)


def test_a_shard_is_mined_completely():
    rnd = np.random.default_rng(1)
    texts = [" ".join(f"w{x}" for x in rnd.integers(0, 12, 60)) + ". w1" for _ in range(50)]
    distinct, codes, piece = phrases.words(pa.array(texts))
    word = phrases.named(distinct, "en")[codes]
    got = [sorted(counts.tolist()) for _, counts in phrases.mine(word, piece, 4)]
    count = [collections.Counter() for _ in range(4)]
    for t in texts:
        for p in t.split("."):
            ws = p.split()
            for size in range(1, 5):
                count[size - 1].update(tuple(ws[i:i + size]) for i in range(len(ws) - size + 1))
    assert got == [sorted(v for v in c.values() if v >= 4) for c in count]


def test_empty_table(spark):
    assert phrases.collocations(table(spark, [])).count() == 0
