"""Cases the operators once left out: each was lost or wrong before it was mended."""

from __future__ import annotations

import collections
import random

import numpy as np
import pytest

import corpus_pipeline
from tideledger.llm import language, linededup, lmscore, pii, queries, secretscan

from test_operators import edits

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def word(rnd, size=6):
    return "".join(rnd.choice(LETTERS) for _ in range(size))


def grams(text):
    w = text.lower().split()
    return {tuple(w[k:k + 5]) for k in range(max(len(w) - 4, 1))}


def test_near_copies_by_five_word_similarity(spark):
    rnd = random.Random(5)
    bases = [[word(rnd) for _ in range(rnd.randrange(90, 200))] for _ in range(40)]
    texts = [" ".join(b) for b in bases]
    for b in bases[:30]:
        for kind in range(3):
            w = list(b)
            if kind == 0:
                w[rnd.randrange(8, len(w) - 8)] = word(rnd)
            elif kind == 1:
                w += [word(rnd) for _ in range(len(w) // 10)]
            else:
                w = w[len(w) // 12:]
            texts.append(" ".join(w))
    texts += [" ".join(b[:len(b) // 2] + [word(rnd) for _ in range(len(b) // 2)]) for b in bases[30:]]  # half alike: no copies
    hub = [word(rnd) for _ in range(120)]  # copies that are only alike through the text in the middle
    texts += [" ".join(hub)] + [" ".join(hub[:10 * k] + [word(rnd)] + hub[10 * k + 1:10 * k + 5] + [word(rnd)] + hub[10 * k + 6:]) for k in range(1, 11)]
    texts += [None, "", "one two", "One  two", "two one"]
    sets = [grams(t or "") for t in texts]
    parent = list(range(len(texts)))
    for i, x in enumerate(sets):
        for j in range(i):
            if len(x & sets[j]) >= 0.8 * len(x | sets[j]):
                a, b = sorted((parent[i], parent[j]))
                parent = [a if p == b else p for p in parent]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    stage = dict(corpus_pipeline.STAGES)["near_copies"]
    kept = stage(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(parent)) and len(set(parent)) < 60


def test_one_repeated_letter_hides_no_key(spark):
    rnd = random.Random(7)
    usual = ["".join(rnd.choice("the of and alpha beta gamma delta river stone cloud paper green".split()) for _ in range(20)) for _ in range(300)]
    keys = ["".join(rnd.choice(LETTERS + LETTERS.upper() + "0123456789") for _ in range(90)) for _ in range(6)]
    texts = keys + usual + ["g" * 2000] + ["ha" * n for n in range(40, 52)]
    docs = spark.createDataFrame([(i, f"see {t} here") for i, t in enumerate(texts)], "doc_id long, text string")
    got = {r["doc_id"]: r["spans"] for r in secretscan.digest(secretscan.find(docs)).collect()}
    assert [got[i] for i in range(6)] == ["random:4:94"] * 6 and not any(got[i] for i in range(6, len(texts)))
    alone = {r["doc_id"]: r["spans"] for r in secretscan.digest(secretscan.find(docs.where("doc_id < 6 or doc_id % 40 = 10"))).collect()}
    assert [alone[i] for i in range(6)] == ["random:4:94"] * 6  # the same rule with few ordinary runs


def test_copies_do_not_empty_a_language(spark):
    text = "concat_ws(' ', transform(sequence(1, 30), i -> element_at(array({}), 1 + cast(pmod(xxhash64(id, i), 5) as int))))"
    other = spark.range(30).selectExpr(text.format("'zorb','klim','vran','ostu','pelk'") + " as text", "'xx' as lang")
    # The copies' hash is far from the least, and their number once set the share of hashes that was looked at.
    copied = spark.sql("select text from (select concat('mano liro tesa ugo fari ', id) as text from range(200)) order by xxhash64(text) desc limit 1").first()[0]
    few = spark.createDataFrame([(f"mano liro tesa ugo fari {i}",) for i in range(3)], "text string").where("xxhash64(text) > -9000000000000000000")
    copies = spark.range(400_000).selectExpr(f"'{copied}' as text").unionAll(few).selectExpr("text", "'yy' as lang")
    made = language.fit(other.unionAll(copies))
    assert set(made) == {"xx", "yy"} and copied.encode() in made["yy"]


def test_dictionaries_hold_the_whole_sample(spark):
    rnd = random.Random(8)
    texts = [" ".join(word(rnd) for _ in range(60)) for _ in range(60)]
    made = language.fit(spark.createDataFrame([(t, "xx") for t in texts], "text string, lang string"))
    assert all(t.encode() in made["xx"] for t in texts)


def test_lines_of_every_length(spark, tmp_path):
    a, b, c = "twenty-nine characters, a line", "a short one", "a short line"
    docs = spark.createDataFrame([(1, f"{a}\n{b}\n\nno"), (2, f"{b}\n{a[1:]}\n\n{c}"), (3, f"no\nquite another\n{b}")], "doc_id long, text string")
    docs = docs.selectExpr("doc_id", "text", "cast(length(text) as long) as n_chars")
    stage = dict(corpus_pipeline.STAGES)["lines"]
    assert {r["doc_id"]: r["text"] for r in stage(spark, docs, "").collect()} == {1: f"{a}\n{b}\n\nno", 2: f"{a[1:]}\n\n{c}", 3: "quite another"}
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["doc_id"], r["line_no"]): r for r in queries.op8_near_equal_lines(spark, str(tmp_path)).collect()}
    assert got[1, 0]["line_class"] == got[2, 1]["line_class"] and got[1, 0]["links"] == 1 and len(a) == 30


def test_short_lines_within_two_edits_are_linked(spark):
    every = ["abcd", "abed", "xyzw", "green tea", "green tee", "greentees", "black tea", "word", "wordy", "swordy", "abc"]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(every)], "doc_id long, text string")
    assert linededup.links(docs, short=linededup.DISTANCE + 2).count() == 6


@pytest.mark.parametrize("distance", [1, 2, 3])
def test_lines_of_any_length_against_all_pairs(spark, distance):
    rnd = random.Random(distance)
    every = {"".join(rnd.choice("abcé") for _ in range(rnd.randrange(1, 11))) for _ in range(90)} | {"a", "b", "xy", "zé", "abc", "abd", "ab", "abcd", "xyz", "xyza"}
    for size in range(11, 61):
        base = "".join(rnd.choice("abcdeé fgh") for _ in range(size - 2))
        every |= {f"x{base}y", f"x{base}yz", f"x{base[2:]}y", f"q{base}q", f"x{base[:5]}zz{base[5:]}zy"}
    every = sorted(every)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(every)] + [(500, every[0]), (501, "\n \n"), (None, None)], "doc_id long, text string")
    near = collections.defaultdict(set)
    for i, a in enumerate(every):
        for b in every[:i]:
            if abs(len(a) - len(b)) <= distance and edits(a, b) <= distance:
                near[a].add(b)
                near[b].add(a)
    got = {r["doc_id"]: r for r in linededup.classes(docs, distance, short=1).collect()}
    assert {every[i]: got[i]["links"] for i in range(len(every))} == {a: len(near[a]) for a in every}
    assert got[500]["line_class"] == got[0]["line_class"] and len(got) == len(every) + 1
    for a in every:
        assert {got[every.index(b)]["line_class"] for b in near[a]} <= {got[every.index(a)]["line_class"]}
    reached, classes = {}, 0
    for a in every:
        classes += a not in reached
        todo = [a]
        while todo:
            at = todo.pop()
            if at not in reached:
                reached[at] = classes
                todo += near[at]
    assert len({r["line_class"] for r in got.values()}) == classes


def test_patterns_found_by_found_instances(spark):
    texts = [f"please write to hein.{i}@mail.example.com today" for i in range(12)]
    texts += [f"please write to cust-88{i} today" for i in range(4)]  # found beside the addresses
    texts += [f"the holder of cust-88{i} called" for i in range(4)] + ["the holder of cust-9999 called"]  # only beside the found ones
    texts += ["there are 1234 stones in it", "there are 77 stones in it", "there are 5 stones in it"]
    texts += [f"mail u{i}@mail.example.com" for i in range(6)] + ["mail u-77"]  # one word at the start
    texts += [f"pin {4000 + i} ssn s{i}@mail.example.com" for i in range(6)] + ["pin 4821 ssn 123-45-6789"]  # behind another number
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {texts[r["doc_id"]]: r["spans"] for r in pii.digest(pii.find(docs)).collect()}
    assert got["the holder of cust-9999 called"] == "context:14:23"
    assert got["mail u-77"] == "context:5:9" and got["pin 4821 ssn 123-45-6789"] == "context:13:24"
    assert not any(s for t, s in got.items() if "stones" in t) and got["pin 4001 ssn s1@mail.example.com"].count("context") == 0


def test_every_position_of_every_text_is_trained(spark, monkeypatch):
    texts = ["same start " + " ".join(f"w{i}x{k}" for k in range(i % 40)) for i in range(120)] + ["same start"] * 700 + ["", None]
    docs = spark.createDataFrame([(t,) for t in texts], "text string").repartition(3)
    table = lmscore.slot_table(docs)
    words = [w for t in texts for w in (t or "").split()]
    counts = np.bincount([lmscore.Slots()[w] for w in words], minlength=lmscore.VOCABULARY) + 0.5
    groups = counts.reshape(-1, lmscore.GROUP).sum(axis=1)
    bias = lmscore.views(lmscore.first_weights(table))["group_bias"][0]
    assert np.allclose(bias, np.clip(np.log(groups / groups.mean()), -lmscore.BOUND, lmscore.BOUND), atol=1e-5)
    seen, trainer = [], lmscore.Trainer(lmscore.fresh())
    monkeypatch.setattr(lmscore, "train_batch", lambda w, context, target: seen.extend(target.tolist()))
    for at in range(lmscore.ROUNDS):
        for r in table.collect():
            trainer.add(np.array(r["slots"], np.int32), at, lmscore.ROUNDS)
    trainer.flush()
    assert sorted(seen) == sorted(lmscore.Slots()[w] for w in words) and trainer.seen == len(words)
