"""A step of the language model against plain arithmetic, and the work it may repeat."""

from __future__ import annotations

import numpy as np

from tideledger.llm import lmscore as lm


def plain_step(w: dict, context: np.ndarray, target: np.ndarray, rate: float) -> dict:
    w = {k: v.astype(float) for k, v in w.items()}
    grad = {k: np.zeros_like(v) for k, v in w.items()}
    for near, to in zip(context, target):
        g, m = divmod(int(to), lm.GROUP)
        x = w["embed"][near].ravel()
        h = np.tanh(x @ w["mix"] + w["bias"][0])
        inside = w["member"][g].reshape(lm.HIDDEN, lm.GROUP)
        outer, inner = (np.exp(v) / np.exp(v).sum() for v in (h @ w["group"] + w["group_bias"][0], h @ inside + w["member_bias"][g]))
        outer[g] -= 1
        inner[m] -= 1
        back = (w["group"] @ outer + inside @ inner) * (1 - h * h)
        grad["group"] += np.outer(h, outer)
        grad["group_bias"][0] += outer
        grad["member"][g] += np.outer(h, inner).ravel()
        grad["member_bias"][g] += inner
        grad["mix"] += np.outer(x, back)
        grad["bias"][0] += back
        np.add.at(grad["embed"], near, (w["mix"] @ back).reshape(-1, lm.EMBED))
    scale = rate / np.sqrt(len(target))
    return {k: np.clip(v - np.clip(scale * grad[k], -lm.LEAP, lm.LEAP), -lm.BOUND, lm.BOUND) for k, v in w.items()}


def test_a_step_in_single_precision(monkeypatch):
    rng = np.random.default_rng(2)
    flat = np.clip(rng.normal(0, 0.6, lm.SIZE), -lm.BOUND, lm.BOUND).astype(np.float32)
    w, move, kinds = lm.views(flat), lm._move, []
    context = rng.integers(0, lm.VOCABULARY + 1, (300, 2 * lm.WINDOW)).astype(np.int32)
    target = np.where(rng.random(300) < 0.3, 77, rng.integers(0, lm.VOCABULARY // 2, 300)).astype(np.int32)
    want = plain_step(w, context, target, 2.0)
    monkeypatch.setattr(lm, "_move", lambda weights, step: (kinds.append(step.dtype), move(weights, step)))
    lm.train_batch(w, context, target, 2.0)
    assert all(np.allclose(w[k], want[k], atol=2e-5) for k in want)
    assert set(kinds) == {np.dtype(np.float32)} and len(kinds) < 10  # not one for each group


def test_words_become_slots_once(spark, monkeypatch):
    read = []
    make = lm._slot_table
    monkeypatch.setattr(lm, "_slot_table", lambda docs: read.append(1) or make(docs))
    docs = spark.createDataFrame([(1, "a b c a"), (2, None), (2, ""), (None, "a b")], "doc_id long, text string")
    got = lm.score_corpus(docs).collect()
    assert read == [1] and sorted((r["n_words"], r["mean_logprob"] is None) for r in got) == [(0, True), (0, True), (2, False), (4, False)]
    again = {r["n_words"]: r["logprob"] for r in lm.score(docs, lm.train(docs)).collect()}
    assert all(abs(r["logprob"] - again[r["n_words"]]) < 1e-5 for r in got)
