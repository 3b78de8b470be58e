"""Language-model scores: masked pseudo-likelihood of a bidirectional window network.

Every word is predicted from the words on both sides of it. Words fall into
``VOCABULARY`` hash slots; the embeddings of the window's words, each at its own position,
go through one tanh layer to a two-level softmax (group, then member). A text's
score is the sum of the log-probabilities of its words.

Training is data-parallel numpy. The words of all texts are stored as slots once, and their counts over all
documents give the biases of the first weights. Then come ``ROUNDS`` rounds: every partition trains a copy of the weights on its own
documents, and the copies are averaged by the words they saw; blocks of the weights are the groups,
averaged in two levels. Round r has every ``ROUNDS``-th position from r on as targets (all words are
context), so over the rounds every position of every text is predicted once, and each round starts from what all partitions
learned in the one before. The slots, and with them the weights, are fixed in number: they do not grow with the corpus.
"""

from __future__ import annotations

import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from . import shipped
from .common import stored

shipped(__name__)

VOCABULARY, GROUP = 4096, 64
WINDOW, EMBED, HIDDEN = 2, 8, 16
ROUNDS = 4
BATCH = 2048
RATE = 0.2
LEAP, BOUND = 0.5, 3.5  # most a weight moves in a step; most it can be: 16 inputs of at most 1 stay below exp(60)
REMEMBERED = 500_000
SHAPES = {"embed": (VOCABULARY + 1, EMBED), "mix": (2 * WINDOW * EMBED, HIDDEN), "bias": (1, HIDDEN),
          "group": (HIDDEN, VOCABULARY // GROUP), "group_bias": (1, VOCABULARY // GROUP),
          "member": (VOCABULARY // GROUP, HIDDEN * GROUP), "member_bias": (VOCABULARY // GROUP, GROUP)}
SIZES = {name: a * b for name, (a, b) in SHAPES.items()}
SIZE = sum(SIZES.values())
BLOCK = 4096         # weights per averaged block
FAN = 64             # partitions averaged in one group of the first level
OUT = "doc_id long, n_words long, logprob double, mean_logprob double"


def fresh() -> np.ndarray:
    rng = np.random.default_rng(7)
    parts = [rng.normal(0, 0.3, s) if n in ("embed", "mix") else np.zeros(s) for n, s in SHAPES.items()]
    return np.concatenate([p.ravel() for p in parts]).astype(np.float32)


def views(flat: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, (a, b) in SHAPES.items():
        out[name] = flat[at:at + a * b].reshape(a, b)
        at += a * b
    return out


class Slots(dict):
    """Hash slots of the words between white space, in lower case; a bounded memory of words already seen."""

    def __missing__(self, word: str) -> int:
        slot = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass")) % VOCABULARY
        return slot

    def __call__(self, text: str | None) -> np.ndarray:
        words = (text or "").lower().split()
        out = np.fromiter(map(self.__getitem__, words), np.int32, len(words))
        if len(self) > REMEMBERED:
            self.clear()
        return out


def windows(slots: np.ndarray) -> np.ndarray:
    """The slots around each position; places beyond the text have a slot of their own."""
    return _around(_padded(slots), np.arange(len(slots)))


AROUND = np.array([WINDOW + o for o in range(-WINDOW, WINDOW + 1) if o])


def _padded(slots: np.ndarray) -> np.ndarray:
    padded = np.full(len(slots) + 2 * WINDOW, VOCABULARY, np.int32)
    padded[WINDOW:len(slots) + WINDOW] = slots
    return padded


def _around(padded: np.ndarray, at: np.ndarray) -> np.ndarray:
    return padded[at[:, None] + AROUND]


def _hidden(w: dict, context: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = w["embed"].take(context.ravel(), axis=0).reshape(len(context), -1)
    made = x @ w["mix"]
    made += w["bias"]
    return x, np.tanh(made, out=made)


def _groups(target: np.ndarray):
    """Order of the targets by group, and (group, start, end in that order) of each group present."""
    order = np.argsort(target.astype(np.int16), kind="stable")  # two bytes are sorted by radix
    ends = np.cumsum(np.bincount(target // GROUP, minlength=VOCABULARY // GROUP)).tolist()
    return order, [(g, a, b) for g, (a, b) in enumerate(zip([0, *ends], ends)) if a < b]


def _members(w: dict) -> np.ndarray:
    """Weights and, as a last row, biases inside each group."""
    return np.concatenate([w["member"].reshape(-1, HIDDEN, GROUP), w["member_bias"][:, None]], axis=1)


def _with_one(h: np.ndarray) -> np.ndarray:
    """``h`` and a column of ones, by which biases are weights like others."""
    out = np.empty((len(h), HIDDEN + 1), np.float32)
    out[:, :HIDDEN], out[:, HIDDEN] = h, 1
    return out


def _member_logits(members: np.ndarray, h: np.ndarray, groups: list) -> np.ndarray:
    """Logits inside the group of each row; the rows lie by group, so each group is one product."""
    out = np.empty((len(h), GROUP), np.float32)
    for g, a, b in groups:
        np.dot(h[a:b], members[g], out=out[a:b])
    return out


ONES = np.ones((GROUP, 1), np.float32)
PLACES = np.arange(SIZES["embed"]).reshape(SHAPES["embed"])  # of each slot's numbers in the embeddings


def _picked(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log-softmax of one column per row; weights are bounded, so no exponential overflows."""
    chosen = logits[np.arange(len(at)), at]
    return chosen - np.log((np.exp(logits, out=logits) @ ONES)[:, 0])


def log_probabilities(w: dict, context: np.ndarray, target: np.ndarray) -> np.ndarray:
    order, groups = _groups(target)
    target = target[order]
    _, h = _hidden(w, context.take(order, axis=0))
    logits = h @ w["group"]
    logits += w["group_bias"]
    made = _picked(logits, target // GROUP).astype(float)
    made += _picked(_member_logits(_members(w), _with_one(h), groups), target % GROUP)
    out = np.empty_like(made)
    out[order] = made
    return out


def _softmax_error(logits: np.ndarray, at: np.ndarray) -> np.ndarray:
    np.exp(logits, out=logits)
    logits *= 1 / (logits @ ONES)
    logits[np.arange(len(at)), at] -= 1
    return logits


def _move(weights: np.ndarray, step: np.ndarray) -> None:
    """``step`` is spent."""
    np.minimum(step, LEAP, out=step)
    np.maximum(step, -LEAP, out=step)
    weights -= step
    np.minimum(weights, BOUND, out=weights)
    np.maximum(weights, -BOUND, out=weights)


def train_batch(w: dict, context: np.ndarray, target: np.ndarray, rate: float = RATE) -> None:
    """One step of gradient descent on a batch, in place."""
    order, groups = _groups(target)
    context, target = context.take(order, axis=0), target[order]
    n, (x, h) = len(target), _hidden(w, context)
    scale = float(rate / np.sqrt(n))  # between mean and sum: rare slots move too; a plain float keeps the steps in single precision
    outer = h @ w["group"]
    outer += w["group_bias"]
    outer = _softmax_error(outer, target // GROUP)
    members, one = _members(w), _with_one(h)
    inner = _softmax_error(_member_logits(members, one, groups), target % GROUP)
    back = outer @ w["group"].T
    steps, inside = np.empty((len(groups), HIDDEN + 1, GROUP), np.float32), np.empty((n, HIDDEN), np.float32)
    for (g, a, b), step in zip(groups, steps):
        part = inner[a:b]
        np.dot(part, members[g, :HIDDEN].T, out=inside[a:b])
        np.dot(one[a:b].T, part, out=step)
    back += inside
    present = [g for g, _, _ in groups]
    steps *= scale
    moved = members[present]
    _move(moved, steps)
    w["member"][present] = moved[:, :HIDDEN].reshape(len(present), -1)
    w["member_bias"][present] = moved[:, HIDDEN]
    back *= 1 - h * h
    into = back @ w["mix"].T
    step = one.T @ outer
    step *= scale
    _move(w["group"], step[:HIDDEN])
    _move(w["group_bias"], step[HIDDEN:])
    _move(w["mix"], scale * (x.T @ back))
    _move(w["bias"], scale * back.sum(axis=0)[None])
    at = PLACES.take(context.ravel(), axis=0).ravel()
    step = np.bincount(at, into.ravel(), SIZES["embed"]).astype(np.float32).reshape(-1, EMBED)
    step *= scale
    _move(w["embed"], step)


class Trainer:
    """Feeds targets to :func:`train_batch` in full batches."""

    def __init__(self, flat: np.ndarray):
        self.flat = flat.copy()
        self.w, self.waiting, self.held, self.seen = views(self.flat), [], 0, 0

    def add(self, slots: np.ndarray, first: int = 0, step: int = 1) -> None:
        """Every ``step``-th position of a text from ``first`` on becomes a target."""
        at = np.arange(first, len(slots), step)
        if not len(at):
            return
        self.waiting.append((_around(_padded(slots), at), slots[at]))
        self.held += len(at)
        self.seen += len(at)
        if self.held >= BATCH:
            self.flush()

    def flush(self) -> None:
        if self.held:
            context, target = (np.concatenate([p[i] for p in self.waiting]) for i in (0, 1))
            for i in range(0, len(target), BATCH):
                train_batch(self.w, context[i:i + BATCH], target[i:i + BATCH])
            self.waiting, self.held = [], 0


def slot_table(docs: DataFrame) -> DataFrame:
    """The slots of each text that has words, stored."""
    return _slot_table(docs.select(F.lit(0).cast("long").alias("doc_id"), "text")).where(F.size("slots") > 0).select("slots")


def _slot_table(docs: DataFrame) -> DataFrame:
    """doc_id and slots of every row, stored."""
    def run(batches):
        slots = Slots()
        for batch in batches:
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "slots": [slots(t) for t in batch["text"]]})

    return stored(docs.select("doc_id", "text").mapInPandas(run, "doc_id long, slots array<int>"), "lm-slots")


def first_weights(table: DataFrame) -> np.ndarray:
    """Weights whose biases are the word frequencies of all documents."""
    flat, counts = fresh(), np.full(VOCABULARY, 0.5)
    for r in table.select(F.explode("slots").alias("slot")).groupBy("slot").agg(F.count("*").alias("n")).collect():  # at most VOCABULARY rows
        counts[r["slot"]] += r["n"]
    counts, w = counts.reshape(-1, GROUP), views(flat)
    w["group_bias"][0] = np.clip(np.log(counts.sum(axis=1) / counts.sum(axis=1).mean()), -BOUND, BOUND)
    w["member_bias"][:] = np.clip(np.log(counts / counts.mean(axis=1, keepdims=True)), -BOUND, BOUND)
    return flat


def train(docs: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    """Weights trained over every position of the whole corpus."""
    return _trained(slot_table(docs), rounds)


def _trained(table: DataFrame, rounds: int = ROUNDS) -> np.ndarray:
    flat = first_weights(table)
    for at in range(rounds):
        flat = _averaged(table, flat, at, rounds)
    return flat


def _averaged(table: DataFrame, start: np.ndarray, first: int, step: int) -> np.ndarray:
    """One round: the mean of the partitions' copies of ``start``, trained on every ``step``-th position from ``first`` on."""
    def run(batches):
        from pyspark import TaskContext

        trainer = Trainer(start)
        for batch in batches:
            for slots in batch["slots"]:
                trainer.add(np.asarray(slots, np.int32), first, step)
        trainer.flush()
        if trainer.seen:
            parts = [trainer.flat[i:i + BLOCK] for i in range(0, SIZE, BLOCK)]
            yield pd.DataFrame({"block": range(len(parts)), "part": TaskContext.get().partitionId(), "seen": float(trainer.seen),
                                "weights": [p.tolist() for p in parts]})

    def average(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("part")  # a fixed order, so that a repeated task gives the same sums
        seen = group["seen"].to_numpy()
        total = sum(s * np.asarray(w, float) for s, w in zip(seen, group["weights"]))
        return pd.DataFrame({"block": group["block"].iloc[:1], "part": group["part"].iloc[:1] // FAN, "seen": seen.sum(),
                             "weights": [(total / seen.sum()).tolist()]})

    schema = "block int, part int, seen double, weights array<double>"
    copies = table.mapInPandas(run, schema)
    some = copies.groupBy("block", F.floor(F.col("part") / FAN)).applyInPandas(average, schema)
    blocks = stored(some.groupBy("block").applyInPandas(average, schema), "lm-weights")
    rows = blocks.orderBy("block").collect()  # SIZE weights, whatever the corpus
    return np.concatenate([np.array(r["weights"], np.float32) for r in rows]) if rows else start


def score(docs: DataFrame, flat: np.ndarray) -> DataFrame:
    """doc_id, n_words, logprob (sum) and mean_logprob of each row; a text without words has 0 words, sum 0 and a null mean."""
    return _scored(docs.select("doc_id", "text"), flat)


def _scored(rows: DataFrame, flat: np.ndarray) -> DataFrame:
    """Scores of rows of doc_id and either text or slots."""
    def run(batches):
        slots, w = Slots(), views(flat)
        for batch in batches:
            made = [slots(t) for t in batch["text"]] if "text" in batch else [np.asarray(s, np.int32) for s in batch["slots"]]
            sums = np.zeros(len(made))
            owner = np.repeat(np.arange(len(made)), [len(m) for m in made])
            target = np.concatenate(made) if made else np.zeros(0, np.int32)
            context = np.concatenate([windows(m) for m in made]) if made else np.zeros((0, 2 * WINDOW), np.int32)
            for i in range(0, len(target), 4 * BATCH):
                part = slice(i, i + 4 * BATCH)
                np.add.at(sums, owner[part], log_probabilities(w, context[part], target[part]))
            n = np.array([len(m) for m in made], np.int64)
            yield pd.DataFrame({"doc_id": batch["doc_id"].astype("Int64"), "n_words": n, "logprob": sums,
                                "mean_logprob": [s / k if k else None for s, k in zip(sums, n)]})

    return rows.mapInPandas(run, OUT)


def score_corpus(docs: DataFrame) -> DataFrame:
    """Scores of all documents under a model of the same corpus.

    Null and empty texts have no words; repeated and null doc_ids are rows like
    others; an empty table gives no rows; other columns are ignored.
    """
    table = _slot_table(docs)  # the same words are trained on and scored
    return _scored(table, _trained(table.where(F.size("slots") > 0).select("slots")))
