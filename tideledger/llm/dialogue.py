"""Conversation structure repair: a run-length dynamic program over a four-state automaton.

A conversation's role initials should read ``(s?(ua)+)?``. Its rows become symbols (initial and
fault); equal consecutive symbols are one run. The cheapest way through a run is a power of
the symbol's min-plus transition matrix over the states *start*, *after s*, *after u* and *after a*,
taken from cached binary powers; the choices are then unrolled, the least letter first, for the audit.

Rows are dealt by range of (conversation, turn, role, text), so a conversation of any length is
spread over many tasks. Each task turns its rows into chunks of bounded size with one matrix each.
A first stream, backwards over the chunks' matrices (16 numbers a chunk), gives the cost of
what follows each chunk; a second one, forwards, unrolls the choices and writes the results. Both
hold one chunk and one state at a time. The second stream of one conversation stays in one task because the
contract's SHA-256 runs over the whole repaired conversation in order.
"""

from __future__ import annotations

import functools
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from . import shipped
from .common import stored

shipped(__name__)

WHITE = " \t\n\x0b\x0c\r"
CHUNK_ROWS, CHUNK_CHARACTERS = 256, 1 << 18  # a chunk ends with the row that reaches either
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1  # costs
NEVER = 1 << 60
START, S, U, A = range(4)
MUST_GO = 8  # the symbol of blank and duplicate rows; the others are 2 * initial + truncated
INITIALS = {"s": 0, "u": 1, "a": 2}
LEGAL = {"su", "ua", "au"}
NEXT = {START: U, S: U, U: A, A: U}  # where an inserted or reroled row leads
ROLE = {U: "user", A: "assistant"}


# ---- the automaton ---------------------------------------------------------------------------

def _times(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return np.minimum((x[:, :, None] + y[None]).min(axis=1), NEVER)


def _inserts() -> np.ndarray:
    """Costs of going from state to state by inserted rows alone."""
    cost = np.full((4, 4), NEVER, np.int64)
    for state in range(4):
        cost[state, state] = 0
        one = NEXT[state]
        cost[state, one] = INSERT
        cost[state, NEXT[one]] = min(cost[state, NEXT[one]], 2 * INSERT)
    return cost


def _kept(initial: int, state: int) -> int | None:
    """The state a row of this initial leads to, None where it may not stand."""
    if initial == 0:
        return S if state == START else None
    return (initial + 1) if initial in (1, 2) and NEXT[state] == initial + 1 else None


@functools.cache
def _transition(symbol: int) -> np.ndarray:
    row = np.full((4, 4), NEVER, np.int64)
    for state in range(4):
        row[state, state] = DELETE
        if symbol != MUST_GO:
            initial, late = divmod(symbol, 2)
            to = NEXT[state]
            row[state, to] = min(row[state, to], REROLE + late * TRUNCATED)
            stays = _kept(initial, state)
            if stays is not None:
                row[state, stays] = min(row[state, stays], KEEP + late * TRUNCATED)
    return _times(_inserts(), row)


@functools.cache
def _power(symbol: int, exponent: int) -> np.ndarray:
    """The transition of 2^exponent equal rows."""
    if exponent == 0:
        return _transition(symbol)
    half = _power(symbol, exponent - 1)
    return _times(half, half)


END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)  # cost of ending in each state


def _before(runs, after: np.ndarray) -> list[np.ndarray]:
    """Cost to finish from each state: before each run, and after the last one."""
    values = [after]
    for symbol, length in reversed(runs):
        value, k = values[-1], 0
        while length:
            if length & 1:
                value = np.minimum((_power(symbol, k) + value[None]).min(axis=1), NEVER)
            length >>= 1
            k += 1
        values.append(value)
    return values[::-1]


@functools.lru_cache(maxsize=1 << 16)
def _matrix(runs: tuple) -> np.ndarray:
    """Min-plus transition of a chunk, column by column: the cost to each end state."""
    columns = []
    for end in range(4):
        after = np.full(4, NEVER, np.int64)
        after[end] = 0
        columns.append(_before(runs, after)[0])
    return np.stack(columns, axis=1)


@functools.lru_cache(maxsize=1 << 16)
def _unroll(runs: tuple, after: tuple, state: int) -> tuple[str, int]:
    """The least string of cheapest edits through ``runs`` from ``state``, and the state it ends in."""
    values = _before(runs, np.array(after, np.int64))
    made: list[str] = []
    for (symbol, length), follow in zip(runs, values[1:]):
        if symbol == MUST_GO:  # deletion keeps the state and is the least letter
            made.append("D" * length)
            continue
        initial, late = divmod(symbol, 2)
        inside = [follow]
        for _ in range(length - 1):
            inside.append((_transition(symbol) + inside[-1][None]).min(axis=1))
        for later in reversed(inside):
            here = int((_transition(symbol)[state] + later).min())
            while True:
                to, stays = NEXT[state], _kept(initial, state)
                if here == DELETE + later[state]:
                    made.append("D")
                elif here == INSERT + int((_transition(symbol)[to] + later).min()):
                    made.append("I")
                    state, here = to, here - INSERT
                    continue
                elif stays is not None and here == KEEP + late * TRUNCATED + later[stays]:
                    made.append("K")
                    state = stays
                else:
                    made.append("R")
                    state = to
                break
    return "".join(made), state


# ---- rows ------------------------------------------------------------------------------------

def _filled(conversations: DataFrame) -> DataFrame:
    space = F.lit(" ")
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role"), space).alias("role"), F.coalesce(F.col("text"), space).alias("text"))


def damage(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and copies of the rows that are left after known damage.

    The CRC of ``conv_id:turn`` (a null is one space) modulo 20 decides: 0 drops a row, 1 empties its text, 2 removes
    its full stops, exclamation and question marks, 3 doubles it, 4 makes its role ``user``.
    """
    def named(column: str) -> Column:
        return F.coalesce(F.col(column).cast("string"), F.lit(" "))

    kind = F.pmod(F.crc32(F.concat_ws(":", named("conv_id"), named("turn")).cast("binary")), F.lit(20))
    return _filled(conversations).withColumn("kind", kind).where("kind != 0").select(
        "conv_id", "turn", F.when(F.col("kind") == 4, F.lit("user")).otherwise(F.col("role")).alias("role"),
        F.when(F.col("kind") == 1, F.lit("")).when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(F.col("kind") == 3, F.lit(2)).otherwise(F.lit(1)).cast("long").alias("copies"))


def _symbols(rows: DataFrame) -> DataFrame:
    """Distinct rows with their number of copies, ``first`` (the role and text were not seen before) and ``fault``."""
    merged = rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumn("said", F.md5(F.col("text").cast("binary")))
    # Role and text that occur at several turns of a conversation: where they stand first.
    again = (
        merged.groupBy(F.col("conv_id").alias("in_conv"), F.col("role").alias("in_role"), F.col("said").alias("in_said"))
        .agg(F.count("*").alias("turns"), F.bool_or(F.col("turn").isNull()).alias("unplaced"), F.min("turn").alias("least"))
        .where("turns > 1")
    )
    met = F.col("conv_id").eqNullSafe(F.col("in_conv")) & (F.col("role") == F.col("in_role")) & (F.col("said") == F.col("in_said"))
    later = F.col("turns").isNotNull() & F.when(F.col("unplaced"), F.col("turn").isNotNull()).otherwise(F.col("turn") > F.col("least"))
    spoken = F.rtrim(F.col("text"), F.lit(WHITE))
    fault = (F.when(spoken == "", F.lit("blank")).when(F.coalesce(later, F.lit(False)), F.lit("duplicate"))
             .when(~F.right(spoken, F.lit(1)).isin(".", "!", "?"), F.lit("truncated")).otherwise(F.lit("")))
    return merged.join(again, met, "left").select("conv_id", "turn", "role", "text", "copies", fault.alias("fault"))


CHUNK = pa.schema([
    ("conv_id", pa.int64()), ("place", pa.int64()), ("turn", pa.list_(pa.int64())), ("role", pa.list_(pa.string())), ("text", pa.list_(pa.string())),
    ("copies", pa.list_(pa.int64())), ("fault", pa.list_(pa.string())), ("matrix", pa.list_(pa.int64()))])
CHUNK_DDL = ("conv_id long, place long, turn array<long>, role array<string>, text array<string>, copies array<long>, "
             "fault array<string>, matrix array<long>")


def _runs(roles, copies, faults) -> tuple:
    runs: list[list[int]] = []
    for role, n, fault in zip(roles, copies, faults):
        gone = fault in ("blank", "duplicate")
        parts = [(MUST_GO, n)] if gone else [(2 * INITIALS.get(role[:1], 3) + (fault == "truncated"), 1), (MUST_GO, n - 1)]
        for symbol, length in parts:
            if length and runs and runs[-1][0] == symbol:
                runs[-1][1] += length
            elif length:
                runs.append([symbol, length])
    return tuple(map(tuple, runs))


def _chunks(batches):
    """Sorted rows to chunks of one conversation each; ``place`` orders them."""
    from pyspark import TaskContext

    part, count = TaskContext.get().partitionId(), 0
    held: list[tuple] = []
    size, conv = 0, None

    def chunk():
        nonlocal count, held, size
        turns, roles, texts, copies, faults = map(list, zip(*held))
        count += 1
        made = {"conv_id": conv, "place": (part << 40) + count, "turn": turns, "role": roles, "text": texts, "copies": copies,
                "fault": faults, "matrix": _matrix(_runs(roles, copies, faults)).ravel().tolist()}
        held, size = [], 0
        return made

    for batch in batches:
        out = []
        for cid, turn, role, text, copies, fault in zip(*(batch.column(i).to_pylist() for i in range(6))):
            if held and (cid != conv or len(held) >= CHUNK_ROWS or size >= CHUNK_CHARACTERS):
                out.append(chunk())
            conv = cid
            held.append((turn, role, text, copies, fault))
            size += len(text)
        if out:
            yield pa.RecordBatch.from_pylist(out, CHUNK)
    if held:
        yield pa.RecordBatch.from_pylist([chunk()], CHUNK)


AFTER = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("after", pa.list_(pa.int64()))])


def _backwards(batches):
    """The cost to finish after each chunk; chunks come last one first."""
    conv, value, begun = None, END, False
    for batch in batches:
        out = []
        for cid, place, matrix in zip(*(batch.column(i).to_pylist() for i in range(3))):
            if not begun or cid != conv:
                conv, value, begun = cid, END, True
            out.append({"conv_id": cid, "place": place, "after": value.tolist()})
            value = np.minimum((np.array(matrix, np.int64).reshape(4, 4) + value[None]).min(axis=1), NEVER)
        yield pa.RecordBatch.from_pylist(out, AFTER)


def _edits(batches):
    """(conv_id, place, rows, audit, state before) of each chunk in order; (conv_id, None, ...) at a conversation's end."""
    conv, state, after, begun = None, START, None, False
    for batch in batches:
        for row in batch.to_pylist():
            if begun and row["conv_id"] != conv:
                yield conv, None, None, "I" * {U: 1, S: 2}.get(state, 0), state
                state = START
            conv, begun = row["conv_id"], True
            if row["after"] is not None:
                after = tuple(row["after"])
                continue
            audit, end = _unroll(_runs(row["role"], row["copies"], row["fault"]), after, state)
            yield conv, row["place"], row, audit, state
            state = end
        yield None
    if begun:
        yield conv, None, None, "I" * {U: 1, S: 2}.get(state, 0), state


def _lines(row, audit: str, state: int):
    """(edit, role, text or None) of every edit of a chunk, deleted rows included."""
    each = ((role, text) for role, text, n in zip(row["role"], row["text"], row["copies"]) for _ in range(n)) if row else iter(())
    for edit in audit:
        if edit == "I":
            state = NEXT[state]
            yield edit, ROLE[state], ""
            continue
        role, text = next(each)
        if edit == "R":
            state = NEXT[state]
            role = ROLE[state]
        elif edit == "K":
            state = _kept(INITIALS[role[:1]], state)
        yield edit, role, text


REPAIRED = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("step", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
OUT_ROWS = 4096


def _repaired(batches):
    out, place = [], 0
    for found in _edits(batches):
        if found is None:
            continue
        conv, at, row, audit, state = found
        place = place if at is None else at
        for step, (edit, role, text) in enumerate(_lines(row, audit, state), (1 << 40) if at is None else 0):
            if edit != "D":
                out.append({"conv_id": conv, "place": place, "step": step, "edit": edit, "role": role, "text": text})
            if len(out) >= OUT_ROWS:
                yield pa.RecordBatch.from_pylist(out, REPAIRED)
                out = []
    yield pa.RecordBatch.from_pylist(out, REPAIRED)


REPORT = pa.schema([(name, pa.int64()) for name in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [
    ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _report(batches):
    """One row a conversation, built while its chunks pass."""
    def fresh():
        return {"low": None, "high": None, "turns": 0, "last_turn": None, "initial": None, "audit": [], "hash": hashlib.sha256(), "any": False,
                "n": dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "cost"), 0)}

    seen, out = fresh(), []
    for found in _edits(batches):
        if found is None:
            if out:
                yield pa.RecordBatch.from_pylist(out, REPORT)
                out = []
            continue
        conv, place, row, audit, state = found
        n = seen["n"]
        for edit, role, text in _lines(row, audit, state):
            if edit != "D":
                seen["hash"].update((("\n" if seen["any"] else "") + f"{role}:{text}").encode("utf-8", "surrogatepass"))
                seen["any"] = True
        n["cost"] += DELETE * audit.count("D") + REROLE * audit.count("R") + INSERT * audit.count("I")
        seen["audit"].append(audit)
        if place is not None:
            spots = iter(audit.replace("I", ""))
            for turn, role, copies, fault in zip(row["turn"], row["role"], row["copies"], row["fault"]):
                if turn is not None and turn != seen["last_turn"]:
                    seen["low"] = turn if seen["low"] is None else seen["low"]
                    seen["high"] = seen["last_turn"] = turn
                    seen["turns"] += 1
                own = [next(spots) for _ in range(copies)]
                if fault in ("blank", "duplicate"):
                    n[fault] += copies
                else:
                    n["duplicate"] += copies - 1
                    n["truncated"] += fault == "truncated"
                    n["cost"] += TRUNCATED * (fault == "truncated" and own[0] != "D")
                initial = role[:1]
                n["illegal"] += (seen["initial"] is not None and seen["initial"] + initial not in LEGAL) + copies - 1
                seen["initial"] = initial
        else:
            gaps = 0 if seen["low"] is None else seen["high"] - seen["low"] + 1 - seen["turns"]
            out.append({"conv_id": conv, "gaps": gaps, **n, "audit": "".join(seen["audit"]), "repaired_sha256": seen["hash"].hexdigest()})
            seen = fresh()
    yield pa.RecordBatch.from_pylist(out, REPORT)


# ---- the operator ----------------------------------------------------------------------------

def plan(rows: DataFrame) -> DataFrame:
    """Chunks in order with the cost of what follows each: input of :func:`repaired` and :func:`report`, kept in the shared folder."""
    ordered = _symbols(rows).repartitionByRange(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
    ordered = ordered.sortWithinPartitions(F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text")
    chunks = stored(ordered.mapInArrow(_chunks, CHUNK_DDL), "dialogue-chunks")
    backwards = chunks.select("conv_id", "place", "matrix").repartition("conv_id").sortWithinPartitions("conv_id", F.col("place").desc())
    after = backwards.mapInArrow(_backwards, "conv_id long, place long, after array<long>")
    both = chunks.drop("matrix").unionByName(after, allowMissingColumns=True)  # a chunk's costs stand right before it
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "place", F.col("after").isNull())


def counted(conversations: DataFrame) -> DataFrame:
    """Rows as they are, one copy each: the input of :func:`plan` where nothing is damaged on purpose."""
    return _filled(conversations).withColumn("copies", F.lit(1).cast("long"))


def repaired(planned: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place and step (their order), edit (K, R or I), role and text."""
    return planned.mapInArrow(_repaired, "conv_id long, place long, step long, edit string, role string, text string")


def report(planned: DataFrame) -> DataFrame:
    """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit and repaired_sha256 of each conversation that has rows."""
    return planned.mapInArrow(_report, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def audit(conversations: DataFrame) -> DataFrame:
    """The report of every conversation after known damage, those without a row left included.

    Rows stand by turn (nulls first), then role, then text: the order of repeated turns. A null conv_id is a conversation of its
    own; a null role or text is one space. A role whose initial is not s, u or a, an empty one
    included, can only be changed or deleted. Other columns are ignored; no rows give no conversations.
    """
    found = report(plan(damage(conversations))).withColumnRenamed("conv_id", "of_conv")
    every = conversations.select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    zero, nothing = F.lit(0).cast("long"), F.lit(hashlib.sha256(b"").hexdigest())
    return every.join(found, F.col("conv_id").eqNullSafe(F.col("of_conv")), "left").select(
        "conv_id", *(F.coalesce(c, zero).alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")),
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", nothing).alias("repaired_sha256"))
