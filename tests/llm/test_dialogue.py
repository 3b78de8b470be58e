"""Conversation repair against a plain search over edit strings."""

from __future__ import annotations

import collections
import hashlib
import random
import zlib

from tideledger.llm import dialogue

SCHEMA = "conv_id long, turn long, role string, text string, copies string, place int, fault string, matrix string, kind int, said string"
WHITE = " \t\n\x0b\x0c\r"
LEGAL = {"su", "ua", "au"}


def broken(rows):
    """The damaged rows of each conversation, in order."""
    kept = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = (" " if v is None else v for v in (role, text))
        kept[conv]
        name = ":".join(" " if v is None else str(v) for v in (conv, turn))
        kind = zlib.crc32(name.encode()) % 20
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        kept[conv] += [(turn, role, text)] * (2 if kind == 3 else 1)
    for conv in kept:
        kept[conv].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    return kept


def legal_word(word):
    body = word[1:] if word[:1] == "s" else word
    return not word or (body and body == "ua" * (len(body) // 2))


def cheapest(rows, faults):
    """(cost, audit, repaired rows) by Dijkstra-like search over (rows used, word's last letter) with whole strings as keys."""
    best = {(0, ""): (0, "", ())}  # (row, last initial or "") -> least (cost, audit, out)
    n = len(rows)
    order = {"": ("s", "u"), "s": ("u",), "u": ("a",), "a": ("u",)}
    final = []
    for i in range(n + 1):
        # inserts first: at most two are ever of use at one place
        for _ in range(3):
            for (at, last), (cost, audit, out) in list(best.items()):
                if at == i:
                    for c in order[last]:
                        if c != "s":
                            role = {"u": "user", "a": "assistant"}[c]
                            new = (cost + 2, audit + "I", out + ((role, ""),))
                            if (i, c) not in best or new[:2] < best[i, c][:2]:
                                best[i, c] = new
        if i == n:
            break
        (_, role, text), fault = rows[i], faults[i]
        for (at, last), (cost, audit, out) in list(best.items()):
            if at != i:
                continue
            moves = [(3, "D", last, ())]
            if fault not in ("blank", "duplicate"):
                late = fault == "truncated"
                for c in order[last]:
                    if role[:1] == c:
                        moves.append((late, "K", c, ((role, text),)))
                    if c != "s":
                        moves.append((2 + late, "R", c, (({"u": "user", "a": "assistant"}[c], text),)))
            for more, edit, to, row in moves:
                new = (cost + more, audit + edit, out + row)
                if (i + 1, to) not in best or new[:2] < best[i + 1, to][:2]:
                    best[i + 1, to] = new
    final = [v for (at, last), v in best.items() if at == n and last in ("", "a")]
    return min(final, key=lambda v: v[:2])


def expected(rows):
    out = {}
    for conv, kept in broken(rows).items():
        faults, seen = [], set()
        for _, role, text in kept:
            spoken = text.rstrip(WHITE)
            faults.append("blank" if not spoken else "duplicate" if (role, text) in seen else "truncated" if spoken[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [t for t, _, _ in kept if t is not None]
        cost, audit, made = cheapest(kept, faults)
        assert legal_word("".join(r[:1] for r, _ in made))
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
                     sum(a[1][:1] + b[1][:1] not in LEGAL for a, b in zip(kept, kept[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in made).encode()).hexdigest())
    return out


def as_rows(rows):
    return [(*r, "c", 1, "f", "m", 2, "s") for r in rows]


def answers(df):
    return {r["conv_id"]: (r["gaps"], r["blank"], r["duplicate"], r["truncated"], r["illegal"], r["cost"], r["audit"], r["repaired_sha256"]) for r in df.collect()}


def made_up():
    rnd = random.Random(5)
    roles = ["user", "assistant", "user", "assistant", "system", "user", "assistant", "tool", "", None, "ugly"]
    texts = ["Yes.", "No!", "Why?", "open end", " ", "", None, "Yes. ", "ünï 😀.", "x" * 3000 + ".", "half\nline", "Yes.\x0b"]
    rows = []
    for conv in range(300):
        for turn in range(rnd.randrange(1, 9)):
            role = ["user", "assistant"][turn % 2] if rnd.random() < 0.6 else rnd.choice(roles)
            rows.append((conv, None if rnd.random() < 0.03 else turn, role, rnd.choice(texts) if rnd.random() < 0.7 else f"Said {rnd.random()}."))
    rows += [rows[7], rows[7], (None, 1, "user", "Hi."), (None, None, None, None), (None, 2, "assistant", "Ho."), (900, None, "user", "a."), (900, None, "assistant", "a.")]
    rows += [(901, 0, "user", "Same.")] * 500
    rows += [(902, t, rnd.choice(["user", "assistant", "system"]), rnd.choice(["Go.", "stop", f"t{t}."])) for t in range(2500)]
    rows += [(903, t, "user", f"t{t}.") for t in range(1200)] + [(904, t * 3, "system", f"t{t}") for t in range(40)]
    rows += [(c, 0, "user", "only.") for c in range(1000, 1080)]
    return rows


def test_repair_equals_search(spark):
    rows = made_up()
    want = expected(rows)
    got = dialogue.audit(spark.createDataFrame(as_rows(rows), SCHEMA))
    assert dict(got.dtypes) == {**dict.fromkeys(("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost"), "bigint"), "audit": "string", "repaired_sha256": "string"}
    assert answers(got) == want and got.count() == len(want)
    assert any(w[6] == "" for w in want.values()) and {c for w in want.values() for c in w[6]} == set("DIKR")


def test_small_chunks_give_the_same(spark, monkeypatch):
    rows = made_up()
    monkeypatch.setattr(dialogue, "CHUNK_ROWS", 3)
    table = spark.createDataFrame(as_rows(rows), SCHEMA).repartition(7)
    assert answers(dialogue.audit(table)) == expected(rows)


def test_repaired_rows_are_legal(spark):
    rows = [r for r in made_up() if r[0] is not None and r[0] < 60]
    made = collections.defaultdict(list)
    planned = dialogue.plan(dialogue.damage(spark.createDataFrame(as_rows(rows), SCHEMA)))
    for r in sorted(dialogue.repaired(planned).collect(), key=lambda r: (r["conv_id"], r["place"], r["step"])):
        made[r["conv_id"]].append((r["role"], r["text"]))
    want = expected(rows)
    for conv, found in made.items():
        assert hashlib.sha256("\n".join(f"{r}:{t}" for r, t in found).encode()).hexdigest() == want[conv][-1]
    untouched = dialogue.report(dialogue.plan(dialogue.counted(spark.createDataFrame([(1, 0, "user", "A."), (1, 1, "assistant", "B.")], "conv_id long, turn long, role string, text string"))))
    assert [(r["audit"], r["cost"]) for r in untouched.collect()] == [("KK", 0)]


def test_empty_table(spark):
    assert dialogue.audit(spark.createDataFrame([], SCHEMA)).count() == 0
