"""Repairs against an enumeration of all edit strings, and the streaming against the program run whole."""

import hashlib
import random
import re
import zlib

import pandas as pd

from grainmart.llm import conversation_repair as C

SCHEMA = "conv_id long, turn long, role string, text string, row int, tie string, kind string, fault string"


def frame(spark, rows):
    """Conversations with further columns whose names clash with the operator's own."""
    return spark.createDataFrame([(*r, 1, "x", "y", "z") for r in rows], SCHEMA)


def digest(role, text):
    return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]


def kinds(rows):
    """(role, text, kind) in order of (turn, role, text) rows."""
    rows = [(t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, digest(r[1], r[2])))
    out, seen = [], set()
    for _, role, text in rows:
        cut = text.strip(" \t\n\x0b\x0c\r")
        kind = "blank" if not cut else "duplicate" if (role, text) in seen else "truncated" if cut[-1] not in ".!?" else None
        seen.add((role, text))
        out.append((role, text, kind))
    return out


def cheapest(rows):
    """(cost, audit, repaired) over all edit strings with at most two insertions before a row and at the end."""
    best = []

    def go(i, cost, audit, roles, made):
        if cost > (best[0][0] if best else 4 * len(rows)) or not re.fullmatch("(s?(ua)*u?)?", roles):
            return
        if i == len(rows) and re.fullmatch("(s?(ua)+)?", roles):
            if not best or (cost, audit) < best[0][:2]:
                best[:] = [(cost, audit, made)]
        trail = len(audit) - len(audit.rstrip("I"))
        if trail < 2:
            for role in ("user", "assistant"):
                go(i, cost + 3, audit + "I", roles + role[0], [*made, f"{role}:"])
        if i == len(rows):
            return
        role, text, kind = rows[i]
        go(i + 1, cost + 4, audit + "D", roles, made)
        if kind in ("blank", "duplicate"):
            return
        extra = 3 if kind == "truncated" else 0
        go(i + 1, cost + extra, audit + "K", roles + (role[:1] or "-"), [*made, f"{role}:{text}"])
        for new in ("user", "assistant"):
            go(i + 1, cost + 3 + extra, audit + "R", roles + new[0], [*made, f"{new}:{text}"])

    go(0, 0, "", "", [])
    return best[0]


def expected(rows, ids):
    out = []
    for conv in ids:
        mine = [r[1:] for r in rows if r[0] == conv]
        found = kinds(mine)
        cost, audit, made = cheapest(found)
        turns = [t for t, _, _ in mine if t is not None]
        starts = [r[:1] if r[:1] in ("s", "u", "a") else "-" for r, _, _ in found]
        out.append((conv, max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
                    *[sum(k == x for _, _, k in found) for x in ("blank", "duplicate", "truncated")],
                    sum(a + b not in ("su", "ua", "au") for a, b in zip(starts, starts[1:], strict=False)),
                    cost, audit, hashlib.sha256("\n".join(made).encode()).hexdigest()))
    return sorted(out, key=repr)


def test_repairs_are_the_cheapest_and_least_of_all_edit_strings(spark):
    draw = random.Random(2)
    texts = ["Yes.", "No!", "cut", " \t", "", None, "Why? ", "Yes."]
    roles = ["user", "assistant", "system", "tool", None, "", "Uses"]
    rows = [(c if c else None, draw.choice([None, 1, 2, 3, 4, 9]), draw.choices(roles, [9, 9, 3, 1, 1, 1, 1])[0],
             draw.choice(texts) if draw.random() < 0.5 else f"text {draw.random()}.")
            for c in range(45) for _ in range(draw.randrange(6))]
    frames = frame(spark, rows)
    got = C.repair_report(frames, frames.unionByName(frame(spark, [(77, 1, "user", "x")]))).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows, {r[0] for r in rows} | {77})
    edits = C.repaired_rows(frames).groupBy("conv").count().collect()
    by = {None if r.conv is None else int(r.conv): r["count"] for r in edits}
    assert all(len(r.audit.replace("D", "")) == by.get(r.conv_id, 0) for r in got)


def test_damage_follows_the_draws(spark):
    rows = [(c, t, r, x) for c in (1, 2, None) for t in [*range(40), None] for r, x in [("assistant", "Is it? It is."), (None, None)]]
    want = []
    for c, t, r, x in rows:
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = r or " ", x or " "
        if d:
            want += [(c, t, "user" if d == 4 else r, "" if d == 1 else re.sub("[.!?]", "", x) if d == 2 else x)] * (2 if d == 3 else 1)
    got = [tuple(r) for r in C.damaged(frame(spark, rows)).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(want) != len(rows)


def test_state_is_carried_across_batches_of_any_size(spark):
    draw = random.Random(4)
    rows = [(1, t, draw.choice(["user", "assistant"]), f"{t} {'long ' * (20_000 if t == 5 else 1)}{draw.choice(['.', ''])}") for t in range(700)]
    rows += [(2, t, "user", f"{t}.") for t in range(3)] + [(3, 1, "user", "same.")] * 300
    frames = frame(spark, rows)

    def answer():
        return sorted((tuple(r) for r in C.repair_report(frames, frames).collect()), key=repr)

    whole = answer()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert answer() == whole
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert [r[3] for r in whole] == [0, 0, 299] and whole[2][7].count("D") >= 299


def test_empty_tables_and_conversations_without_rows(spark):
    none = frame(spark, [])
    assert C.repair_report(none, none).count() == 0
    row = C.repair_report(none, frame(spark, [(5, 1, "user", "x.")])).first()
    assert tuple(row) == (5, 0, 0, 0, 0, 0, 0, "", C.EMPTY_SHA)


def test_backpointers_of_a_batch_are_those_of_the_program():
    batch = pd.DataFrame({"conv": ["a"] * 3, "known": True, "turn": [3, 2, 1], "tie": "", "row": [3, 2, 1],
                          "initial": ["a", "u", "s"], "fault": [0, 0, 0]})
    edits = next(C._backward(iter([batch])))["edits"].tolist()
    assert edits[2] & 3 == C.KEEP and (edits[1] >> 2 * C.AFTER_S) & 3 == C.KEEP and (edits[0] >> 2 * C.AFTER_U) & 3 == C.KEEP
