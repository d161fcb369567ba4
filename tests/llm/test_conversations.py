"""Operator 12: brute force over all edit scripts, split conversations, defined cases."""

import functools
import hashlib
import random
import zlib

import pytest

from ledgerline.llm.conversation_repair import (
    CLOSING, GOAL, NONE, UNREACHED, applied, code, conversation_repairs, crossing, damaged, forward, joined, repaired_pieces, script)

LEGAL = {"su", "ua", "au"}
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
DUE = {"": "u", "s": "u", "u": "a", "a": "u"}


def damage(rows):
    out = {}
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        own = out.setdefault(conv, [])
        if kind == 0:
            continue
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        own += [(turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return {c: sorted(r, key=lambda x: (x[0] is not None, x[0] or 0, x[1].encode(), x[2].encode())) for c, r in out.items()}


def brute(rows):
    faults, seen = [], set()
    for _, role, text in rows:
        body = text.strip(" \t\n\x0b\x0c\r")
        faults.append("blank" if not body else "duplicate" if (role, text) in seen else "truncated" if body[-1] not in ".!?" else "")
        seen.add((role, text))

    @functools.cache
    def best(i, state, inserts=0):
        """Least (cost, audit, lines) from row i on."""
        found = []
        due = DUE[state]
        if inserts < 3:
            c, a, lines = best(i, due, inserts + 1)
            found.append((c + 2, "I" + a, ({"u": "user:", "a": "assistant:"}[due], *lines)))
        if i == len(rows):
            if state in ("", "a"):
                found.append((0, "", ()))
        else:
            _, role, text = rows[i]
            more = faults[i] == "truncated"
            c, a, lines = best(i + 1, state)
            found.append((c + 3, "D" + a, lines))
            if faults[i] in ("", "truncated"):
                c, a, lines = best(i + 1, due)
                found.append((c + 2 + more, "R" + a, ({"u": "user", "a": "assistant"}[due] + ":" + text, *lines)))
                to = NEXT.get((state, role[:1]))
                if to:
                    c, a, lines = best(i + 1, to)
                    found.append((c + more, "K" + a, (f"{role}:{text}", *lines)))
        return min(found, default=(10 ** 9, "", ()))

    cost, audit, lines = best(0, "")
    turns = {t for t, _, _ in rows if t is not None}
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, *[faults.count(f) for f in ("blank", "duplicate", "truncated")],
            sum(a[1][:1] + b[1][:1] not in LEGAL for a, b in zip(rows, rows[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


TEXTS = ["Fine.", "Good!", "Why?", "cut off", "", " ", "\t\n", "\xa0", "é.", "...", None, "so. \n"]
ROLES = ["user"] * 5 + ["assistant"] * 5 + ["system", "s", "tool", "", None, "ünknown", "User"]


def sample(n, longest, seed=3):
    rng = random.Random(seed)
    rows = []
    for conv in range(n):
        turns = rng.choice([range(longest), range(3, longest + 3), [rng.randint(-4, 9) for _ in range(longest)], [None] * 3 + list(range(4))])
        for k, turn in enumerate(list(turns)[: rng.randint(1, longest)]):
            role = rng.choice(ROLES) if rng.random() < 0.5 else ["user", "assistant"][k % 2]
            text = rng.choice(TEXTS) if rng.random() < 0.5 else f"{rng.randint(0, 30)} words."
            rows.append((None if conv == 5 else conv, turn, role, text))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1, 2) for r in rows],
                                 "conv_id long, turn long, role string, text string, audit string, copies int, of int").repartition(3)


def check(df, rows):
    want = {c: brute(r) for c, r in damage(rows).items()}
    cols = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    got = [tuple(r) for r in df.select(cols).collect()]
    assert len(got) == len(want)
    for conv, *rest in got:
        assert tuple(rest) == want[conv], conv


def test_scripts_are_least():
    rng = random.Random(9)
    for _ in range(300):
        rows = [(k, rng.choice(["user", "assistant", "system", "tool"]), rng.choice(["Fine.", "", "cut", f"{k}.", f"{k}"])) for k in range(rng.randint(0, 9))]
        want = brute(rows)
        seen, codes = set(), bytearray()
        for _, role, text in rows:
            fault = 2 if not text or (role, text) in seen else int(text[-1] != ".")
            seen.add((role, text))
            codes.append(code(role[:1], fault))
        edits = script(bytes(codes), NONE, GOAL)
        lines, state = applied(edits, [r[1:] for r in rows], NONE)
        assert edits + CLOSING[state] == want[6]
        assert all(x[0] in "sua" for x in lines)


def test_joined_blocks_give_the_vector_of_the_whole():
    rng = random.Random(2)
    for _ in range(100):
        codes = bytes(rng.randrange(12) for _ in range(rng.randint(2, 30)))
        cut = rng.randint(1, len(codes) - 1)
        blocks = [[v for s in range(4) for v in forward(part, s)] for part in (codes[:cut], codes[cut:])]
        at = [0, UNREACHED, UNREACHED, UNREACHED]
        for b in blocks:
            at = joined(at, b)
        whole = forward(codes, NONE)
        assert [v if v < UNREACHED else None for v in at] == [v if v < UNREACHED else None for v in whole]
        assert crossing(at, GOAL) == crossing(whole, GOAL)


@pytest.mark.parametrize("long_rows, block", [(10_000, 4096), (4, 3)])
def test_equals_brute_force(spark, long_rows, block):
    rows = sample(60, 9)
    rows += [(100, k, ["user", "assistant"][k % 2], f"turn {k}." if k % 7 else "same") for k in range(150)]
    rows += [(101, 1, "user", "All alike.")] * 40 + [(102, None, None, None)] * 9 + [(103, 0, "user", "x" * 50_000 + ".")]
    df = damaged(frame(spark, rows))
    check(conversation_repairs(df, long_rows=long_rows, block=block), rows)
    pieces = repaired_pieces(df, long_rows=long_rows, block=block).collect()
    text = {}
    for r in sorted(pieces, key=lambda r: r.block):
        text.setdefault(r.conv_id, []).extend([r.repaired] if r.repaired is not None else [])
    want = {c: brute(r)[-1] for c, r in damage(rows).items()}
    assert {c: hashlib.sha256("\n".join(p).encode()).hexdigest() for c, p in text.items()} == want


def test_long_texts_go_the_long_way(spark):
    rows = sample(6, 9, seed=8)
    check(conversation_repairs(damaged(frame(spark, rows)), long_bytes=10), rows)


def test_no_rows(spark):
    assert conversation_repairs(damaged(frame(spark, [(1, 1, "user", "a")]).where("false"))).count() == 0
