"""Conversation repair against a plain search over every cheapest edit list."""
import hashlib
import random
import zlib

import pytest

from barwise.llm import conversation_repair as cr

SCHEMA = "conv_id long, turn long, role string, text string, place int, edit string, cost string"
NEXT = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
FORCED = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def brute(rows):
    """rows: (turn, role, text) after damage -> the report's columns and the repaired rows."""
    rows = sorted(((t, " " if r is None else r, " " if x is None else x) for t, r, x in rows),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, faults = set(), []
    for _, role, text in rows:
        cut = text.rstrip(" \t\n\x0b\x0c\r")
        faults.append("b" if not cut else "d" if (role, text) in seen else "t" if cut[-1] not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    best = {"": (0, "", [])}

    def put(into, state, value):
        if state not in into or value[:2] < into[state][:2]:
            into[state] = value

    def inserted(states):
        out = dict(states)
        for _ in range(2):
            for s, (c, a, r) in list(out.items()):
                put(out, FORCED[s], (c + 3, a + "I", r + [(NAMES[FORCED[s]], "")]))
        return out

    for (_, role, text), f in zip(rows, faults):
        after = {}
        # every insert run on its own: the least audit of a node is only comparable after a row's edit
        for s0, (c0, a0, r0) in best.items():
            s, c, a, r = s0, c0, a0, r0
            for _ in range(3):
                put(after, s, (c + 4, a + "D", r))
                if f not in ("b", "d"):
                    more = 3 if f == "t" else 0
                    if role[:1] in NEXT[s]:
                        put(after, role[:1], (c + more, a + "K", r + [(role, text)]))
                    put(after, FORCED[s], (c + 3 + more, a + "R", r + [(NAMES[FORCED[s]], text)]))
                s, c, a, r = FORCED[s], c + 3, a + "I", r + [(NAMES[FORCED[s]], "")]
        best = after
    best = inserted(best)
    cost, audit, kept = min((best[s] for s in ("", "a") if s in best), key=lambda x: x[:2])
    turns = {t for t, *_ in rows if t is not None}
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("b"), faults.count("d"), faults.count("t"),
            illegal, cost, audit), kept


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 1:
            text = ""
        if k == 2:
            text = "".join(c for c in text if c not in ".!?")
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def sha(kept):
    return hashlib.sha256("\n".join(f"{r}:{t}" for r, t in kept).encode()).hexdigest()


def table():
    rng = random.Random(5)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "undo"]
    texts = ["Hello.", "Yes!", "no end", "", " \t\n", None, "é?", "End. \n", "again."]
    rows = []
    for conv in [None, *range(60)]:
        n = rng.choice([1, 2, 3, 5, 8, 13, 40])
        for t in range(n):
            text = rng.choice(texts) if rng.random() < 0.6 else f"Text {rng.random()}."
            rows.append((conv, rng.choice([t, t, t, None, 2 * t]), rng.choice(roles[:4] if rng.random() < .7 else roles), text))
    rows += [(1000, t, "user" if t % 2 == 0 else "assistant", f"Turn {t}.") for t in range(300)]
    rows += [(1001, 0, "user", "Same.")] * 150
    rows += [(1002, -2**63, "user", "x" * 100_000 + "."), (1002, 2**63 - 1, "assistant", "long")]
    return rows


@pytest.mark.parametrize("segment_bits, fan_bits", [(12, 10), (2, 1)])
def test_repair(spark, segment_bits, fan_bits):
    rows = table()
    df = spark.createDataFrame([(*r, 1, "e", "c") for r in rows], SCHEMA).repartition(5)
    report, repaired = cr.repair(df, segment_bits, fan_bits)
    got = {r["conv_id"]: tuple(r)[1:] for r in report.collect()}
    shas = {r[0]: r[1] for r in cr.digests(repaired).collect()}
    kept = {}
    for r in sorted(repaired.collect(), key=lambda r: r["place"]):
        kept.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for conv in {r[0] for r in rows}:
        want, left = brute([r[1:] for r in rows if r[0] == conv])
        if conv == 1002:
            want = (2**64 - 2, *want[1:])  # no long: counted as none
            assert got[conv][1:] == want[1:]
        else:
            assert got[conv] == want, conv
        assert kept.get(conv, []) == left
        assert shas.get(conv, sha([])) == sha(left)


def test_damaged(spark):
    rows = [r for r in table() if r[0] != 1002] + [(c, t, "user", f"Only {c}.") for c in range(2000, 2040) for t in (7,)]
    df = spark.createDataFrame([(*r, 1, "e", "c") for r in rows], SCHEMA)
    got = {r[0]: tuple(r)[1:] for r in cr.repair_damaged(df).collect()}
    harmed = damaged(rows)
    assert len(got) == len({r[0] for r in rows})
    for conv in {r[0] for r in rows}:
        want, left = brute([r[1:] for r in harmed if r[0] == conv])
        assert got[conv] == (*want, sha(left)), conv


def test_empty(spark):
    assert cr.repair_damaged(spark.createDataFrame([], SCHEMA)).count() == 0
