"""Repair of conversations against a plain dynamic program over whole audits."""

import hashlib
import itertools
import random
import re
import zlib

from tidemark.llm import dialogue


def best(rows):
    """(cost, audit, lines) of rows (role, text, must go, truncated): every node keeps its least (cost, audit)."""
    due = {0: ("user", 2), 1: ("user", 2), 2: ("assistant", 3), 3: ("user", 2)}
    at = {0: (0, "", ())}
    for i in range(len(rows) + 1):
        for _ in range(4):
            for s, (c, a, out) in list(at.items()):
                role, t = due[s]
                at[t] = min(at.get(t, (9**9,)), (c + 2, a + "I", (*out, f"{role}:")))
        if i == len(rows):
            break
        role, text, goes, cut = rows[i]
        new = {}
        for s, (c, a, out) in at.items():
            ways = [(3, "D", s, out)]
            if not goes:
                first = role[:1]
                t = 1 if first == "s" and s == 0 else 2 if first == "u" and s != 2 else 3 if first == "a" and s == 2 else None
                if t is not None:
                    ways.append((cut, "K", t, (*out, f"{role}:{text}")))
                ways.append((2 + cut, "R", due[s][1], (*out, f"{due[s][0]}:{text}")))
            for cost, letter, t, lines in ways:
                new[t] = min(new.get(t, (9**9,)), (c + cost, a + letter, lines))
        at = new
    return min(at[s] for s in (0, 3) if s in at)


def brute(rows):
    found = {}
    for conv, turn, role, text in rows:
        out = found.setdefault(conv, [])
        role, text = (" " if x is None else x for x in (role, text))
        x = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if x == 0:
            continue
        text = "" if x == 1 else re.sub("[.!?]", "", text) if x == 2 else text
        out += [(turn, "user" if x == 4 else role, text)] * (2 if x == 3 else 1)
    made = []
    for conv, out in found.items():
        out.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, typed, n = set(), [], [0, 0, 0]
        for _, role, text in out:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            fault = 0 if not last else 1 if (role, text) in seen else 2 if last[0] not in ".!?" else 3
            seen.add((role, text))
            if fault < 3:
                n[fault] += 1
            typed.append((role, text, fault < 2, int(fault == 2)))
        turns = [t for t, _, _ in out if t is not None]
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(out))
        cost, audit, lines = best(typed)
        made.append((str(conv), max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *n, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(made)


def run(df, **sizes):
    columns = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")
    return sorted((str(r.conv_id), *[r[c] for c in columns]) for r in dialogue.repair_damaged(df, **sizes).collect())


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1) for r in rows], "conv_id long, turn long, role string, text string, block string, whole int").repartition(3)


def conversation(rng, conv, n):
    roles = ["user", "assistant", "system", "user", "assistant", "tool", None, "", "a", "sys"]
    texts = ["Yes.", "No!", "why", "", " \n", None, "Fine?", "é😀", "Yes. "]
    # one role and text for a turn, so that rows of a turn have an order
    return [(conv, None if rng.random() < 0.1 else t, rng.choice(roles[:rng.choice([2, 10])]), f"{rng.choice(texts) or ''}{rng.choice(['', t])}" if rng.random() < 0.9 else None) for t in range(n)]


def test_blocks_and_trees_equal_brute_force(spark):
    rng = random.Random(5)
    rows = [r for c in range(120) for r in conversation(rng, c, rng.randrange(9))] + conversation(rng, 500, 160) + conversation(rng, None, 30) + [(900, 0, "user", "x")]
    rows += rows[:40] + conversation(rng, 501, 40)
    df = frame(spark, rows)
    expected = brute(rows)
    assert run(df) == expected
    assert run(df, block_rows=3, fan=2) == expected
    assert run(df, block_rows=7, block_bytes=9, fan=3) == expected


def test_ways_are_the_least_of_all():
    rng = random.Random(1)
    for _ in range(3000):
        rows = [(rng.choice(["system", "user", "assistant", "tool"]), "", rng.random() < 0.2, int(rng.random() < 0.3)) for _ in range(rng.randrange(9))]
        kinds = [("sua".find(r[0]) if r in "sua" else 3) * 3 + (2 if g else c) for r, g, c in ((x[0][:1], x[2], x[3]) for x in rows)]
        vector, total = dialogue.over(kinds, 0)
        last, cost = dialogue.ended(vector)
        made = dialogue.rewritten([{"turn": 0, "role": r[0], "text": ""} for r in rows], kinds, 0, last, True)
        assert (cost + total, made["audit"]) == best(rows)[:2]


def test_a_long_conversation_and_long_texts(spark):
    rng = random.Random(2)
    rows = conversation(rng, 1, 3000) + [(2, 0, "user", "y" * 300_000 + "."), (2, 1, "assistant", "z" * 300_000 + "."), (3, 5, "user", "a?")]
    rows += [(4, 1, "user", "the same.")] * 500
    assert run(frame(spark, rows), block_rows=50, fan=4) == brute(rows)


def test_all_rows_dropped_and_nothing(spark):
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    got = run(frame(spark, [(gone, 0, "user", "hi.")]))
    assert got == [(str(gone), 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert run(frame(spark, [(1, 1, "user", "x")]).limit(0)) == []


def test_whole_given_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    assert run(df) == brute([(r.conv_id, r.turn, r.role, r.text) for r in df.collect()])
