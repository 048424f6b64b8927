"""The prefix trie of conversations against a trie in memory."""

import hashlib
import random
from collections import defaultdict
from zlib import crc32

from inkwell.llm import convtrie as CT


def rebuilt_by_loop(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn, role or "", text or ""))
    tie = lambda t: hashlib.sha256(f"{len(t[1])}:{t[1]}{t[2]}".encode()).hexdigest()
    own = {c: [t[1:] for t in sorted(v, key=lambda t: (t[0] is not None, t[0] or 0, tie(t)))] for c, v in own.items()}
    out = {}
    for c, turns in own.items():
        h = crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def trie_by_loop(rows):
    convs = rebuilt_by_loop(rows)
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        saved[node] = sum(saved[k] for k in kids[node]) + (len(members[node]) - 1) * (len(node[-1][1]) if node else 0)
    out = []
    for node, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(node))
        out.append((min(m), len(node), min(members[node[:-1]]) if node else None, len(m), len(kids[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows], "conv_id long, turn long, role string, text string, depth int, owner string").repartition(3)


def check(spark, rows, local):
    got = sorted(map(tuple, CT.prefix_trie(table(spark, rows), local=local).collect()), key=lambda r: r[:2])
    assert got == trie_by_loop(rows)


def test_small_families_in_rounds_and_at_once(spark):
    r = random.Random(3)
    rows = []
    for c in [*range(100, 150), *range(-7, 9), 450, 451, 1000]:
        for t in range(r.choice([1, 2, 3, 7])):
            rows.append((c, t, r.choice(["user", None, ""]), r.choice(["a", "bé", "", None, "hello"])))
    rows += [(None, 0, "user", "lost"), (5, None, "user", "early"), (5, 1, "user", "twice"), (5, 1, "user", "twice"), (5, 1, "assistant", "again")]
    check(spark, rows, 5000)
    check(spark, rows, 12)


def test_long_thin_and_hot(spark):
    rows = [(7, t, "u", f"turn {t}") for t in range(160)] + [(8, t, "u", f"turn {t}" if t < 120 else "other") for t in range(140)]
    rows += [(c, t, "u", "same") for c in range(200, 260) for t in range(3)]
    check(spark, rows, 30)


def test_empty(spark):
    assert CT.prefix_trie(table(spark, [])).collect() == []
