"""Spelling variants against all pairs of words."""

import random
import re
from collections import Counter
from zlib import crc32

from inkwell.llm import spelling as SP


def apart(a, b):
    """Whether two texts differ by exactly one inserted, deleted or replaced code point."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def words_by_loop(rows):
    n = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            n[run] += 1
    return {w: c for w, c in n.items() if len(w) >= 7 and c >= 2}


def variants_by_loop(n, ratio=10):
    out = []
    near = {w: [v for v in n if abs(len(v) - len(w)) <= 1 and apart(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v.encode()), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None))
    return sorted(out)


def edited(r, word, letters):
    i, kind = r.randrange(len(word) + 1), r.randrange(3)
    return word[:i] + (r.choice(letters) if kind < 2 else "") + word[i + (kind > 0) :]


def test_neighbours_match_all_pairs(spark):
    r = random.Random(8)
    for letters, n, sizes in (("ab", 400, (1, 9)), ("abcdefgéÿ", 300, (7, 14)), ("aaaab", 150, (10, 60))):
        words = {"".join(r.choices(letters, k=r.randint(*sizes))) for _ in range(n)}
        words |= {edited(r, w, letters) for w in list(words) for _ in range(2)} - {""}
        words |= {"prefix" + w for w in list(words)[:100]} | {w + "suffix" for w in list(words)[:100]}
        words |= {"x" * k for k in range(1, 12)} | {"ab" * 300, "ab" * 300 + "a", "ab" * 150 + "b" + "ab" * 150, "ab" * 150 + "c" + "ab" * 150}
        table = sorted(words)
        df = spark.createDataFrame(list(enumerate(table)), "id long, word string")
        got = sorted(map(tuple, SP.neighbours(df).collect()))
        assert got == [(i, j) for i, a in enumerate(table) for j, b in enumerate(table) if abs(len(a) - len(b)) < 2 and apart(a, b)]


def test_query_matches_loop(spark):
    r = random.Random(9)
    base = ["".join(r.choices("abcdeéèÀ×lmn", k=r.randint(5, 11))) for _ in range(60)]
    many = [edited(r, w, "abcdeéz") for w in base for _ in range(3)] + base * 4
    frequent = ["Example", "exempler", "examplér"] * 120 + ["examplÉ"] * 2 + ["examplex"] * 30 + ["exxmplex"] * 2
    rows = []
    for i in range(300):
        text = " ".join(r.choices(many, k=30) + r.choices(frequent, k=20))
        rows.append((i - 5, text if i % 3 else text.upper().replace(" ", ",\n1")))
    rows += [(None, "Example example ABCDEFG abcdefg"), (7, None), (8, ""), (9, "x" * 50_000 + " " + "x" * 50_000), (10, "x" * 50_000 + "y"), (11, "x" * 50_000 + "y")]
    rows += rows[:20]
    docs = spark.createDataFrame([(*x, 1, "w") for x in rows], "doc_id long, text string, n int, word string").repartition(3)
    got = sorted(map(tuple, SP.spelling_query(docs).collect()))
    want = variants_by_loop(words_by_loop(rows))
    assert got == want and any(x[1] for x in got)
    assert SP.spelling_query(docs.limit(0)).collect() == []


def test_chains_and_ties(spark):
    n = {"aaaaaaa": 10_000, "aaaaaab": 1000, "aaaaacb": 100, "aaaadcb": 10, "aaaedcb": 1, "zzzzzzz": 5, "zzzzzzy": 50, "zzzzzzx": 50, "lonesome": 3}
    got = sorted(map(tuple, SP.variants(spark.createDataFrame(list(n.items()), "word string, n long")).collect()))
    assert got == variants_by_loop(n)
    assert dict((x[0], x[2]) for x in got)["aaaedcb"] == "aaaaaaa" and dict((x[0], x[1]) for x in got)["zzzzzzz"] == "zzzzzzx"
