"""Exact removal of long repeated byte strings by a distributed suffix sort.

Every byte covered by a string of LENGTH bytes that starts at two or more places is
removed; documents are separate and judged as they came in.

Which suffixes are sorted. The smallest hashed K-gram (the leftmost of equals) of each
LENGTH bytes is an anchor. Equal strings have the same anchor at the same distance from
their start, so a repeated string shows up as two anchors with equal K-grams whose common
context to the left (L bytes) and to the right (R bytes, from the anchor on) make
L + R >= LENGTH. It is enough to sort the suffixes that start at anchors (about one byte in
WINDOW / 2) and, for the left contexts, the reversed prefixes that end there; anchors whose
K-gram occurs once are left out first.

How they are sorted. Each task sorts its distinct suffixes into runs, front-codes them (the
length of the prefix shared with the suffix before, and the rest) and cuts them at sampled
splitters. The runs are exchanged and every range is merged by a loser tree that knows, for
each run's head, the prefix it shares with the last output: heads that differ in it are
decided without looking at a byte, equal ones are compared from there on. Common prefixes
of neighbours come out with the order. Their running minima to both sides are the lengths
at which a suffix parts from others; ranges hand theirs over to the neighbours, so a range
may end anywhere and no group needs to fit one task.

What is removed. Each anchor owns the starts of the strings it is chosen for, a run of
neighbouring positions; its block is the bytes of all these strings. Anchors with equal
blocks are copies: all strings of the block repeat, and one of them stands for the others.
K-grams that have one block only are then done. For anchors a, b with different blocks the
repeated strings are those that start L or less and LENGTH - R or more before a. Their
extremes cover them all, and they are among the lengths just found or the ends of the owned
run, on both sides of the pair. So each block proposes these few starts, and those whose
LENGTH bytes (as a 128-bit digest) two blocks propose are repeats.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from inkwell.llm.common import mix, quoted, small_batches, written

LENGTH = 400
K = 50
WINDOW = LENGTH - K + 1
LEFT = LENGTH - K  # no anchor is farther from the start of its string
TAG = 8  # bytes of the K-gram's digest before a left context
BLOCK = 1 << 19
RUN = 16_384
SAMPLE = 1000
SAMPLES_PER_RANGE = 8
CHUNK = 4 << 20
_INDEX = np.uint64((1 << 20) - 1)
_BASE = 0x9E3779B97F4A7C15
_UNBASE = pow(_BASE, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(out, dtype=np.uint64)


_TABLES: dict[str, np.ndarray] = {}


def _kgrams(data: np.ndarray) -> np.ndarray:
    """Hash of each K-gram of at most BLOCK + LENGTH bytes."""
    if not _TABLES:
        _TABLES["up"], _TABLES["down"] = _powers(_BASE, BLOCK + LENGTH), _powers(_UNBASE, BLOCK + LENGTH)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _TABLES["up"][: len(data)], out=sums[1:])
        n = len(data) - K + 1
        return mix((sums[K:] - sums[:n]) * _TABLES["down"][:n])


def _window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbouring values, by running minima of blocks in both directions."""
    n = len(values)
    padded = np.full(-(-n // width) * width, np.iinfo(np.uint64).max, np.uint64)
    padded[:n] = values
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Positions and K-gram hashes of the anchors, in order, and first and last start that each owns."""
    raw = np.frombuffer(data, np.uint8)
    where, what, first = [np.empty(0, np.int64)], [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
    for at in range(0, len(raw) - LENGTH + 1, BLOCK):
        h = _kgrams(raw[at : at + BLOCK + LENGTH - 1])
        index = np.arange(len(h), dtype=np.uint64)
        best = (_window_minima((h & ~_INDEX) | index, WINDOW) & _INDEX).astype(np.int64)
        new = np.flatnonzero(np.concatenate(([True], best[1:] != best[:-1])))
        where.append(best[new] + at)
        what.append(h[best[new]])
        first.append(new + at)
    where, what, first = np.concatenate(where), np.concatenate(what), np.concatenate(first)
    if len(where):
        new = np.concatenate(([True], where[1:] != where[:-1]))
        where, what, first = where[new], what[new], first[new]
    return where, what, first, np.append(first[1:] - 1, len(raw) - LENGTH)[: len(where)]


def digest(data: bytes, size: int = 16) -> bytes:
    return hashlib.blake2b(data, digest_size=size).digest()


def common(a: bytes, b: bytes, known: int = 0) -> int:
    """Length of the common prefix; the first ``known`` bytes are not looked at."""
    low, high = known, min(len(a), len(b))
    if a[low:high] == b[low:high]:
        return high
    step = 16
    while low + step < high and a[low : low + step] == b[low : low + step]:
        low += step
        step *= 2
    high = min(high, low + step)
    while high - low > 1:
        middle = (low + high) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle
    return low if a[low:high] != b[low:high] else high


class LoserTree:
    """Merges sorted front-coded runs without comparing known prefixes again.

    ``runs`` yield (prefix shared with the run's previous string, rest, payload). For each
    head the tree keeps the length of the prefix it shares with the string that beat it,
    which on the winner's way up is the last output.
    """

    def __init__(self, runs: list[Iterator[tuple[int, bytes, object]]]) -> None:
        self.runs = runs
        self.size = 1 << max(0, (len(runs) - 1).bit_length())
        self.text: list[bytes | None] = [None] * self.size
        self.shared = [0] * self.size
        self.payload: list[object] = [None] * self.size
        for i in range(len(runs)):
            self._advance(i)
        self.losers = [0] * self.size
        winners = list(range(self.size))
        level = self.size
        while level > 1:
            level //= 2
            winners = [self._play(winners[2 * i], winners[2 * i + 1], level + i) for i in range(level)]
        self.winner = winners[0]

    def _advance(self, i: int) -> None:
        shared, rest, payload = next(self.runs[i], (0, None, None))
        self.text[i] = None if rest is None else (self.text[i] or b"")[:shared] + rest
        self.shared[i], self.payload[i] = shared, payload

    def _play(self, a: int, b: int, node: int) -> int:
        """Winner of two heads; the loser stays at the node."""
        x, y = self.text[a], self.text[b]
        if y is None:
            a, b = b, a
        elif x is not None:
            m, n = self.shared[a], self.shared[b]
            if m == n:
                at = common(x, y, m)
                if x[at : at + 1] <= y[at : at + 1]:
                    a, b = b, a
                self.shared[a] = at
            elif m > n:
                a, b = b, a
        self.losers[node] = a
        return b

    def __iter__(self) -> Iterator[tuple[int, bytes, object]]:
        """(prefix shared with the previous output, string, payload) in order."""
        while self.text[self.winner] is not None:
            w = self.winner
            yield self.shared[w], self.text[w], self.payload[w]
            self._advance(w)
            node = (self.size + w) // 2
            while node:
                w = self._play(w, self.losers[node], node)
                node //= 2
            self.winner = w


def partings(shared: list[int], least: int) -> list[set[int]]:
    """For each string the lengths, ``least`` or more, at which it parts from another one.

    ``shared[i]`` is the common prefix of strings i - 1 and i.
    """
    out: list[set[int]] = [set() for _ in shared]
    for order in (range(len(shared)), range(len(shared) - 1, -1, -1)):
        stack: list[int] = []
        forward = order.step > 0
        for i in order:
            n = shared[i] if forward else (shared[i + 1] if i + 1 < len(shared) else 0)
            if i != order.start:
                while stack and stack[-1] >= n:
                    stack.pop()
                if n >= least:
                    stack.append(n)
                out[i].update(stack)
    return out


def _runs(splitters: list[bytes]):
    """Sort a task's distinct strings into front-coded runs cut at the splitters."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, bytes] = {}

        def out() -> Iterator[pa.RecordBatch]:
            runs: dict[int, tuple[list[int], list[bytes], list[bytes]]] = {}
            before: dict[int, bytes] = {}
            for text, name in sorted((t, n) for n, t in held.items()):
                to = bisect_right(splitters, text)
                n = common(before[to], text) if to in before else 0
                before[to] = text
                for column, value in zip(runs.setdefault(to, ([], [], [])), (n, text[n:], name), strict=True):
                    column.append(value)
            for to, (shared, rest, names) in runs.items():
                yield pa.record_batch([pa.array([to], pa.int32()), pa.array([shared], pa.list_(pa.int32())), pa.array([rest], pa.list_(pa.binary())), pa.array([names], pa.list_(pa.binary()))], ["to", "shared", "rest", "names"])

        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held[name] = text
                if len(held) >= RUN:
                    yield from out()
                    held = {}
        if held:
            yield from out()

    return make


def _merged(least: int):
    """Merge the runs of each range: one row per string, and one (name null) for the range's ends."""
    kinds = [pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.binary(), pa.binary()]

    def one(to: int, runs: list) -> Iterator[pa.RecordBatch]:
        shared, names, texts = [], [], [b"", b""]
        for n, text, name in LoserTree([iter(zip(*r, strict=True)) for r in runs]):
            if names and names[-1] == name:
                continue
            if not names:
                texts[0] = text
            texts[1] = text
            shared.append(n if names else 0)
            names.append(name)
        ahead = np.minimum.accumulate(np.array([LENGTH + TAG, *shared[1:]]))  # shared with the first string
        back = np.minimum.accumulate(np.array([LENGTH + TAG, *shared[:0:-1]]))[::-1]  # and with the last
        rows = [(to, name, sorted(p), int(a), int(b), None, None) for name, p, a, b in zip(names, partings(shared, least), ahead, back, strict=True)]
        rows.append((to, None, sorted({int(x) for x in ahead[1:] if x >= least}), int(ahead[-1]), len(names), texts[0], texts[1]))
        rows.append((to, None, sorted({int(x) for x in back[:-1] if x >= least}), -1, 0, None, None))
        for at in range(0, len(rows), 10_000):
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows[at : at + 10_000], strict=True), kinds, strict=True)], ["to", "name", "at", "ahead", "back", "first", "last"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, runs = None, []
        for batch in batches:
            for to, *run in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if to != now and runs:
                    yield from one(now, runs)
                    runs = []
                now = to
                runs.append(run)
        if runs:
            yield from one(now, runs)

    return merge


def _carried(ends: list, least: int) -> tuple[dict[int, list[int]], dict[int, list[int]]]:
    """What each range's first string shares with earlier ranges, and its last with later ones."""
    info = {r["to"]: {"first": r["first"], "last": r["last"], "whole": r["ahead"] if r["back"] > 1 else LENGTH + TAG, "ahead": r["at"]} for r in ends if r["first"] is not None}
    for r in ends:
        if r["first"] is None:
            info[r["to"]]["back"] = r["at"]
    order = sorted(info)
    left: dict[int, list[int]] = {}
    right: dict[int, list[int]] = {}
    for out, seq, near, far, inner in ((left, order, "first", "last", "back"), (right, order[::-1], "last", "first", "ahead")):
        known: list[int] = []  # what the end of the range just done shares with strings up to and in it
        for i, to in enumerate(seq):
            if i:
                n = common(info[seq[i - 1]][far], info[to][near])
                mine = {min(n, v) for v in known} | {n}
                out[to] = sorted(v for v in mine if v >= least)
            # pass on, seen from this range's other end
            known = sorted(set(info[to][inner]) | {min(info[to]["whole"], v) for v in out.get(to, [])})
    return left, right


def sorted_partings(strings: DataFrame, least: int) -> DataFrame:
    """(name, at) of each distinct (name, text): lengths from ``least`` at which text parts from others."""
    spark = strings.sparkSession
    n = strings.count()
    ranges = max(1, -(-n // RUN))
    share = max(SAMPLE, SAMPLES_PER_RANGE * ranges) / max(1, n)
    chosen = strings.where(F.pmod(F.xxhash64("name"), F.lit(1 << 31)) < int(share * (1 << 31)))
    sample = sorted(r.text for r in chosen.select("text").collect()) if ranges > 1 else []
    splitters = sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)}) if sample else []
    runs = strings.select("name", "text").mapInArrow(_runs(splitters), "to int, shared array<int>, rest array<binary>, names array<binary>")
    dealt = runs.repartition(len(splitters) + 1, "to").sortWithinPartitions("to")
    merged = written(dealt.mapInArrow(_merged(least), "to int, name binary, at array<int>, ahead int, back int, first binary, last binary"), "merged")
    left, right = _carried(merged.where("name is null").collect(), least)
    kind = "to int, left array<int>, right array<int>"
    carried = spark.createDataFrame([(to, left.get(to, []), right.get(to, [])) for to in left.keys() | right.keys() if left.get(to) or right.get(to)], kind)
    capped = lambda side, cap: F.transform(F.coalesce(side, F.array().cast("array<int>")), lambda v: F.least(v, F.col(cap)))
    whole = merged.where("name is not null").join(F.broadcast(carried), "to", "left")  # one row per range
    at = F.filter(F.array_union("at", F.array_union(capped(F.col("left"), "ahead"), capped(F.col("right"), "back"))), lambda v: v >= least)
    return whole.select("name", at.alias("at"))


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Kind 0: an anchor with the names of its contexts within its block; 1 and 2: a right and a left context."""
    names = ["kind", "row", "pos", "first", "last", "name", "other", "text"]
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    rows: list[tuple] = []
    texts: tuple[dict[bytes, bytes], dict[bytes, bytes]] = ({}, {})
    size = 0

    def out() -> pa.RecordBatch:
        some = [*rows, *((kind, None, None, None, None, n, None, t) for kind, held in enumerate(texts, 1) for n, t in held.items())]
        return pa.record_batch([pa.array(c, t) for c, t in zip(list(zip(*some, strict=True)) or [[]] * 8, kinds, strict=True)], names)

    for batch in batches:
        for i, (row, where) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
            data = batch.column(1)[i].as_py()
            for anchor in where:
                pos, first, last = anchor["pos"], anchor["first"], anchor["last"]
                right = data[pos : last + LENGTH]
                left = digest(data[pos : pos + K], TAG) + data[first:pos][::-1]
                a, b = digest(right), digest(left)
                texts[0][a], texts[1][b] = right, left
                rows.append((0, row, pos, first, last, a, b, None))
                size += len(right) + len(left)
                if size > CHUNK:
                    yield out()
                    rows, texts, size = [], ({}, {}), 0
    yield out()


def repeated_starts(rows: DataFrame) -> DataFrame:
    """(row, starts): where repeated strings of LENGTH bytes start, enough of them to cover all their bytes.

    ``rows``: row (long, unique), data (binary); it must give the same rows when read again.
    """
    small_batches(rows.sparkSession)

    def kgram_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [anchors(d)[1] for d in batch.column(0).to_pylist()]
            values, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *found]), return_counts=True)
            yield pa.record_batch([pa.array(values.view(np.int64)), pa.array(counts.astype(np.int64))], ["kgram", "n"])

    def blocks_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, d in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                where, what, first, last = anchors(d)
                if len(where):
                    block = [digest(d[a : b + LENGTH]) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
                    columns = [np.full(len(where), row), where, first, last, what.view(np.int64)]
                    yield pa.record_batch([*map(pa.array, columns), pa.array(block, pa.binary())], ["row", "pos", "first", "last", "kgram", "block"])

    again = rows.select("data").mapInArrow(kgram_counts, "kgram long, n long").groupBy("kgram").agg(F.sum("n").alias("n")).where("n > 1").select("kgram")
    again = written(again, "kgrams")
    found = rows.select("row", "data").mapInArrow(blocks_of, "row long, pos long, first long, last long, kgram long, block binary")
    found = written(found.join(again, "kgram"), "anchors")
    # one anchor stands for each block; K-grams with several blocks go on
    blocks = written(found.groupBy("kgram", "block").agg(F.count("*").alias("n"), F.min(F.struct("row", "pos", "first", "last")).alias("one")), "blocks")
    several = blocks.groupBy("kgram").agg(F.count("*").alias("m")).where("m > 1").select("kgram")
    wanted = blocks.join(several, "kgram").select("one.*").groupBy("row").agg(F.collect_list(F.struct("pos", "first", "last")).alias("where"))
    wanted = written(wanted, "wanted")
    contexts = written(
        rows.select("row", "data").join(wanted, "row").select("row", "data", "where")
        .mapInArrow(_contexts, "kind int, row long, pos long, first long, last long, name binary, other binary, text binary"),
        "contexts",
    )
    anchor = contexts.where("kind = 0").select("row", "pos", "first", "last", F.col("name").alias("right"), F.col("other").alias("left"))
    for side, kind, least in (("right", 1, K), ("left", 2, TAG)):
        at = sorted_partings(contexts.where(F.col("kind") == kind).select("name", "text"), least)
        anchor = anchor.join(at.select(F.col("name").alias(side), F.col("at").alias(f"{side}_at")), side)
    by_right = F.transform("right_at", lambda v: F.col("pos") - LENGTH + v)
    by_left = F.transform("left_at", lambda v: F.col("pos") + TAG - v)
    inside = F.filter(F.concat(by_right, by_left), lambda s: (s > F.col("first")) & (s < F.col("last")))
    starts = F.array_distinct(F.concat(F.array("first", "last"), inside))
    proposed = written(anchor.select("row", starts.alias("starts")).groupBy("row").agg(F.flatten(F.collect_list("starts")).alias("starts")), "starts")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, (row, starts) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                data = batch.column(1)[i].as_py()
                yield pa.record_batch([pa.array([row] * len(starts), pa.int64()), pa.array(starts, pa.int64()), pa.array([digest(data[s : s + LENGTH]) for s in starts], pa.binary())], ["row", "start", "name"])

    strings = written(rows.select("row", "data").join(proposed, "row").select("row", "data", "starts").mapInArrow(hashed, "row long, start long, name binary"), "strings")
    twice = strings.groupBy("name").agg(F.count("*").alias("n")).where("n > 1").select("name")
    copies = found.join(blocks.where("n > 1").select("block"), "block").select("row", F.explode(F.array("first", "last")).alias("start"))
    return strings.join(twice, "name").select("row", "start").union(copies).groupBy("row").agg(F.collect_list("start").alias("starts"))


def spans_of(starts: list[int]) -> list[tuple[int, int]]:
    """Maximal runs covered by LENGTH bytes from each start."""
    out: list[tuple[int, int]] = []
    for s in sorted(starts):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], s + LENGTH)
        else:
            out.append((s, s + LENGTH))
    return out


def remove_repeats(docs: DataFrame, text: str = "text", key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(key, row, data) of the documents, and (row, n_removed, n_spans, kept) of those that lose bytes.

    Row numbers are written once with the bytes: how a table is cut into tasks may change
    from job to job, and with it the numbers given while scanning.
    """
    given = docs.select(quoted(key).alias("key"), F.monotonically_increasing_id().alias("row"), F.coalesce(quoted(text).cast("binary"), F.lit(b"")).alias("data"))
    rows = written(given, "rows")
    starts = written(repeated_starts(rows.select("row", "data")), "repeats")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for i, (row, where) in enumerate(zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True)):
                data = batch.column(1)[i].as_py()
                spans, at, kept = spans_of(where), 0, []
                for a, b in spans:
                    kept.append(data[at:a])
                    at = b
                out.append((row, sum(b - a for a, b in spans), len(spans), b"".join([*kept, data[at:]])))
            types = [pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(list(zip(*out, strict=True)) or [[]] * 4, types, strict=True)], ["row", "n_removed", "n_spans", "kept"])

    return rows, rows.join(starts, "row").select("row", "data", "starts").mapInArrow(cut, "row long, n_removed long, n_spans long, kept binary")


def repeats_query(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 of each row.

    Null and short texts lose nothing; repeated rows are repeats of each other, so from
    LENGTH bytes on they lose all.
    """
    spark = docs.sparkSession
    clean = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(clean, "false")
    spark.conf.set(clean, "true")  # each step is a written table; its shuffle files go with it
    try:
        rows, cut = remove_repeats(docs)
        lost = written(cut.select("row", "n_removed", "n_spans", F.sha2("kept", 256).alias("sha")), "removed")
    finally:
        spark.conf.set(clean, before)
    every = rows.select(F.col("key").alias("doc_id"), "row", F.octet_length("data").cast("long").alias("n_bytes"), F.sha2("data", 256).alias("own"))
    none = F.lit(0).cast("long")
    return every.join(lost, "row", "left").select("doc_id", "n_bytes", F.coalesce("n_removed", none).alias("n_removed"), F.coalesce("n_spans", none).alias("n_spans"), F.coalesce("sha", "own").alias("kept_sha256"))
