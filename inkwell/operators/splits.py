"""Chunks of plain text files of any size, read by byte ranges.

A window's start depends on where the window before it ended, so a file cannot simply be
cut. But a window that starts in a range ends within ``budget`` characters behind it, so
all that a range needs to know is at which of its first ``budget`` characters the first
window of its own starts. Three steps:

1. Each range is folded to a table: entry offset -> entry offset of the next range, and
   the number of chunks between. It reads ``budget`` characters beyond its end.
2. The tables are composed, FAN neighbours at a time, until a file has at most FAN; these
   are followed in order from the file's start, and the offsets handed down again.
3. Each range is read again and emits the windows that start in it, with their numbers.

So the chunks equal those of the whole text (:mod:`inkwell.operators.chunks`), whatever the
size of the ranges. A range owns the characters whose first byte lies in it. No row holds
more than a range's table, eight bytes and four per character of ``budget``.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from inkwell.operators.chunks import TERMINATORS, ChunkParams

Stage = Callable[[DataFrame, str], DataFrame]

SPLIT_BYTES = 4 << 20
FAN = 256
WIDEST = 4  # bytes of a character
BATCH_BYTES = 4 << 20
ROW_BYTES = 200  # of a row besides its table or text
BLANK = "".join(map(chr, range(0x21)))
MARKS = {b"\xef\xbb\xbf": "utf-8", b"\xff\xfe": "utf-16-le", b"\xfe\xff": "utf-16-be"}
ONE_BYTE = {
    "iso-8859-1": "".join(map(chr, range(256))),
    # the five bytes that windows-1252 does not use stay control characters
    "windows-1252": "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in range(256)),
}
CHUNKS = "path string, chunk_no long, n_chunks long, text string"


class Part(NamedTuple):
    """Characters of a range, of which the first ``own`` are its own, and some behind it."""

    text: str
    own: int


def _read(f, low: int, high: int) -> bytes:
    f.seek(low)
    return f.read(high - low)


def _continues(data: bytes) -> int:
    """Continuation bytes of UTF-8 at the start."""
    n = 0
    while n < len(data) and n < WIDEST and data[n] & 0xC0 == 0x80:
        n += 1
    return n


def _part(f, size: int, low: int, high: int, ahead: int, encoding: str | None) -> Part | None:
    """A range in its encoding (None: by byte order mark, else UTF-8); None if it is no valid UTF-8."""
    head = _read(f, 0, 3)
    mark, marked = next(((m, e) for m, e in MARKS.items() if head.startswith(m)), (b"", "utf-8"))
    if encoding in ONE_BYTE:
        # a file that is taken by the byte keeps its mark, as it has none that is known
        text = _read(f, low, min(size, high + ahead)).decode("iso-8859-1").translate(dict(enumerate(ONE_BYTE[encoding])))
        return Part(text, min(high, size) - low)
    low = max(low, len(mark))
    high = max(low, high)
    end = min(size, high + WIDEST * (ahead + 1))
    if marked != "utf-8":
        data = _read(f, low - 2, end)
        before, data = data[:2], data[2:]
        little = marked == "utf-16-le"
        lead = lambda x: len(x) == 2 and x[little] & 0xFC == 0xD8
        tail = lambda x: len(x) == 2 and x[little] & 0xFC == 0xDC
        skip = 2 if low > len(mark) and lead(before) and tail(data[:2]) else 0
        cut = high - low
        cut += 2 if lead(data[cut - 2 : cut]) and tail(data[cut : cut + 2]) and cut >= 2 else 0
        own = data[min(skip, cut) : cut].decode(marked, "replace")
        return Part(own + data[cut:].decode(marked, "replace"), len(own))
    data = _read(f, low, end)
    skip = _continues(data) if low > len(mark) else 0
    cut = high - low + _continues(data[high - low :])
    if skip == WIDEST or cut - (high - low) == WIDEST:
        return None
    try:
        own = data[min(skip, cut) : cut].decode("utf-8")
    except UnicodeDecodeError:
        return None
    return Part(own + data[cut:].decode("utf-8", "replace"), len(own))


def _next(part: Part, p: ChunkParams, terminators: str) -> tuple[np.ndarray, np.ndarray]:
    """For a window at each own character: where the next one starts, and whether this one is a chunk."""
    points = np.frombuffer(part.text.encode("utf-32-le", "surrogatepass"), np.uint32)
    at = np.arange(part.own, dtype=np.int32)
    end = np.minimum(at + p.budget, len(points)).astype(np.int32)
    solid = np.concatenate([[0], np.cumsum(points > 32, dtype=np.int32)]).astype(np.int32)
    filled = solid[end] > solid[: part.own]
    stops = np.isin(points, [ord(c) for c in terminators])
    last = np.maximum.accumulate(np.where(stops, np.arange(len(points), dtype=np.int32), np.int32(-1)))[end - 1]
    follow = np.where(filled & (last - at > p.min_chars), last + 1, end)
    return follow, solid[follow] > solid[: part.own]


def _fold(part: Part, p: ChunkParams, terminators: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Entry offset of the next range and number of chunks, for the first ``width`` entry offsets."""
    follow, filled = _next(part, p, terminators) if part.own else (np.empty(0, np.int32), np.empty(0, bool))
    own = part.own
    out = np.arange(-own, p.budget, dtype=np.int32)  # what lies behind the range is passed on
    count = np.zeros(own + p.budget, np.int64)
    step = min(p.min_chars + 1, p.budget)  # no window that is followed by another one in the range is shorter
    for high in range(own, 0, -step):
        here = slice(max(0, high - step), high)
        out[here] = out[follow[here]]
        count[here] = count[follow[here]] + filled[here]
    return out[:width], count[:width]


@lru_cache(maxsize=64)
def _store(root: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(root)


def _open(path: str):
    """The file of a path with or without scheme and host; the rest is a plain path, no URI, so blanks and % stand for themselves."""
    scheme, host, name = re.match(r"(?:([A-Za-z][\w+.-]*):)?(?://([^/]*))?(.*)", path, re.S).groups()
    store, prefix = _store(f"{scheme or 'file'}://{host or ''}/")
    return store.open_input_file(prefix.rstrip("/") + name)


def _walk(part: Part, at: int, p: ChunkParams, terminators: str) -> tuple[int, list[str]]:
    """Entry offset of the next range and the chunks of the windows that start in the range from ``at`` on."""
    found = []
    while at < part.own:
        window = part.text[at : at + p.budget]
        last = max((window.rfind(c) for c in terminators), default=-1)
        if last > p.min_chars and window.strip(BLANK):
            window = window[: last + 1]
        at += len(window)
        if chunk := window.strip(BLANK):
            found.append(chunk)
    return at - part.own, found


def _folded(ranges: DataFrame, p: ChunkParams, terminators: str) -> DataFrame:
    """path, n, valid, out, count, whole, alone of each range (path, length, n, low, high, encoding).

    ``whole`` are the chunks from entry 0, ``alone`` is a range that is the whole file.
    """

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["path", "n", "valid", "out", "count", "whole", "alone"]
        types = [pa.string(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.int64(), pa.bool_()]
        made, size = [], 0

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)], names=names)

        for batch in batches:
            for row in batch.to_pylist():
                with _open(row["path"]) as f:
                    part = _part(f, row["length"], row["low"], row["high"], p.budget, row["encoding"])
                if part is None:
                    out, count = np.empty(0, np.int32), np.zeros(1, np.int64)
                elif row["n"]:
                    out, count = _fold(part, p, terminators, p.budget)
                else:  # a file is entered at its start only
                    at, chunks = _walk(part, 0, p, terminators)
                    out, count = np.array([at], np.int32), np.array([len(chunks)], np.int64)
                made.append((row["path"], row["n"], part is not None, out.tobytes(), count.tobytes(), int(count[0]), row["high"] - row["low"] == row["length"]))
                size += out.nbytes + count.nbytes + ROW_BYTES
                if size >= BATCH_BYTES:
                    yield done()
                    made, size = [], 0
        if made:
            yield done()

    return ranges.mapInArrow(fold, "path string, n long, valid boolean, out binary, count binary, whole long, alone boolean")


def _ordered(rows: pd.DataFrame) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    rows = rows.sort_values("n")
    for n, out, count in zip(rows["n"], rows["out"], rows["count"], strict=True):
        yield int(n), np.frombuffer(out, np.int32), np.frombuffer(count, np.int64)


def _up(tables: DataFrame) -> DataFrame:
    """Tables of FAN neighbours composed to one."""

    def compose(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        at = total = None
        for _, out, count in _ordered(rows):
            at, total = (out, count) if at is None else (out[at], total + count[at])
        return pd.DataFrame({"path": [key[0]], "n": [key[1]], "out": [at.tobytes()], "count": [total.tobytes()], "whole": [int(total[0])]})

    group = F.floor(F.col("n") / FAN).cast("long").alias("g")
    return tables.groupBy("path", group).applyInPandas(compose, "path string, n long, out binary, count binary, whole long")


def _down(tables: DataFrame, starts: DataFrame) -> DataFrame:
    """path, n, entry, base, n_chunks of each table from those of its group."""

    def hand(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        entry, base, total = (int(rows[c].iloc[0]) for c in ("entry", "base", "n_chunks"))
        made = []
        for n, out, count in _ordered(rows):
            made.append((key[0], n, entry, base, total))
            entry, base = int(out[entry]), base + int(count[entry])
        return pd.DataFrame(made, columns=["path", "n", "entry", "base", "n_chunks"])

    grouped = tables.withColumn("g", F.floor(F.col("n") / FAN).cast("long"))
    joined = grouped.join(starts.withColumnRenamed("n", "g"), ["path", "g"])
    return joined.groupBy("path", "g").applyInPandas(hand, "path string, n long, entry long, base long, n_chunks long")


def _first(tables: DataFrame) -> DataFrame:
    """path, n, entry, base, n_chunks of at most FAN tables a file, from the file's start.

    Tables of a file meet in one task in order; no more than one row of each file is held with its table.
    """

    def follow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = ["path", "n", "entry", "base", "n_chunks"], [pa.string(), *[pa.int64()] * 4]
        path, entry, base, own, made = None, 0, 0, [], []
        for batch in batches:
            for i in range(batch.num_rows):
                here = batch.column(0)[i].as_py()
                if here != path:
                    made += [(*row, base) for row in own]
                    path, entry, base, own = here, 0, 0, []
                    if len(made) >= 10_000:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), kinds, strict=True)], names=names)
                        made = []
                own.append((path, batch.column(1)[i].as_py(), entry, base))
                out, count = np.frombuffer(batch.column(2)[i].as_py(), np.int32), np.frombuffer(batch.column(3)[i].as_py(), np.int64)
                entry, base = int(out[entry]), base + int(count[entry])
        made += [(*row, base) for row in own]
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), kinds, strict=True)], names=names)

    ordered = tables.select("path", "n", "out", "count").repartition("path").sortWithinPartitions("path", "n")
    return ordered.mapInArrow(follow, "path string, n long, entry long, base long, n_chunks long")


def _starts(tables: DataFrame, most: int, stage: Stage) -> DataFrame:
    zero = F.lit(0).cast("long")
    levels = [tables.where("not alone").drop("alone")]
    for _ in range(math.ceil(math.log(max(1, most), FAN)) - 1):
        levels.append(stage(_up(levels[-1]), "split-tables"))
    starts = reduce(lambda starts, tables: _down(tables, starts), reversed(levels[:-1]), _first(levels[-1]))
    alone = tables.where("alone").select("path", "n", zero.alias("entry"), zero.alias("base"), F.col("whole").alias("n_chunks"))
    return starts.unionByName(alone)


def _emitted(ranges: DataFrame, p: ChunkParams, terminators: str) -> DataFrame:
    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = [pa.string(), pa.int64(), pa.int64(), pa.string()]
        made, size = [], 0

        def done() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made, strict=True), types, strict=True)], names=["path", "chunk_no", "n_chunks", "text"])

        for batch in batches:
            for row in batch.to_pylist():
                with _open(row["path"]) as f:
                    part = _part(f, row["length"], row["low"], row["high"], p.budget, row["encoding"])
                for number, chunk in enumerate(_walk(part, row["entry"], p, terminators)[1], row["base"] + 1):
                    made.append((row["path"], number, row["n_chunks"], chunk))
                    size += len(chunk) + ROW_BYTES
                if size >= BATCH_BYTES:
                    yield done()
                    made, size = [], 0
        if made:
            yield done()

    return ranges.mapInArrow(emit, CHUNKS)


def byte_ranges(files: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """path, length, n, low, high: the ranges of each file, by its length alone."""
    if split_bytes <= 0 or split_bytes % WIDEST:
        raise ValueError(f"a range has a multiple of {WIDEST} bytes")
    lows = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split_bytes).cast("long"))
    cut = files.where("length > 0").select("path", "length", F.posexplode(lows).alias("n", "low"))
    return cut.select("path", "length", F.col("n").cast("long").alias("n"), "low", F.least("length", F.col("low") + split_bytes).alias("high"))


def chunk_files(files: DataFrame, p: ChunkParams, stage: Stage, split_bytes: int = SPLIT_BYTES,
                fallback: str | None = "windows-1252", terminators: str = TERMINATORS) -> DataFrame:
    """path, chunk_no, n_chunks, text of plain text files (path with or without ``scheme://host``, length in bytes).

    Encodings are found as for small files: a byte order mark, UTF-8 if the whole file is
    valid, else ``fallback``; with None such a file gives no chunk. ``stage`` writes a table
    and reads it back (``plans.process.staged``). A path given twice counts once; NULL and empty ones give nothing. ``max_chunks`` and ``min_len`` belong
    to whole texts and are refused.
    """
    if p.min_len or p.max_chunks is not None:
        raise ValueError("min_len and max_chunks need the whole text")
    if fallback is not None and fallback not in ONE_BYTE:
        raise ValueError(f"no table for {fallback}")
    files = stage(files.where("path is not null").groupBy("path").agg(F.max("length").alias("length")), "split-files")
    parts = F.ceil(F.col("length") / split_bytes)
    total, most, size = (x or 0 for x in files.agg(F.sum(parts), F.max(parts), F.sum("length")).first())
    ranges = byte_ranges(files, split_bytes)
    # a task for each SPLIT_BYTES, also where ranges are shorter; the rows themselves are too small for the planner to spread
    spread = max(1, min(total, max(files.sparkSession.sparkContext.defaultParallelism, size // SPLIT_BYTES), 100_000))
    found = stage(_folded(ranges.withColumn("encoding", F.lit(None).cast("string")).repartition(spread), p, terminators), "split-tables")
    invalid = stage(found.where("not valid").select("path").distinct(), "split-invalid")
    tables = found.join(invalid, "path", "left_anti")
    encodings = ranges.join(invalid, "path", "left_anti").withColumn("encoding", F.lit(None).cast("string"))
    if fallback is not None:
        by_byte = ranges.join(invalid, "path", "left_semi").withColumn("encoding", F.lit(fallback))
        tables = stage(tables.unionByName(_folded(by_byte.repartition(spread), p, terminators)), "split-tables")
        encodings = encodings.unionByName(by_byte)
    starts = stage(_starts(tables.drop("valid"), most, stage), "split-starts")
    return _emitted(encodings.join(starts, ["path", "n"]).repartition(spread), p, terminators)
