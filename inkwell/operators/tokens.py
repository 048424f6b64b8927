"""Splitting text into chunks of at most so many tokens of a byte-pair vocabulary.

Rules:

1. The pattern of the vocabulary cuts a text into pieces, which are encoded apart. A piece
   of more than ``budget`` tokens is cut into parts of at most ``budget`` bytes, at
   characters; the end of a part always ends a window.
2. A window takes whole pieces while their tokens stay within the budget. It ends after its
   last piece that ends in a terminator beyond ``min_chars`` characters, if more text
   follows and there is one; otherwise it is the full window. (Two pieces of blanks at its
   end count as the one they are then; where that is more than the budget it ends earlier.)
3. Blank windows are skipped; every other one is a chunk. Chunks keep their blanks, because
   trimming would change their tokens.

Other pieces are the same when the window is encoded by itself, so ``n_tokens`` is what
the tokenizer counts for the chunk, no chunk exceeds the budget and windows concatenate
to the text. Work is linear in the text but for the merging of a single piece, which
takes n log n. The text is never shuffled.
"""

from __future__ import annotations

import base64
import heapq
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from inkwell.operators.chunks import TERMINATORS

# Fixed value: how byte-level vocabularies of this kind cut text into pieces.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MAX_VOCABULARY_BYTES = 64 << 20
LEAST_BUDGET = 4  # bytes of a character
CACHED_PIECES = 100_000
CACHED_LENGTH = 32
NO_RANK = 1 << 62
BATCH_BYTES = 2 << 20
_BLANK = "".join(map(chr, range(0x21)))
_SPACES = np.array([chr(i).isspace() for i in range(0x3002)])


def read_vocabulary(spark: SparkSession, path: str) -> bytes:
    """A rank file (base64 token and rank per line) from any file system Spark reads; its size is checked first."""
    rows = spark.read.format("binaryFile").load(path)
    sizes = rows.select("length").collect()
    if len(sizes) != 1 or sizes[0][0] > MAX_VOCABULARY_BYTES:
        raise ValueError(f"{path} is not a single file of at most {MAX_VOCABULARY_BYTES} bytes")
    return bytes(rows.select("content").first()[0])


class _Counts(dict):
    """piece -> tokens; short pieces are kept, those not seen since CACHED_PIECES others came are forgotten."""

    def __init__(self, encode: Callable[[str], list[int]]) -> None:
        self.encode = encode
        self.earlier: dict[str, int] = {}

    def __missing__(self, piece: str) -> int:
        if len(piece) > CACHED_LENGTH:
            return len(self.encode(piece))
        n = self.earlier.get(piece)
        if n is None:
            n = len(self.encode(piece))
        if len(self) >= CACHED_PIECES:
            self.earlier = dict(self)
            self.clear()
        self[piece] = n
        return n


class BytePairs:
    """Tokens of a piece by merging the neighbours of lowest rank first, leftmost among equals."""

    def __init__(self, vocabulary: bytes, pattern: str = PATTERN) -> None:
        import regex

        lines = (line.split() for line in vocabulary.splitlines() if line)
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in lines}
        if any(bytes([b]) not in self.ranks for b in range(256)):
            raise ValueError("the vocabulary lacks single bytes")
        self.pieces = regex.compile(pattern)
        self.blank = regex.compile(r"\s+").fullmatch
        self.known = _Counts(self.encode)

    def encode(self, piece: str) -> list[int]:
        """Ids of one piece; a heap of pairs over a linked list of parts."""
        data, ranks = piece.encode("utf-8", "surrogatepass"), self.ranks
        if data in ranks:
            return [ranks[data]]
        size = len(data)
        if size <= CACHED_LENGTH:
            return self._encode_short(data)
        end = list(range(1, size + 1))  # where the part that starts here ends; 0: merged away
        before = list(range(-1, size - 1))
        heap = [(r, i, i + 2) for i in range(size - 1) if (r := ranks.get(data[i : i + 2])) is not None]
        heapq.heapify(heap)

        def offer(left: int) -> None:
            right = end[left]
            if right < size and (rank := ranks.get(data[left : end[right]])) is not None:
                heapq.heappush(heap, (rank, left, end[right]))

        while heap:
            _, left, stop = heapq.heappop(heap)
            right = end[left]
            if not right or right >= size or end[right] != stop:
                continue  # one of the two has been merged since
            end[left], end[right] = stop, 0
            if stop < size:
                before[stop] = left
            offer(left)
            if before[left] >= 0:
                offer(before[left])
        ids, at = [], 0
        while at < size:
            ids.append(ranks[data[at : end[at]]])
            at = end[at]
        return ids

    def _encode_short(self, data: bytes) -> list[int]:
        """The same for few parts, where looking at all is faster than a heap."""
        rank = self.ranks.get
        parts = [data[i : i + 1] for i in range(len(data))]
        pairs = [rank(data[i : i + 2], NO_RANK) for i in range(len(data) - 1)]
        while pairs and (least := min(pairs)) < NO_RANK:
            i = pairs.index(least)
            parts[i] += parts.pop(i + 1)
            del pairs[i]
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], NO_RANK)
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], NO_RANK)
        return [self.ranks[p] for p in parts]

    def count(self, piece: str) -> int:
        return self.known[piece]

    def cut(self, text: str, budget: int) -> tuple[list[str], np.ndarray, list[int]]:
        """Pieces and parts of pieces, their tokens, and the numbers of those behind which a window has to end."""
        pieces = self.pieces.findall(text) if not self.pieces.groups else [m[0] for m in self.pieces.finditer(text)]
        if sum(map(len, pieces)) < len(text):  # a pattern of the caller may leave gaps
            pieces, at = [], 0
            for m in self.pieces.finditer(text):
                start, stop = m.span()
                pieces += [x for x in (text[at:start], m[0]) if x]
                at = stop
            pieces += [text[at:]] if at < len(text) else []
        counts = np.fromiter(map(self.known.__getitem__, pieces), np.int64, len(pieces))
        large = np.flatnonzero(counts > budget).tolist()
        if not large:
            return pieces, counts, []
        out: list[str] = []
        ends = []
        for low, i in zip([0, *(i + 1 for i in large)], [*large, len(pieces)], strict=True):
            out += pieces[low:i]
            if i < len(pieces):
                for part in self._parts(pieces[i], budget):
                    ends.append(len(out))
                    out.append(part)
        return out, np.fromiter(map(self.known.__getitem__, out), np.int64, len(out)), ends

    def _parts(self, piece: str, budget: int) -> Iterator[str]:
        low = used = 0
        for i, c in enumerate(piece):
            width = 1 if c < "\x80" else 2 if c < "\u0800" else 3 if c < "\U00010000" else 4
            if used + width > budget:
                yield piece[low:i]
                low, used = i, 0
            used += width
        yield piece[low:]

    def windows(self, text: str, budget: int, min_chars: int, terminators: str = TERMINATORS) -> Iterator[tuple[str, int]]:
        """(window, tokens) in order; together they are the text. Ends are found in running sums, not piece by piece."""
        pieces, counts, ends = self.cut(text, budget)
        n = len(pieces)
        if not n:
            return
        tokens = np.concatenate(([0], np.cumsum(counts)))
        chars = np.concatenate(([0], np.cumsum(np.fromiter(map(len, pieces), np.int64, n))))
        last = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)[chars[1:] - 1]
        blank = [i for i in np.flatnonzero(_SPACES[np.minimum(last, len(_SPACES) - 1)]).tolist() if self.blank(pieces[i])]
        # the last blank of a run is a piece of its own only while something follows: tokens of a window that ends there
        pairs = {b + 1: self.count(pieces[a] + pieces[b]) - int(counts[a] + counts[b]) for a, b in pairwise(blank) if b == a + 1}
        closing = np.flatnonzero(np.logical_or.reduce([last == ord(c) for c in terminators])) + 1
        stops = [e + 1 for e in ends]
        if not stops or stops[-1] < n:
            stops.append(n)
        low, forced = 0, 0
        while low < n:
            stop = stops[forced]  # where the window has to end at the latest
            full = int(np.searchsorted(tokens, tokens[low] + budget, "right")) - 1
            high = min(full, stop)

            def own(end: int, low: int = low) -> int:
                return int(tokens[end] - tokens[low]) + (pairs.get(end, 0) if end - low > 1 else 0)

            end = 0
            if full < stop:
                first = int(np.searchsorted(chars, chars[low] + min_chars, "right"))
                k = int(np.searchsorted(closing, high, "right")) - 1
                while k >= 0 and (e := int(closing[k])) > low and e >= first:
                    if own(e) <= budget:
                        end = e
                        break
                    k -= 1
            if not end:
                end = high
                while own(end) > budget:
                    end -= 1
            yield text[chars[low] : chars[end]], own(end)
            low = end
            if low == stop:
                forced += 1


@lru_cache(maxsize=4)
def _encoder(vocabulary: bytes, pattern: str) -> BytePairs:
    return BytePairs(vocabulary, pattern)


def chunk_by_tokens(df: DataFrame, text: str, keep: list[str], vocabulary: bytes, budget: int, min_chars: int = 0,
                    pattern: str = PATTERN, terminators: str = TERMINATORS) -> DataFrame:
    """One row per chunk: ``keep`` columns, chunk_no, n_chunks, chunk, n_tokens.

    NULL, empty and blank texts give nothing; repeated rows are chunked each. ``vocabulary``
    (see :func:`read_vocabulary`) is broadcast, its size is bounded there.
    """
    if budget < LEAST_BUDGET:
        raise ValueError(f"a budget has at least {LEAST_BUDGET} tokens")
    if not terminators:
        terminators = "\0\0"  # equals no single character
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    made = ["chunk_no", "n_chunks", "chunk", "n_tokens"]
    schema = T.StructType([*df.select(*keep).schema.fields, *T._parse_datatype_string("chunk_no int, n_chunks int, chunk string, n_tokens int").fields])

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(shared.value, pattern)
        for batch in batches:
            rows, chunks = [], []
            size = 0
            last = batch.num_rows - 1
            for row, value in enumerate(x.as_py() for x in batch.column(batch.num_columns - 1)):
                found = [(w, n) for w, n in encoder.windows(value or "", budget, min_chars, terminators) if w.strip(_BLANK)]
                rows += [row] * len(found)
                chunks += [(i, len(found), *w) for i, w in enumerate(found, 1)]
                size += len(value or "")
                if rows and (size > BATCH_BYTES or row == last):
                    columns = [c.take(pa.array(rows, pa.int64())) for c in batch.columns[:-1]]
                    types = [pa.int32(), pa.int32(), pa.string(), pa.int32()]
                    columns += [pa.array(c, t) for c, t in zip(zip(*chunks, strict=True), types, strict=True)]
                    yield pa.RecordBatch.from_arrays(columns, names=[*keep, *made])
                    rows, chunks, size = [], [], 0

    return df.select(*keep, F.col(text).alias("_text")).mapInArrow(emit, schema)
