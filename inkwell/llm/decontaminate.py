"""Benchmark decontamination: SimHash of item-sized windows, then exact similarity.

A document is contaminated by an item of n words if a window of n of its words (the whole
document, if shorter) has a weighted Jaccard similarity of 0.8 or more with the item, both
as multisets of five-word shingles (items of fewer words: the single run of all words).

* Of each item's shingles the rarest of its block are its probes, so many that the others
  are fewer than any similar window must share. Only items with a probe in the document are
  looked at further: wording that many items share brings up none of them.
* Windows are laid where the document has enough shingles of the item for the similarity, at
  starts between the first and last alignment of each stretch of such places. Alignments of
  two shingles in one window differ by less than twice its length (parts of the item may
  stand in another order), so stretches end where they differ by more.
* A window's fingerprint is the 64-bit SimHash of its shingles by their counts. Eight
  blocks of eight bits index the items' fingerprints: two fingerprints within RADIUS = 23
  differ by at most two bits in one block, so looking up all values within two bits in each
  block finds every item within the radius. At similarity 0.8 the distance has mean 9.7 and
  deviation 2.9. An entry of the index is a row of marks, one per item, and a window reads the
  marks of the items it was laid for.
* Candidates within the radius are verified by their exact similarity.

Items go to the tasks in blocks of bounded size; further blocks are further passes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cached_property
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from inkwell.llm.common import SHINGLE, mix, shingles, small_batches, word_hashes

SIMILARITY = 0.8
RADIUS = 23
BLOCK_ITEMS = 20_000
BLOCK_CHARS = 8_000_000
_SALT = np.uint64(0x5BD1E995C2B2AE35)
PAIRS = 1 << 18  # windows and items compared at once
SPAN = 1 << 16  # words whose votes are summed at once, more for a longer window


def _votes(values: np.ndarray) -> np.ndarray:
    """+1 or -1 per bit of each shingle, 64 columns."""
    bits = np.unpackbits(mix(values ^ _SALT).view(np.uint8).reshape(-1, 8), axis=1)
    return bits.astype(np.int32) * 2 - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    """Eight bytes of fingerprint per row of vote sums."""
    return np.packbits(sums > 0, axis=1)


def simhash(values: np.ndarray) -> np.ndarray:
    return _packed(_votes(values).sum(0, keepdims=True))[0]


def _likeness(a: np.ndarray, b: Bag) -> float:
    values, counts = np.unique(a, return_counts=True)
    _, i, j = np.intersect1d(values, b.values, assume_unique=True, return_indices=True)
    both = int(np.minimum(counts[i], b.counts[j]).sum())
    return both / (len(a) + b.total - both)


def _ranges(low: np.ndarray, n: np.ndarray) -> np.ndarray:
    """low[0], low[0] + 1, ... (n[0] numbers), then those from low[1] and so on."""
    return np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())


class Bag(NamedTuple):
    """Shingles of an item with their counts, first and last places."""

    values: np.ndarray
    counts: np.ndarray
    first: np.ndarray
    last: np.ndarray
    size: int  # words of a shingle

    @property
    def total(self) -> int:
        return int(self.counts.sum())


def _bag(words: np.ndarray) -> Bag:
    s = shingles(words)
    values, first, counts = np.unique(s, return_index=True, return_counts=True)
    back = np.unique(s[::-1], return_index=True)[1]
    return Bag(values, counts, first, len(s) - 1 - back, min(SHINGLE, len(words)))


class Items:
    """A block of benchmark items with its indexes; travels to the tasks as words only.

    Items of the same words are one item with several ids.
    """

    def __init__(self, items: list[tuple], least: float = SIMILARITY) -> None:
        alike: dict[bytes, tuple[list, np.ndarray]] = {}
        for i, text in items:
            words = word_hashes(text)
            if len(words):
                alike.setdefault(words.tobytes(), ([], words))[0].append(i)
        self.ids = [ids for ids, _ in alike.values()]
        self.words = [words for _, words in alike.values()]
        self.least = least

    def __getstate__(self) -> dict:
        return {k: self.__dict__[k] for k in ("ids", "words", "least")}

    @cached_property
    def bags(self) -> list[Bag]:
        return [_bag(w) for w in self.words]

    @cached_property
    def probes(self) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By shingle size: sorted probes with their item. A similar window shares one with it."""
        used, n_items = np.unique(np.concatenate([b.values for b in self.bags]), return_counts=True)
        out: dict[int, list] = {}
        for i, bag in enumerate(self.bags):
            rare = np.argsort(n_items[np.searchsorted(used, bag.values)], kind="stable")
            spare = bag.total - self._shared(bag, None) + 1
            mine = bag.values[rare[: np.searchsorted(np.cumsum(bag.counts[rare]), spare) + 1]]
            out.setdefault(bag.size, []).append((mine, np.full(len(mine), i)))
        joined = {size: [np.concatenate(x) for x in zip(*parts, strict=True)] for size, parts in out.items()}
        return {size: tuple(x[np.argsort(v[0], kind="stable")] for x in v) for size, v in joined.items()}

    def _shared(self, bag: Bag, per: int | None) -> int:
        """Shingles that a similar window of ``per`` shingles (None: any number) shares with an item."""
        both = bag.total if per is None else (per + bag.total) / (1 + self.least)
        return max(1, math.ceil(self.least * both - 1e-6))

    @cached_property
    def prints(self) -> np.ndarray:
        return np.array([simhash(shingles(w)) for w in self.words], np.uint8).reshape(-1, 8)

    @cached_property
    def blocks(self) -> np.ndarray:
        """[byte of a fingerprint, its value]: marks of the items whose byte is within two bits of it."""
        values = np.arange(256, dtype=np.uint8)
        return np.stack([np.bitwise_count(values[:, None] ^ self.prints[None, :, j]) <= 2 for j in range(8)])

    def within(self, fingerprint: np.ndarray) -> np.ndarray:
        """Items whose fingerprint is within RADIUS."""
        who = np.arange(len(self.words))
        return who[self._near(np.repeat(fingerprint[None, :], len(who), 0), who)]

    def _near(self, prints: np.ndarray, who: np.ndarray) -> np.ndarray:
        """Which of the pairs of a fingerprint and an item the index finds and the radius keeps."""
        found = np.zeros(len(who), bool)
        for j in range(8):
            found |= self.blocks[j][prints[:, j], who]
        at = np.flatnonzero(found)
        found[at] = np.bitwise_count(prints[at] ^ self.prints[who[at]]).sum(1) <= RADIUS
        return found

    def _active(self, s: np.ndarray, size: int) -> np.ndarray:
        """Items with a probe among the shingles of a document."""
        keys, who = self.probes[size]
        held = np.unique(s[keys[np.minimum(np.searchsorted(keys, s), len(keys) - 1)] == s])
        low = np.searchsorted(keys, held)
        return np.unique(who[_ranges(low, np.searchsorted(keys, held, side="right") - low)])

    def _starts(self, bag: Bag, order: np.ndarray, ordered: np.ndarray, length: int) -> np.ndarray:
        """Starts of the windows to look at for an item; ``ordered`` are the document's shingles as ``order`` sorts them."""
        per, none = length - bag.size + 1, np.empty(0, np.int64)
        need, final = self._shared(bag, per), len(ordered) - per
        low = np.searchsorted(ordered, bag.values)
        n = np.searchsorted(ordered, bag.values, side="right") - low
        if np.minimum(n, bag.counts).sum() < need:
            return none
        hits, which = order[_ranges(low, n)], np.repeat(np.arange(len(n)), n)
        by = np.argsort(hits)
        hits, which = hits[by], which[by]
        # starts whose window holds ``need`` hits: from the last of so many back, up to the first
        a, b = hits[need - 1 :] - per + 1, hits[: len(hits) - need + 1]
        a, b = np.maximum(a[a <= b], 0), np.minimum(b[a <= b], final)
        if not len(a):
            return none
        a[1:] = np.maximum(a[1:], b[:-1] + 1)
        starts = _ranges(a, np.maximum(b - a + 1, 0))
        # of these the ones between alignments: a window beyond them only gains by moving there
        low, high = hits - bag.last[which], hits - bag.first[which]
        by = np.argsort(low)
        low, high = low[by], np.maximum.accumulate(high[by])
        cut = np.flatnonzero(low[1:] - high[:-1] >= 2 * length)
        left, right = np.clip(low[np.r_[0, cut + 1]], 0, final), np.clip(high[np.r_[cut, -1]], 0, final)
        at = np.searchsorted(left, starts, side="right") - 1
        return starts[(at >= 0) & (starts <= right[at])]

    def _fingerprints(self, s: np.ndarray, starts: np.ndarray, per: int) -> np.ndarray:
        """SimHash of the windows of ``per`` shingles at sorted starts, by running sums of votes."""
        out = np.empty((len(starts), 8), np.uint8)
        far = (np.diff(starts) > per) | (np.diff(starts // max(SPAN, per)) > 0)
        for part in np.split(np.arange(len(starts)), np.flatnonzero(far) + 1):
            run = starts[part]
            sums = np.zeros((run[-1] + per - run[0] + 1, 64), np.int32)
            np.cumsum(_votes(s[run[0] : run[-1] + per]), axis=0, out=sums[1:])
            out[part] = _packed(sums[run - run[0] + per] - sums[run - run[0]])
        return out

    def _settle(self, s: np.ndarray, per: int, laid: list[tuple[int, np.ndarray]], best: dict) -> None:
        """Compare windows with the items they were laid for; better ones replace those in ``best``."""
        starts = np.concatenate([x for _, x in laid])
        who = np.repeat([i for i, _ in laid], [len(x) for _, x in laid])
        windows, at = np.unique(starts, return_inverse=True)
        near = self._near(self._fingerprints(s, windows, per)[at], who)
        for start, i in zip(starts[near].tolist(), who[near].tolist(), strict=True):
            if best.get(i, (0.0,))[0] < 1:
                like = _likeness(s[start : start + per], self.bags[i])
                if like >= self.least and like > best.get(i, (0.0,))[0]:
                    best[i] = (like, start)

    def matches(self, text: str | None, any_item: bool = False) -> list[tuple[int, float, int, int]]:
        """(item number, similarity, first word, words) of the best window for each item that contaminates.

        With ``any_item`` it may stop at the first items found. Ties go to the first start.
        """
        words = word_hashes(text)
        if not len(words) or not self.words:
            return []
        best: dict[int, tuple[float, int]] = {}
        for size in self.probes:
            if len(words) < size:
                continue
            s = shingles(words, size)
            active = self._active(s, size)
            if not len(active):
                continue
            order = np.argsort(s, kind="stable")
            ordered = s[order]
            laid: dict[int, list[tuple[int, np.ndarray]]] = {}
            pairs = 0
            for n, i in enumerate(active.tolist()):
                length = min(len(self.words[i]), len(words))
                starts = self._starts(self.bags[i], order, ordered, length)
                if len(starts):
                    laid.setdefault(length - size + 1, []).append((i, starts))
                    pairs += len(starts)
                if pairs > PAIRS or n == len(active) - 1:
                    for per, group in laid.items():
                        self._settle(s, per, group, best)
                    laid, pairs = {}, 0
                    if any_item and best:
                        break
            if any_item and best:
                break
        return [(i, *best[i], min(len(self.words[i]), len(words))) for i in sorted(best)]


def item_blocks(benchmark: DataFrame, least: float = SIMILARITY) -> Iterator[Items]:
    """All items in blocks whose size is bounded on average by BLOCK_ITEMS rows and BLOCK_CHARS characters."""
    rows = benchmark.select("item_id", "text").where("text is not null").distinct()
    n, chars = rows.agg(F.count("*"), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    blocks = max(1, -(-n // BLOCK_ITEMS), -(-chars // BLOCK_CHARS))
    for b in range(blocks if n else 0):
        part = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).orderBy("item_id", "text")
        yield Items([tuple(r) for r in part.collect()], least)


def decontamination_query(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, item_id, similarity, first_word, n_words of each contaminated document and item.

    Null or wordless documents and items match nothing; equal items each match; a repeated
    document row is reported as often as it occurs.
    """
    small_batches(docs.sparkSession)
    fields = [docs.schema["doc_id"], benchmark.schema["item_id"]]
    schema = T.StructType([*fields, T.StructField("similarity", T.DoubleType()), T.StructField("first_word", T.LongType()), T.StructField("n_words", T.LongType())])
    out = None
    for items in item_blocks(benchmark, least):

        def found(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            kind = None
            for batch in batches:
                kind = batch.schema.field(0).type
                texts = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)
                rows = [(d, i, *m[1:]) for d, t in texts for m in items.matches(t) for i in items.ids[m[0]]]
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                types = [kind, pa.int64(), pa.float64(), pa.int64(), pa.int64()]
                yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=schema.names)

        part = docs.select("doc_id", "text").mapInArrow(found, schema)
        out = part if out is None else out.union(part)
    return out if out is not None else docs.sparkSession.createDataFrame([], schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The documents no item contaminates, with their own columns; one pass per block of items."""
    small_batches(docs.sparkSession)
    at = docs.columns.index("text")
    for items in item_blocks(benchmark, least):

        def clean(batches: Iterator[pa.RecordBatch], items: Items = items) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array([not items.matches(t, any_item=True) for t in batch.column(at).to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
