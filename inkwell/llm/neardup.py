"""Near-duplicate documents: weighted MinHash by darts, banded, verified, grouped.

A document is the multiset of its five-word shingles (a shorter one: the single run of all
its words). Two documents are near duplicates if the weighted Jaccard similarity of their
multisets, sum of minima over sum of maxima, is 0.8 or more; groups are the connected
components. Documents without words are a group of their own each.

Signatures. An element of weight w owns w unit cells. Every cell is a strip along a rank
axis at which darts are thrown: the axis is cut into slabs, the number of darts of a (cell,
slab) is a Poisson number, and number, rank, coordinate and name of each dart are hashes of
(cell, slab), so equal cells get equal darts in every document. Each of the K coordinates
keeps its earliest dart. Slabs are thrown one after the other until all coordinates have
one; most cells get none, so a document costs few darts however long it is. Two documents
agree in a coordinate with the probability of their similarity.

Search. Documents with equal multisets are one class from the start (only one stands for
it). BANDS bands of ROWS coordinates are hashed to buckets; at similarity 0.8 a pair shares
none with probability (1 - 0.8**ROWS)**BANDS = 6e-5. Each bucket compares its most central
member, the one with the most company in all its buckets, with the others (no pairs within
the group). Where a bucket's members then lie in different components, pairs across them are
not given up: the numbers of a document's cells that one, a few, some or many documents of
such buckets have bound the similarity of a pair from above, and pairs that the bound lets
through are compared too.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from inkwell.llm.common import ODD, free_name, mix, quoted, shingles, small_batches, word_hashes, written
from inkwell.llm.components import components

SIMILARITY = 0.8
ROWS, BANDS = 6, 32
K = ROWS * BANDS
FIRST_SLAB, LAST_SLAB = 2.0**-8, 4.0
BLOCK = 1 << 20
FEW, SOME = 4, 32
STEP = "CAST(10000000000000000000 AS DECIMAL(20,0))"  # above any row number


def weighted_shingles(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes and their counts."""
    return np.unique(shingles(word_hashes(text)), return_counts=True)


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity; 0 if either is empty."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = int(np.minimum(a[1][i], b[1][j]).sum())
    total = int(a[1].sum() + b[1].sum()) - both
    return both / total if total else 0.0


def _cells(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One hash per unit cell: element and number of the copy."""
    copy = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    with np.errstate(over="ignore"):
        return mix(np.repeat(values, counts) + copy.astype(np.uint64) * ODD)


def _uniform(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(11)).astype(np.float64) * 2.0**-53


def _poisson(width: float) -> np.ndarray:
    """Cumulative probabilities of 0, 1, 2, ... darts in a slab."""
    p, out, total = np.exp(-width), [], 0.0
    for i in range(64):
        total += p
        out.append(total)
        p *= width / (i + 1)
    return np.array(out)


def signatures(bags: list[tuple[np.ndarray, np.ndarray]], k: int = K) -> np.ndarray:
    """Names of the earliest darts, one row of ``k`` per non-empty multiset."""
    cells = np.concatenate([_cells(*b) for b in bags]) if bags else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(bags)), [int(b[1].sum()) for b in bags])
    rank, name = np.full(len(bags) * k, np.inf), np.zeros(len(bags) * k, np.uint64)
    low, width, slab = 0.0, FIRST_SLAB, 0
    with np.errstate(over="ignore"):
        while len(cells):
            slab += 1
            salt = mix(np.array([slab], np.uint64))[0]
            chances = _poisson(width)
            for at in range(0, len(cells), BLOCK):
                c, o = cells[at : at + BLOCK], owner[at : at + BLOCK]
                u = _uniform(mix(c ^ salt))
                hit = np.flatnonzero(u >= chances[0])
                n = np.searchsorted(chances, u[hit], side="right")
                number = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                dart = mix(np.repeat(c[hit], n) * ODD + salt + number.astype(np.uint64))
                key = np.repeat(o[hit], n) * k + (mix(dart) % np.uint64(k)).astype(np.int64)
                r = low + width * _uniform(mix(dart ^ ODD))
                better = np.flatnonzero(r < rank[key])
                better = better[np.argsort(-r[better], kind="stable")]  # the earliest is written last
                rank[key[better]], name[key[better]] = r[better], dart[better]
            low += width
            width = low if low < LAST_SLAB else LAST_SLAB
            open_ = np.isinf(rank.reshape(-1, k)).any(1)
            if not open_.all():
                keep = open_[owner]
                cells, owner = cells[keep], owner[keep]
    return name.reshape(-1, k)


def bands(signature: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One hash per band of ``rows`` coordinates, different for each band."""
    n = signature.shape[1] // rows
    with np.errstate(over="ignore"):
        out = np.repeat(mix(np.arange(1, n + 1, dtype=np.uint64))[None], len(signature), 0)
        for i in range(rows):
            out = mix(out * ODD + signature[:, i : n * rows : rows])
    return out.view(np.int64)


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Row number, hash and size of the multiset and band hashes; nothing for empty ones."""
    for batch in batches:
        rows, texts = batch.column(0).to_pylist(), batch.column(1)
        at = 0
        while at < len(rows):
            bags, ids, digests, sizes, n = [], [], [], [], 0
            while at < len(rows) and n < BLOCK:  # long texts make smaller groups
                bag = weighted_shingles(texts[at].as_py())
                if len(bag[0]):
                    bags.append(bag)
                    ids.append(rows[at])
                    sizes.append(int(bag[1].sum()))
                    digests.append(hashlib.blake2b(bag[0].tobytes() + bag[1].tobytes(), digest_size=16).digest())
                n += int(bag[1].sum())
                at += 1
            if bags:
                found = bands(signatures(bags))
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(bags) + 1) * found.shape[1], pa.int32()), pa.array(found.ravel()))
                yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()), flat], ["row", "bag", "size", "bands"])


def _verify(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose texts are at least so similar. Only texts of candidates move after the first join."""

    def alike(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, bag = None, None
        for batch in batches:
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            keep = []
            for i in range(len(a)):
                if a[i] != last:  # pairs of one leader follow each other
                    last, bag = a[i], weighted_shingles(batch.column(2)[i].as_py())
                if similarity(bag, weighted_shingles(batch.column(3)[i].as_py())) >= least:
                    keep.append(i)
            yield pa.record_batch([pa.array([a[i] for i in keep], pa.int64()), pa.array([b[i] for i in keep], pa.int64())], ["a", "b"])

    first = pairs.join(texts.select(F.col("row").alias("b"), F.col("text").alias("text_b")), "b")
    both = first.join(texts.select(F.col("row").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInArrow(alike, "a long, b long")


def _tiers(texts: DataFrame, rows: DataFrame) -> DataFrame:
    """(rep, own, few, some): unit cells that 1, 2 to FEW and up to SOME of the ``rows`` (rep) have.

    Cells of more rows are never joined back, so no cell gathers many of them.
    """

    def cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, row in enumerate(batch.column(0).to_pylist()):
                found = _cells(*weighted_shingles(batch.column(1)[i].as_py()))
                for at in range(0, len(found), BLOCK):
                    part = found[at : at + BLOCK]
                    yield pa.record_batch([pa.array(part.view(np.int64)), pa.array(np.full(len(part), row))], ["cell", "rep"])

    named = rows.join(texts.select(F.col("row").alias("rep"), "text"), "rep").select("rep", "text")
    found = written(named.mapInArrow(cells, "cell long, rep long"), "cells")
    seen = found.groupBy("cell").agg(F.count("*").alias("n"), F.min("rep").alias("rep"))
    own = seen.where("n = 1").groupBy("rep").agg(F.count("*").alias("own"))
    shared = found.join(seen.where((F.col("n") > 1) & (F.col("n") <= SOME)).select("cell", "n"), "cell")
    few = (F.col("n") <= FEW).cast("long")
    counts = shared.groupBy("rep").agg(F.sum(few).alias("few"), F.sum(1 - few).alias("some"))
    return own.join(counts, "rep", "full")


def near_groups(texts: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """(row, root) for each row of ``texts`` (row long unique, text); root is the group's smallest row."""
    small_batches(texts.sparkSession)
    signed = written(texts.select("row", "text").mapInArrow(_signed, "row long, bag binary, size long, bands array<long>"), "signed")
    # equal multisets have equal sizes and bands
    classes = signed.groupBy("bag").agg(F.min("row").alias("rep"), F.any_value("size").alias("size"), F.any_value("bands").alias("bands"))
    classes = written(classes, "classes")
    spread = classes.select("rep", F.explode("bands").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    buckets = written(spread.join(shared, "bucket"), "buckets")
    central = buckets.groupBy("rep").agg(F.sum("n").alias("company"))
    packed = F.col("company").cast("decimal(19,0)") * F.expr(STEP) + F.col("rep")
    heads = buckets.join(central, "rep").groupBy("bucket").agg(F.max(packed.cast("decimal(38,0)")).alias("head"))
    heads = heads.select("bucket", (F.col("head") % F.expr(STEP)).cast("long").alias("a"))
    tried = buckets.join(heads, "bucket").where("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    tried = written(tried, "pairs")
    links = written(_verify(tried, texts, least), "links")
    roots = components(links)
    # buckets that still hold several components
    now = buckets.select("bucket", "rep").join(roots, F.col("rep") == F.col("node"), "left").select("bucket", "rep", F.coalesce("root", "rep").alias("root"))
    mixed = now.groupBy("bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("n")).where("low <> high and n > 2").select("bucket")
    now = written(now.join(mixed, "bucket"), "mixed")
    if not now.isEmpty():
        tiers = _tiers(texts, now.select("rep").distinct())
        zero = F.lit(0).cast("long")
        bound = classes.select("rep", "size").join(tiers, "rep", "left").select("rep", "size", *(F.coalesce(c, zero).alias(c) for c in ("own", "few", "some")))
        bound = bound.withColumn("many", F.col("size") - F.col("own") - F.col("few") - F.col("some"))
        one = now.join(bound.where(F.col("size") - F.col("own") >= F.lit(least - 1e-9) * F.col("size")), "rep")
        two = one.select("bucket", *(F.col(c).alias(f"{c}_2") for c in ("rep", "root", "size", "few", "some", "many")))
        # documents share at most the smaller number of each tier
        most = F.least("few", "few_2") + F.least("some", "some_2") + F.least("many", "many_2")
        near = most >= F.lit(least - 1e-9) * (F.col("size") + F.col("size_2") - most)
        match = (one["bucket"] == two["bucket"]) & (F.col("rep") < F.col("rep_2")) & (F.col("root") != F.col("root_2")) & near
        fresh = one.join(two, match).select(F.col("rep").alias("a"), F.col("rep_2").alias("b")).distinct()
        fresh = written(fresh.join(tried.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), "pairs")
        found = written(_verify(fresh, texts, least), "links")
        if not found.isEmpty():
            roots = components(links.union(found))
    settled = classes.select("bag", "rep").join(roots, F.col("rep") == F.col("node"), "left").select("bag", F.coalesce("root", "rep").alias("root"))
    grouped = signed.select("row", "bag").join(settled, "bag").select("row", "root")
    return texts.select("row").join(grouped, "row", "left").select("row", F.coalesce("root", "row").alias("root"))


def numbered(docs: DataFrame) -> tuple[DataFrame, str]:
    """A written copy with a unique row number, and that column's name."""
    small_batches(docs.sparkSession)
    row = free_name(docs, "row")
    return written(docs.withColumn(row, F.monotonically_increasing_id()), "rows"), row


def neardup_query(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id, kept of each document.

    ``class_id`` is the doc_id of the one row of the group that stays (the first in the
    table), ``kept`` marks it. Repeated rows are copies. A row without words is a class of
    its own; a null doc_id is allowed and gives a null class_id where that row stays.
    """
    rows, row = numbered(docs.select("doc_id", "text"))
    groups = written(near_groups(rows.select(F.col(row).alias("row"), "text"), least), "groups")
    ids = rows.select(F.col(row).alias("row"), "doc_id")
    roots = ids.select(F.col("row").alias("root"), F.col("doc_id").alias("class_id"))
    out = ids.join(groups, "row").join(roots, "root")
    return out.select("doc_id", "class_id", (F.col("row") == F.col("root")).alias("kept"))


def keep_first(docs: DataFrame, least: float = SIMILARITY) -> DataFrame:
    """The documents with one row of each group, their columns unchanged."""
    rows, row = numbered(docs)
    text = rows.select(quoted(row).alias("row"), "text")
    gone = near_groups(text, least).where("row <> root").select(F.col("row").alias(row))
    return rows.join(gone, row, "left_anti").select(*map(quoted, docs.columns))
