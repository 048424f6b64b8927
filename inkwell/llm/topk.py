"""Exact top-k by inner product in three phases with a uniform threshold.

A vector's score is the sum of PARTS partial scores, one per range of its components. Each
task is a node that holds the partial scores of its own rows.

1. Gather: per query and range a task takes its k best partial scores, resolves those rows'
   full scores and reports the k best. The k-th best of all reports is a cutoff that at
   least k rows reach.
2. Collect: the cutoff goes to all tasks. A row that reaches it has a partial score of at
   least cutoff / PARTS in some range, since smaller parts cannot add up to it; all rows
   with such a part are collected, in the task.
3. Resolve: the collected rows' scores are computed exactly, those below the cutoff dropped,
   and the k best of each task ranked together.

Components are whole numbers and scores exact: double-precision products are used while
sums stay below 2**53, big integers beyond (results then saturate at the limits of a long).
Queries go to the tasks in blocks of bounded size; each block is a pass of its own.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from inkwell.llm.common import small_batches, written

K = 5
PARTS = 2
QUERY_EVERY = 50
BLOCK_VALUES = 1 << 20
SCALE = 256.0
_LONG = np.iinfo(np.int64)


def whole_vectors(rows: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(id, v): ids and vectors that take part. Out: null ids, null vectors, null or non-finite components (also after scaling)."""
    v = F.transform(F.col(embedding), lambda x: x.cast("double"))
    fine = F.forall("v", lambda x: F.coalesce(F.abs(x * SCALE) < F.lit(float("inf")), F.lit(False)))
    return rows.select(F.col(vec_id).cast("long").alias("id"), v.alias("v")).where("id is not null and v is not null").where(fine)


def _matrix(vectors: pa.ListArray, keep: np.ndarray, width: int) -> np.ndarray:
    flat = vectors.take(pa.array(keep)).flatten().to_numpy(zero_copy_only=False)
    return np.floor(flat.astype(np.float64) * SCALE).reshape(len(keep), width)


def _partial(v: np.ndarray, q: np.ndarray) -> list[np.ndarray]:
    """Partial scores (rows by queries) of each range of components."""
    cuts = np.linspace(0, v.shape[1], PARTS + 1).astype(int)
    largest = np.abs(v).max(initial=0) * np.abs(q).max(initial=0) * max(1, v.shape[1])
    if largest < 2.0**53:
        return [(v[:, a:b] @ q[:, a:b].T).astype(np.int64) for a, b in zip(cuts, cuts[1:], strict=False)]
    whole = np.frompyfunc(int, 1, 1)
    v, q = whole(v).astype(object), whole(q).astype(object)
    return [np.array([[sum(x * y for x, y in zip(r[a:b], c[a:b], strict=True)) for c in q] for r in v], object).reshape(len(v), len(q)) for a, b in zip(cuts, cuts[1:], strict=False)]


class Block:
    """A block of queries by vector length, and their cutoffs once known."""

    def __init__(self, rows: list[tuple[int, list[float]]], k: int) -> None:
        self.k = k
        self.by_width: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for width in {len(v) for _, v in rows}:
            mine = [(i, v) for i, v in rows if len(v) == width]
            q = np.floor(np.array([v for _, v in mine], np.float64).reshape(len(mine), width) * SCALE)
            self.by_width[width] = (np.array([i for i, _ in mine], np.int64), q)
        self.cutoffs: dict[int, int] | None = None

    def best(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The task's k best (query, id, score), of phase 1 without cutoffs and of phases 2 and 3 with them."""
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # by query: ids and scores
        for batch in batches:
            ids, vectors = batch.column(0).to_numpy(), batch.column(1)
            widths = np.diff(vectors.offsets.to_numpy())
            for width, (names, q) in self.by_width.items():
                rows = np.flatnonzero(widths == width)
                if not len(rows):
                    continue
                rows = rows[np.argsort(ids[rows], kind="stable")]  # ties then go to the smaller id
                own, parts = ids[rows], _partial(_matrix(vectors, rows, width), q)
                total = reduce(np.add, parts)
                for j, name in enumerate(names.tolist()):
                    other = own != name
                    if self.cutoffs is None:
                        near = [np.flatnonzero(other)[np.argsort(-p[other, j], kind="stable")[: self.k]] for p in parts]
                        take = np.unique(np.concatenate(near))
                    else:
                        cut = self.cutoffs.get(name)
                        enough = other if cut is None else other & reduce(np.logical_or, [p[:, j] * PARTS >= cut for p in parts])
                        take = np.flatnonzero(enough)
                        if cut is not None:
                            take = take[total[take, j] >= cut]
                    if len(take):
                        i, s = own[take], total[take, j]
                        if name in held:
                            i, s = np.concatenate((held[name][0], i)), np.concatenate((held[name][1], s))
                        order = np.lexsort((i, -s)) if s.dtype != object else np.array(sorted(range(len(i)), key=lambda x: (-s[x], i[x])))
                        held[name] = (i[order[: self.k]], s[order[: self.k]])
        rows = [(name, int(i), int(min(max(s, _LONG.min), _LONG.max))) for name, (ids, scores) in held.items() for i, s in zip(ids, scores, strict=True)]
        columns = list(zip(*rows, strict=True)) or [[]] * 3
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], ["query_id", "vec_id", "score"])


def top_k(vectors: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, vec_id, score; ``vectors`` and ``queries`` as from whole_vectors.

    Rows with the query's id are its own and no candidates. Other repeated ids are separate
    candidates; a repeated query id is asked once, with its smallest vector. Vectors of
    another length than the query's take no part.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    asked = written(queries.groupBy("id").agg(F.min("v").alias("v")), "topk-queries")
    values = asked.agg(F.coalesce(F.sum(F.size("v") + 1), F.lit(0))).first()[0]
    blocks = -(-values // BLOCK_VALUES)
    kind = "query_id long, vec_id long, score long"
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    parts = []
    for b in range(blocks):
        block = Block([(r.id, r.v) for r in asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).collect()], k)
        ranked = vectors.mapInArrow(block.best, kind).withColumn("rank", F.row_number().over(order))
        cutoffs = dict(ranked.where(F.col("rank") == k).select("query_id", "score").collect())
        second = Block([], k)
        second.by_width, second.cutoffs = block.by_width, cutoffs
        parts.append(vectors.mapInArrow(second.best, kind))
    if not parts:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    out = reduce(DataFrame.union, parts).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return out.select("query_id", "rank", "vec_id", "score")


def topk_query(rows: DataFrame, k: int = K) -> DataFrame:
    """The k best candidates of every vector whose id is divisible by QUERY_EVERY."""
    vectors = whole_vectors(rows)
    return top_k(vectors, vectors.where(F.col("id") % QUERY_EVERY == 0), k)
