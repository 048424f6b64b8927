"""An index of handled keys whose lookups open only what can hold the asked keys.

Every batch adds a run: its keys, dealt by hash into parts of a bounded number of rows, and one
Bloom filter per part. ``fan_in`` neighbouring runs are folded into a larger one, so there are
about ``fan_in`` times the logarithm of the number of batches of them, and a key can be in one
part of each run only. A lookup asks the filters of just those parts and then reads the parts
that remain: as many as there are known keys, and a small share of wrong guesses. The
history of the stream is not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from inkwell.sinks.tables import delete_dir, path_exists, sub_dirs

PART_ROWS = 65_536
FAN_IN = 8
BITS_PER_KEY = 20
HASHES = 5
FILTER = "part int, n long, bits array<long>"


class Run(NamedTuple):
    """Keys of the batches ``first`` to ``last``, in ``parts`` parts with filters of ``words`` 64-bit words."""

    first: int
    last: int
    parts: int
    words: int

    @property
    def name(self) -> str:
        return f"run={self.first}-{self.last}-{self.parts}-{self.words}"


class Opened(NamedTuple):
    """What one lookup read: parts of the index and the rows in them."""

    parts: int
    rows: int


def _part(parts: Column) -> Column:
    return F.pmod(F.xxhash64("url_key"), parts).cast("int")


def _place(i: int, words: Column) -> Column:
    """Bit number ``i`` of a key in a filter."""
    return F.pmod(F.xxhash64("url_key", F.lit(i)), words * 64)


class KeyIndex:
    """Latest stamp per key, by batch; a batch that is replayed replaces its own run."""

    def __init__(self, spark: SparkSession, path: str, part_rows: int = PART_ROWS, fan_in: int = FAN_IN):
        self.spark, self.path, self.part_rows, self.fan_in = spark, path.rstrip("/"), part_rows, fan_in
        self.opened = Opened(0, 0)

    def _complete(self) -> list[Run]:
        runs = [(Run(*map(int, d.removeprefix("run=").split("-"))), d) for d in sub_dirs(self.spark, self.path)]
        return [r for r, d in runs if path_exists(self.spark, f"{self.path}/{d}/filters/_SUCCESS")]

    def runs(self, before: int | None = None) -> list[Run]:
        """The widest runs that together hold every indexed batch before the given one."""
        usable = sorted((r for r in self._complete() if before is None or r.last < before), key=lambda r: (r.first, -r.last))
        out: list[Run] = []
        for r in usable:
            if not out or r.first > out[-1].last:
                out.append(r)
        return out

    def _rows(self, run: Run) -> DataFrame:
        return self.spark.read.schema("url_key string, stamp long, part int").parquet(f"{self.path}/{run.name}/keys")

    def _write(self, rows: DataFrame, n: int, first: int, last: int) -> Run:
        parts = max(1, math.ceil(n / self.part_rows))
        run = Run(first, last, parts, max(1, math.ceil(n / parts * BITS_PER_KEY / 64)))
        folder, words = f"{self.path}/{run.name}", run.words
        dealt = rows.select("url_key", "stamp", _part(F.lit(parts)).alias("part")).repartition(min(parts, 1000), "part")
        dealt.sortWithinPartitions("part", "url_key").write.mode("overwrite").partitionBy("part").parquet(f"{folder}/keys")

        def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            part, n, bits = None, 0, np.zeros(words, np.uint64)

            def done() -> pa.RecordBatch:
                return pa.record_batch([pa.array([part], pa.int32()), pa.array([n], pa.int64()), pa.array([bits.view(np.int64)], pa.list_(pa.int64()))], ["part", "n", "bits"])

            for batch in batches:
                numbers = batch.column(0).to_numpy()
                for value in np.unique(numbers):
                    if part is not None and part != value:
                        yield done()
                        n, bits = 0, np.zeros(words, np.uint64)
                    part, mine = int(value), numbers == value
                    n += int(mine.sum())
                    for column in batch.columns[1:]:
                        at = column.to_numpy()[mine].astype(np.uint64)
                        np.bitwise_or.at(bits, at >> np.uint64(6), np.uint64(1) << (at & np.uint64(63)))
            if part is not None:
                yield done()

        places = self._rows(run).select("part", *[_place(i, F.lit(words)).alias(f"p{i}") for i in range(HASHES)])
        # filters last: a run without them does not count
        places.repartition(min(parts, 1000), "part").sortWithinPartitions("part").mapInArrow(build, FILTER).write.mode("overwrite").parquet(f"{folder}/filters")
        return run

    def add(self, keys: DataFrame, batch_id: int) -> None:
        """Write the run of one batch from rows (url_key, stamp); the latest stamp of a key counts."""
        for run in self._complete():
            if run.first == run.last == batch_id:  # an earlier attempt may have had other sizes
                delete_dir(self.spark, f"{self.path}/{run.name}")
        latest = keys.where("url_key is not null").groupBy("url_key").agg(F.max("stamp").alias("stamp"))
        self._write(latest, latest.count(), batch_id, batch_id)
        self._fold(batch_id)

    def _fold(self, batch_id: int) -> None:
        """Fold full series of equally wide neighbours before this batch, which may still be replayed."""
        while True:
            runs = self.runs(before=batch_id)
            width = [r.last - r.first + 1 for r in runs]
            for i in range(len(runs) - self.fan_in + 1):
                group = runs[i : i + self.fan_in]
                gapless = all(a.last + 1 == b.first for a, b in zip(group, group[1:], strict=False))
                if gapless and len(set(width[i : i + self.fan_in])) == 1:
                    break
            else:
                return
            rows = self._rows(group[0])
            for r in group[1:]:
                rows = rows.union(self._rows(r))
            latest = rows.groupBy("url_key").agg(F.max("stamp").alias("stamp"))
            self._write(latest, latest.count(), group[0].first, group[-1].last)

    def vacuum(self, upto: int) -> int:
        """Delete runs that wider ones up to the batch replace; returns how many."""
        kept = set(self.runs(before=upto + 1))
        old = [r for r in self._complete() if r not in kept and any(k.first <= r.first and r.last <= k.last for k in kept)]
        return sum(delete_dir(self.spark, f"{self.path}/{r.name}") for r in old)

    def covered(self, before: int | None = None) -> set[int]:
        return {b for r in self.runs(before) for b in range(r.first, r.last + 1)}

    def lookup(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """(url_key, stamp) of the asked keys that the index holds; ``keys`` is read twice."""
        runs = self.runs(before)
        nothing = self.spark.createDataFrame([], "url_key string, stamp long")
        self.opened = Opened(0, 0)
        if not runs:
            return nothing
        asked = keys.select("url_key").where("url_key is not null").distinct()
        filters = None
        for i, run in enumerate(runs):
            one = self.spark.read.schema(FILTER).parquet(f"{self.path}/{run.name}/filters").withColumn("run", F.lit(i))
            filters = one if filters is None else filters.union(one)
        each = F.explode(F.array(*[F.struct(F.lit(i).alias("run"), F.lit(r.parts).alias("parts"), F.lit(r.words).alias("words")) for i, r in enumerate(runs)])).alias("r")
        probes = asked.select("url_key", each).select(
            "r.run", _part(F.col("r.parts")).alias("part"), *[_place(i, F.col("r.words")).alias(f"p{i}") for i in range(HASHES)]
        )
        hit = F.lit(True)
        for i in range(HASHES):
            word = F.get("bits", F.call_function("div", F.col(f"p{i}"), F.lit(64)).cast("int"))
            hit = hit & (F.call_function("getbit", word, (F.col(f"p{i}") % 64).cast("int")) == 1)
        # at most the parts of the index come to the driver, a name and a count each
        found = probes.join(filters, ["run", "part"]).where(hit).select("run", "part", "n").distinct().collect()
        self.opened = Opened(len(found), sum(r.n for r in found))
        rows = nothing
        for i, run in enumerate(runs):
            parts = sorted(r.part for r in found if r.run == i)
            if parts:
                rows = rows.union(self._rows(run).where(F.col("part").isin(parts)).select("url_key", "stamp"))
        return rows.join(asked, "url_key", "left_semi").groupBy("url_key").agg(F.max("stamp").alias("stamp"))
