"""Running values over a log in which a few keys may own most of the rows.

A plain window over ``partitionBy(instance)`` puts the whole history of an instance in
one task. Here a prefix scan does it: the log is cut into ranges of about equally many rows
of (key, order), so that a busy key spans as many ranges as its share of the rows asks for;
each range is folded to one carry row per key, the carries of a key are scanned by a second,
small window, and the carried value is joined back. All keys take this path; nothing has to
be known about their sizes, and no width has to be guessed.

The cuts come from a sample of (key, order), taken by a job of its own as a global sort
takes it; they decide how rows are dealt, never what comes out. Rows move once, by
(range, key); the fold of the ranges and the join use the same partitioning. Besides them
only carry rows move: at most one per key, and one more per range.
"""

from __future__ import annotations

import json
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

SLICE = "_slice"
SAMPLE_PER_PART = 40


class Slicing(NamedTuple):
    """Into how many ranges the log is cut; None takes the session's shuffle partitions."""

    parts: int | None = None


def _sortable(df: DataFrame, name: str) -> Column:
    """The column, times as whole microseconds, so that cuts pass through JSON unchanged."""
    kind = df.schema[name].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp"))
    return F.col(name)


def range_number(df: DataFrame, columns: list[str], parts: int | None = None) -> Column:
    """Number of the range of ``columns`` (integers, strings, times; nulls first) that a row is in.

    At most ``parts`` ranges, numbered in rising order; rows with equal values share one. What
    comes to the driver is a sample of the columns of a fixed number of rows per range.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    at = F.struct(*[_sortable(df, c).alias(f"c{i}") for i, c in enumerate(columns)])
    keys = df.select(at.alias("at"))
    n = keys.count() if parts > 1 else 0
    if n < 2:
        return F.lit(0)
    share = min(1.0, SAMPLE_PER_PART * parts / n)
    drawn = [r[0] for r in keys.sample(share, seed=1).orderBy("at").select(F.to_json("at", {"ignoreNullFields": "false"})).collect()]
    step = max(1.0, len(drawn) / parts)
    cuts = list(dict.fromkeys(drawn[int(i * step)] for i in range(1, parts) if int(i * step) < len(drawn)))
    if not cuts:
        return F.lit(0)
    kind = T.ArrayType(keys.schema["at"].dataType)
    table = F.from_json(F.lit("[" + ",".join(cuts) + "]"), kind)  # folded to a constant before the job

    def halve(span: Column, _: Column) -> Column:
        """Keep the half of [low, high) in which the number of cuts at or below the row lies."""
        low, high = span["low"], span["high"]
        middle = F.call_function("div", low + high, F.lit(2)).cast("int")
        beyond = F.get(table, middle) <= at
        return F.when(low >= high, span).otherwise(
            F.struct(F.when(beyond, middle + 1).otherwise(low).cast("int").alias("low"), F.when(beyond, high).otherwise(middle).cast("int").alias("high"))
        )

    rounds = F.sequence(F.lit(1), F.lit(len(cuts).bit_length() + 1))
    return F.aggregate(rounds, F.struct(F.lit(0).alias("low"), F.lit(len(cuts)).alias("high")), halve)["low"]


class Timeline:
    """Windows of one log: ``keys`` and a total ``order`` of a key's rows, times first."""

    def __init__(self, keys: list[str], order: list[str], slicing: Slicing = Slicing()):
        self.keys, self.order, self.slicing = keys, order, slicing
        # the number first: sorting then compares it before it compares text
        self.group = [SLICE, *keys]

    def sliced(self, df: DataFrame) -> DataFrame:
        """Add the number of the row's range."""
        return df.withColumn(SLICE, range_number(df, [*self.keys, *self.order], self.slicing.parts))

    def restored(self, columns: list[str]) -> list[Column]:
        return [F.col(c) for c in columns]

    def _in_slice(self):
        return Window.partitionBy(*self.group).orderBy(*self.order)

    def within(self):
        """All rows of the slice up to the current one."""
        return self._in_slice().rowsBetween(Window.unboundedPreceding, 0)

    def strictly_within(self):
        """The same without the current row."""
        return self._in_slice().rowsBetween(Window.unboundedPreceding, -1)

    def rest_of_slice(self):
        """The current and the later rows of the slice."""
        return self._in_slice().rowsBetween(0, Window.unboundedFollowing)

    def before(self):
        """Slice rows of the key before the current slice."""
        return Window.partitionBy(*self.keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)

    def after(self):
        """Slice rows of the key after the current slice."""
        return Window.partitionBy(*self.keys).orderBy(SLICE).rowsBetween(1, Window.unboundedFollowing)

    def last_of(self, value: str) -> Column:
        """Aggregate: the latest non-NULL value of the slice."""
        return F.max_by(value, F.when(F.col(value).isNotNull(), F.struct(*self.order)))

    def with_carry(self, local: DataFrame, tails: dict[str, Column], *carries: dict[str, Column]) -> DataFrame:
        """Join each row with the state carried into its slice.

        ``tails`` reduces a slice to one row; each of ``carries`` adds window
        expressions over those rows, built with :meth:`before` or :meth:`after`, and
        may use the columns of the previous one.
        """
        carry = local.groupBy(*self.group).agg(*[e.alias(n) for n, e in tails.items()])
        for step in carries:
            carry = carry.withColumns(step)
        theirs = carry.drop(*tails).withColumnsRenamed({c: f"_of{c}" for c in self.group})
        same = reduce(Column.__and__, [F.col(c).eqNullSafe(F.col(f"_of{c}")) for c in self.group])
        return local.join(theirs, same, "left").drop(*[f"_of{c}" for c in self.group])


def running_sum(df: DataFrame, line: Timeline, value: Column, name: str) -> DataFrame:
    """Sum of ``value`` over all rows of the key up to and including this one."""
    local = line.sliced(df).withColumn("_v", value).withColumn("_local", F.sum("_v").over(line.within()))
    joined = line.with_carry(local, {"_t": F.sum("_v")}, {"_c": F.sum("_t").over(line.before())})
    return joined.select(*line.restored(df.columns), (F.col("_local") + F.coalesce("_c", F.lit(0))).alias(name))


def running_last(df: DataFrame, line: Timeline, value: Column, name: str, current: bool = True) -> DataFrame:
    """Latest non-NULL ``value`` up to this row, or strictly before it."""
    w = line.within() if current else line.strictly_within()
    local = line.sliced(df).withColumn("_v", value).withColumn("_local", F.last("_v", ignorenulls=True).over(w))
    carry = {"_c": F.last("_t", ignorenulls=True).over(line.before())}
    joined = line.with_carry(local, {"_t": line.last_of("_v")}, carry)
    return joined.select(*line.restored(df.columns), F.coalesce("_local", "_c").alias(name))
