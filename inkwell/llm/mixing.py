"""Mixing sources to target weights.

A source's weight is its share of the tokens to the power of an exponent, normalised.
Exponent 1 keeps the shares, 0 makes all sources equal. The exponent is bisected: the
largest for which the weights' entropy reaches a target, or the smallest for which no
source is repeated more often than a limit.

The weights are realised within a token budget. A source that may give ``weight * budget``
tokens is read ``epochs`` times: all its documents floor(epochs) times and, for the rest, a
prefix of a permutation of its blocks (hash ranges of its rows, in an order drawn per
source), the last block cut at the last row that stays within the budget. Rows of equal id
and text stand or fall together. Without a budget it is the smallest one that
uses every document once, so nothing is lost.

Totals per (source, block) are combined before the shuffle; a source of any size is at most
BLOCKS rows in the window that lays its blocks out, and one block of rows in the one that
cuts its last block.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F

from inkwell.llm.common import free_name, quoted, written

BLOCKS = 16_384
BROADCAST_SOURCES = 100_000
MAX_REPEATS = 4.0
SEED = 17


def word_count(text: Column) -> Column:
    """Runs of non-blank characters; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


@dataclass(frozen=True)
class Shares:
    """What the bisection asks of the sources' token shares, for any exponent."""

    power_sum: Callable[[float], float]  # sum of share ** a
    entropy: Callable[[float], float]  # of the weights at exponent a
    smallest: float
    largest: float

    @classmethod
    def of(cls, totals: DataFrame) -> Shares | None:
        """From (tokens) per source, all above 0. Many sources stay in Spark, one small job per question."""
        n, total, low, high = totals.agg(F.count("*"), F.sum("tokens"), F.min("tokens"), F.max("tokens")).first()
        if not n:
            return None
        if n <= BROADCAST_SOURCES:
            p = np.array([r.tokens for r in totals.select("tokens").collect()], float) / total

            def entropy(a: float) -> float:
                w = p**a / (p**a).sum()
                return float(-(w * np.log(w)).sum())

            return cls(lambda a: float((p**a).sum()), entropy, low / total, high / total)
        share = F.col("tokens") / total

        def spark_entropy(a: float) -> float:
            s, t = totals.agg(F.sum(share**a), F.sum(share**a * F.log(share))).first()
            return math.log(s) - a * t / s

        return cls(lambda a: totals.agg(F.sum(share**a)).first()[0], spark_entropy, low / total, high / total)

    def repeats(self, a: float, budget: float | None) -> float:
        """How often the most repeated source is read; ``budget`` in totals of all tokens.

        share ** (a - 1) falls with the share for a < 1, so it is the smallest source, and
        without a budget the largest one is read once.
        """
        if budget is None:
            return (self.smallest / self.largest) ** (a - 1)
        return budget * self.smallest ** (a - 1) / self.power_sum(a)


def bisect(holds: Callable[[float], bool], steps: int = 50) -> float:
    """Smallest exponent in [0, 1] for which ``holds``, which is false below and true above; 1 if none."""
    low, high = 0.0, 1.0
    if holds(low):
        return low
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (low, middle) if holds(middle) else (middle, high)
    return high


def exponent(shares: Shares, max_repeats: float | None = MAX_REPEATS, entropy: float | None = None, budget: float | None = None) -> float:
    """The exponent for a target entropy (natural log), else for a repetition limit."""
    if entropy is not None:
        return bisect(lambda a: shares.entropy(a) <= entropy)
    return bisect(lambda a: shares.repeats(a, budget) <= max_repeats)


def mix_sources(
    docs: DataFrame, tokens: Column | None = None, source: str = "source", key: tuple[str, ...] = ("doc_id", "text"),
    max_repeats: float = MAX_REPEATS, entropy: float | None = None, budget: int | None = None, seed: int = SEED,
) -> tuple[DataFrame, list[str]]:
    """All rows and columns of ``docs`` with, last, tokens, weight and copies; and these columns' names.

    ``copies`` is how often the mix reads the row, 0 included. Null is a source of its own;
    rows without tokens cost nothing and are read once. The input must give the same rows
    when read again.
    """
    rows = docs
    names = {}
    for base in ("n_tokens", "weight", "copies", "mix_source", "mix_hash"):
        names[base] = free_name(rows, base)
        rows = rows.withColumn(names[base], F.lit(None))
    n, w, c, s, h = (names[x] for x in ("n_tokens", "weight", "copies", "mix_source", "mix_hash"))
    rows = (
        docs.withColumn(n, word_count(quoted("text")) if tokens is None else tokens)
        .withColumn(s, F.coalesce(F.concat(F.lit("="), quoted(source).cast("string")), F.lit("null")))
        .withColumn(h, F.xxhash64(F.lit(seed), *map(quoted, key)))
    )
    block = F.pmod(F.col("hash"), F.lit(BLOCKS))
    slim = written(rows.select(quoted(s).alias("source"), quoted(h).alias("hash"), quoted(n).alias("tokens")).where(F.col("tokens") > 0), "mix-rows")
    blocks = written(slim.groupBy("source", block.alias("block")).agg(F.sum("tokens").alias("tokens")), "mix-blocks")
    totals = written(blocks.groupBy("source").agg(F.sum("tokens").alias("tokens")), "mix-sources")
    shares = Shares.of(totals)
    if shares is None:
        plain = rows.withColumn(w, F.lit(0.0)).withColumn(c, F.lit(1))
        return plain.select(*map(quoted, docs.columns), quoted(n), quoted(w), quoted(c)), [n, w, c]
    everything = totals.agg(F.sum("tokens")).first()[0]
    relative = None if budget is None else budget / everything
    a = exponent(shares, max_repeats, entropy, relative)
    share = F.col("tokens") / F.lit(float(everything))
    scale = shares.power_sum(a)
    # epochs = weight * budget / tokens = share ** (a - 1) * factor
    factor = shares.largest ** (1 - a) if relative is None else relative / scale
    plan = totals.select(
        "source", "tokens", (share**a / scale).alias("weight"),
        F.round(share ** (a - 1) * factor, 9).alias("epochs"),
    ).withColumn("whole", F.floor("epochs")).withColumn("target", (F.col("epochs") - F.col("whole")) * F.col("tokens"))
    few = totals.count() <= BROADCAST_SOURCES
    small = F.broadcast if few else (lambda df: df)
    # lay the blocks out; the first that does not fit is cut
    turn = F.xxhash64(F.lit(seed + 1), "source", "block")
    line = Window.partitionBy("source").orderBy("turn", "block")
    laid = blocks.withColumn("turn", turn).withColumn("upto", F.sum("tokens").over(line))
    laid = laid.join(small(plan.select("source", "target")), "source").where(F.col("upto") > F.col("target"))
    first = Window.partitionBy("source").orderBy("upto", "turn", "block")
    cut = laid.withColumn("i", F.row_number().over(first)).where("i = 1").select("source", F.col("turn").alias("cut"), "block", (F.col("target") - F.col("upto") + F.col("tokens")).alias("left"))
    cut = written(cut, "mix-cuts")
    inside = slim.withColumn("block", block).join(small(cut), ["source", "block"])
    upto = F.sum("tokens").over(Window.partitionBy("source").orderBy("hash"))  # equal hashes count together
    last = inside.withColumn("upto", upto).where(F.col("upto") <= F.col("left")).groupBy("source").agg(F.max("hash").alias("last"))
    plan = plan.join(cut.select("source", "cut"), "source", "left").join(last, "source", "left").select("source", "weight", "whole", "cut", "last")
    plan = written(plan, "mix-plan")
    mine = plan.select(*(F.col(x).alias(f"_mix_{x}") for x in plan.columns))
    joined = rows.join(small(mine), quoted(s) == F.col("_mix_source"), "left")
    own = F.xxhash64(F.lit(seed + 1), quoted(s), F.pmod(quoted(h), F.lit(BLOCKS)))
    extra = F.when(own < F.col("_mix_cut"), 1).when((own == F.col("_mix_cut")) & (quoted(h) <= F.col("_mix_last")), 1).otherwise(0)
    copies = F.when((quoted(n) == 0) | F.col("_mix_source").isNull(), 1).otherwise(F.col("_mix_whole") + extra).cast("int")
    out = joined.select(*map(quoted, docs.columns), quoted(n), F.coalesce("_mix_weight", F.lit(0.0)).alias(w), copies.alias(c))
    return out, [n, w, c]


def schedule(mixed: DataFrame, copies: str = "copies", key: tuple[str, ...] = ("doc_id", "text"), seed: int = SEED) -> DataFrame:
    """One row per reading with, last, its epoch and turn: sort by both for a block-permuted order per epoch.

    The columns are named by ``free_name(mixed, "epoch")`` and ``"turn"``.
    """
    epoch, turn = free_name(mixed, "epoch"), free_name(mixed, "turn")
    block = F.pmod(F.xxhash64(F.lit(seed), *map(quoted, key)), F.lit(BLOCKS))
    out = mixed.where(quoted(copies) > 0).withColumn(epoch, F.explode(F.sequence(F.lit(1), quoted(copies))))
    return out.withColumn(turn, F.xxhash64(F.lit(seed + 1), quoted(epoch), block))


def realised(docs: DataFrame, budget: int | None = None) -> DataFrame:
    """The mix itself: each row as often as it is read, with tokens, weight, copies, epoch and turn."""
    out, (_, _, c) = mix_sources(docs, budget=budget)
    return schedule(out, c)


def mixing_query(docs: DataFrame, budget: int | None = None) -> DataFrame:
    """doc_id, source, n_tokens, weight, copies, epoch, turn of each reading, for at most four readings of any source.

    Without a budget (in tokens) it is the smallest one that reads every row once.
    """
    return realised(docs.select("doc_id", "source", "text"), budget).drop("text")
