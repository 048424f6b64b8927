"""Duplicate detection for file references."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F

Done = DataFrame | Callable[[DataFrame], DataFrame]
STEP = "CAST(10000000000000000000 AS DECIMAL(20,0))"  # above any row number


def marker_stamps(ledger: DataFrame) -> DataFrame:
    """(url_key, stamp) of completions and markers; an odd stamp asks for another run."""
    marker = ledger.where(F.col("url_key").isNotNull() & F.col("status").isin("COMPLETED", "REPROCESS"))
    # time and kind in one number, so that Spark can aggregate by hashing; at equal
    # time the completion is the older one: a marker always asks for another run
    again = F.when(F.col("status") == "REPROCESS", F.lit(1)).otherwise(F.lit(0))
    return marker.select("url_key", (F.unix_micros(F.col("processed_at").cast("timestamp")) * 2 + again).alias("stamp"))


def done_keys(stamps: DataFrame) -> DataFrame:
    """Keys whose latest stamp is a completion."""
    latest = stamps.groupBy("url_key").agg(F.max("stamp").alias("_m"))
    return latest.where(F.col("_m") % 2 == 0).select("url_key")


def ledger_keys(ledger: DataFrame) -> DataFrame:
    """URL keys that count as done: the latest marker of the key is COMPLETED.

    A ``REPROCESS`` marker after the last completion lets the key pass again.
    """
    return done_keys(marker_stamps(ledger))


def dedupe_refs(refs: DataFrame, done: Done | None = None, time: str = "arrived_at") -> DataFrame:
    """Add ``dedupe``: REJECTED, FIRST or DUPLICATE. No row is dropped.

    The first arrival of a URL is FIRST, equal times go by place in the input. Message
    ids of the source are not looked at, so missing and repeated ones do no harm: rows
    get numbers of their own. ``refs`` is read twice and must not change in between (a
    table or scan with row-wise expressions on it).

    Only (url_key, first arrival) pairs are shuffled by key, after map-side combining,
    so copies of one URL never meet in one task; time and number are packed into one
    decimal to be combined by hashing. The flag goes back by row number.

    ``done`` is a table of handled keys, or a function that looks up the given keys.
    """
    numbered = refs.withColumn("_row", F.monotonically_increasing_id())
    at = F.coalesce(F.unix_micros(F.col(time).cast("timestamp")), F.lit(2**62)).cast("decimal(19,0)")
    packed = (at * F.expr(STEP) + F.col("_row")).cast("decimal(38,0)")
    first = (
        numbered.where(F.col("reject").isNull())
        .groupBy("url_key")
        .agg(F.min(packed).alias("_f"))
        .select("url_key", (F.col("_f") % F.expr(STEP)).cast("long").alias("_row"))
    )
    if done is not None:
        # keys of the batch prune the ledger side before the anti join
        handled = done(first.select("url_key")) if callable(done) else done
        seen = handled.join(first.select("url_key"), "url_key", "left_semi")
        first = first.join(seen, "url_key", "left_anti")
    flags = first.select("_row", F.lit(True).alias("_first"))
    return (
        numbered.join(flags, "_row", "left")
        .withColumn(
            "dedupe",
            F.when(F.col("reject").isNotNull(), F.lit("REJECTED"))
            .when(F.col("_first"), F.lit("FIRST"))
            .otherwise(F.lit("DUPLICATE")),
        )
        .select(*refs.columns, "dedupe")
    )
