"""Outcome of every input: completed, duplicate, blank, unsupported or an error class."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from inkwell.functions import text as TX, urls as U
from inkwell.operators.skew import attach_by_key


FETCH_ERRORS = ("NOT_FOUND", "TOO_LARGE")


def outcome_of(reject: Column, dedupe: Column, fetched: Column, failure: Column, text: Column,
               unicode_blank: bool = False, fetch_error: Column | None = None) -> Column:
    """First applicable outcome in processing order.

    ``fetch_error`` tells why bytes are missing: NOT_FOUND, TOO_LARGE, or else the text of
    a READ_ERROR. Without it they were not found.
    """
    blank = TX.is_blank_unicode(text) if unicode_blank else TX.is_blank_trimmed(text)
    return (
        F.when(reject.isNotNull(), reject)
        .when(dedupe == "DUPLICATE", F.lit("DUPLICATE"))
        .when(~fetched, _missing(fetch_error))
        .when(failure.isNotNull(), failure)
        .when(blank, F.lit("BLANK"))
        .otherwise(F.lit("COMPLETED"))
    )


def _missing(fetch_error: Column | None) -> Column:
    if fetch_error is None:
        return F.lit("NOT_FOUND")
    known = F.coalesce(fetch_error, F.lit("NOT_FOUND"))
    return F.when(known.isin(*FETCH_ERRORS), known).otherwise(F.lit("READ_ERROR"))


def route(outcome: Column) -> Column:
    """Destination folder: completed inputs are processed, all others are errors.

    A duplicate is neither: its first copy has been filed already.
    """
    return (
        F.when(outcome == "COMPLETED", F.lit("processed"))
        .when(outcome == "DUPLICATE", F.lit("skipped"))
        .otherwise(F.lit("error"))
    )


def settle_copies(copies: DataFrame, firsts: DataFrame) -> DataFrame:
    """Outcome of further copies of a message, from the outcome of its first copy.

    A copy counts as duplicate only if the first one completed (in this batch or
    according to the ledger); otherwise processing it would have failed the same way.
    """
    failed = firsts.where(F.col("outcome") != "COMPLETED").select("url_key", F.col("outcome").alias("_failed"))
    return (
        attach_by_key(copies, failed, "url_key")
        .withColumn("outcome", F.coalesce("_failed", F.lit("DUPLICATE")))
        .drop("_failed")
    )


def outcome_counts(rows: DataFrame, by: str = "outcome") -> DataFrame:
    return rows.groupBy(by).agg(F.count(F.lit(1)).alias("n"))


def processed_message(rows: DataFrame) -> DataFrame:
    """Downstream message and headers of each completed reference.

    NULL fields are left out of the JSON, which copies the stream names only if the
    original message had them.
    """
    target = U.output_path(F.col("url"), F.col("filename"))
    return rows.withColumn("processed_url", target).withColumns(
        {
            "message": F.to_json(
                F.struct(
                    F.lit("HDFS").alias("type"),
                    F.col("processed_url").alias("url"),
                    F.col("inputStream"),
                    F.col("outputStream"),
                    F.lit(True).alias("processed"),
                    F.col("url").alias("originalFile"),
                )
            ),
            "header_original_file": F.col("url"),
            "header_processed_url": F.col("processed_url"),
            "header_text_length": F.col("text_length"),
        }
    )
