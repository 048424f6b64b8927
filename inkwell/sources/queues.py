"""Queue depth from management snapshots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def queue_depth(body: Column) -> Column:
    """Digits after the first ``"messages"`` key and its colon, -1 on anything else."""
    # only the first key counts, even when a later one would carry a number
    tail = F.regexp_extract(body, r'(?s)\A.*?"messages"(.*)\z', 1)
    digits = F.regexp_extract(tail, r"\A[^:]*:\s*(\d+)", 1)
    return F.coalesce(digits.try_cast("int"), F.lit(-1))


def queue_report(samples: DataFrame, body: str = "body") -> DataFrame:
    depth = queue_depth(F.col(body))
    return samples.withColumn("queue_depth", depth).withColumn(
        "status",
        F.when(F.col(body).isNull(), F.lit("unavailable"))
        .when(F.col("queue_depth") >= 0, F.lit("ok"))
        .otherwise(F.lit("error")),
    )
