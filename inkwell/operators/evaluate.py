"""Where and how often expensive expressions run."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column whose expression runs once per row, whatever uses it later.

    Spark pushes a filter on a derived column below the projection that derives it
    and then evaluates the expression for the filter and again for the result. A
    generator over a one-element array is a boundary such filters do not cross.
    """
    kept = [F.col(f"`{c}`") for c in df.columns if c != name]
    return df.select(*kept, F.explode_outer(F.array(value)).alias(name))


def spread_small(df: DataFrame, split_bytes: int = 128 * 1024 * 1024) -> DataFrame:
    """Distribute a small input over all cores before CPU-bound work.

    An input of less than one split per core cannot occupy the cluster, and a file
    with a single row group is always read by a single task. Larger inputs are
    returned as they are and never shuffled.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size < cores * split_bytes else df
