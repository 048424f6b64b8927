"""Lookups that stay balanced when a few keys own most of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame

from inkwell.session import configure


def attach_by_key(rows: DataFrame, lookup: DataFrame, key: str) -> DataFrame:
    """Left join ``rows`` to ``lookup`` (at most one row per key) without a hot task.

    A plain shuffle join: since ``lookup`` has one row per key, the adaptive planner can
    cut the partition of a frequent (or missing) key into pieces of any number and give
    each of them that one row. No key list, count or bound is involved.
    """
    configure(rows.sparkSession)
    return rows.join(lookup, key, "left").select(*rows.columns, *[c for c in lookup.columns if c != key])
