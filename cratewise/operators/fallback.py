"""A second source used only when the first is empty."""

from __future__ import annotations

from pyspark.sql import DataFrame


def fallback_union(primary: DataFrame, fallback: DataFrame) -> DataFrame:
    """Rows of ``primary``, or those of ``fallback`` when there are none.

    The test is a scalar subquery that stops at one row; a non-empty ``primary`` turns
    it into a constant that empties the fallback at its scans.
    """
    return primary.unionByName(fallback.where(~primary.exists()))
