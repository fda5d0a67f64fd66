"""Attribute join to a lookup table (Q8; J2, F10)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from blotter.functions.categorical import not_sentinel_number


def enrich_area(df: DataFrame, lookup: DataFrame, on: str | Sequence[str],
                value_col: str | None = None, sentinel: float = -1) -> DataFrame:
    """Inner join to ``lookup`` on ``on``; then drop rows whose ``value_col``
    is NULL or the sentinel (``-1`` marks areas that are not residential).

    No hint is given: Spark broadcasts a lookup whose bytes are within its own
    threshold (from file sizes, or measured at run time) and shuffles beyond it.
    Lookup keys are expected unique; a duplicated key multiplies rows, as any
    equi-join does.
    """
    joined = df.join(lookup, on, "inner")
    if value_col is not None:
        joined = joined.where(not_sentinel_number(value_col, sentinel))
    return joined
