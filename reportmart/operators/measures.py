"""Named aggregates for summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def rows() -> Column:
    """All rows, those without a value included."""
    return F.count(F.lit(1))


def distinct(column: str) -> Column:
    return F.count_distinct(column)


def summarise(df: DataFrame, keys: Sequence[str], **measures: Column) -> DataFrame:
    """One row per combination of ``keys`` with one column per measure, combined
    map-side. A distinct count is first reduced to one row per key and counted value, so
    a hot key is spread over the tasks that hold its values. Pass one at most: for two
    Spark expands the input, see ``unit_bitmaps`` for a way without."""
    return df.groupBy(*keys).agg(*(m.alias(name) for name, m in measures.items()))
