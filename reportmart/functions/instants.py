"""Parsing of submission times that arrive as text.

Two forms are read: ``yyyy-MM-ddTHH:mm:ss.SSS`` and ``yyyy-MM-dd``. Text after
either, an offset say, is ignored. The shape is checked before the cast, because a
cast is several times faster than a pattern and would read other forms too.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def parse_instant(text: Column) -> Column:
    """Timestamp of ``text``, midnight for a date; null for any other form."""
    has_date = F.substring(text, 8, 1) == "-"
    has_time = (F.substring(text, 11, 1) == "T") & (F.length(text) >= 23)
    return F.when(
        has_date,
        F.coalesce(
            F.when(has_time, F.substring(text, 1, 23).try_cast("timestamp")),
            F.substring(text, 1, 10).try_cast("date").cast("timestamp"),
        ),
    )


def submitted_at(*texts: Column) -> Column:
    """The first of several time columns that can be read."""
    return F.coalesce(*(parse_instant(text) for text in texts))
