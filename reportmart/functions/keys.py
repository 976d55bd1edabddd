"""Row keys made of natural key parts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

NULL_TOKEN = "\\N"


def natural_key(parts: Sequence[str | Column], sep: str = "|") -> Column:
    """md5 over the joined parts. A null part gets a token of its own, so that
    it cannot collide with a key that simply has fewer parts."""
    columns = [F.col(p) if isinstance(p, str) else p for p in parts]
    return F.md5(
        F.concat_ws(sep, *(F.coalesce(c.cast("string"), F.lit(NULL_TOKEN)) for c in columns))
    )
