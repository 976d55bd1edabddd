"""Windows over ordered series that stay balanced when one series is huge.

A window sorts each of its groups in one task. That is right for millions of
short series, but one series may hold a third of all rows. Such series are found
by a count and split, by range, into chunks of about equal size that are written
once; a task holds as many chunks as make up its share of the rows. Every row but the
first few of a chunk has its whole frame in the chunk. For those few the window runs
again over the edges of the chunks alone.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec, functions as F

from ..sources.staging import stage

ROWS_PER_TASK = 5_000_000
#: Smaller chunks share a task, so that the number of tasks and files follows the rows.
LEAST_ROWS = 200_000

Framed = Mapping[str, Callable[[WindowSpec], Column]]


def long_series(
    df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK
) -> DataFrame:
    """Keys with more rows than one task should sort, and their numbers of rows.
    There are at most as many of them as the table has multiples of
    ``rows_per_task``. Counted once, map-side first, and staged."""
    found = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > rows_per_task)
    )
    return stage(found, "long-series")


def with_frames(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    frames: Framed,
    lookback: int,
    rows_per_task: int = ROWS_PER_TASK,
    found: DataFrame | None = None,
) -> DataFrame:
    """Add columns computed by ``frames`` over each series.

    ``order`` must order the rows of a series totally. No frame may reach further
    than ``lookback`` rows back, nor any row ahead. Counts the rows per series
    first; pass ``found``, the result of ``long_series``, to share that count.
    """
    if found is None:
        found = long_series(df, keys, rows_per_task)
    total = found.agg(F.sum("n_rows")).first()[0]
    if total is None:
        return _framed(df, keys, order, frames)

    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    marks = found.select(*(F.col(k).alias(f"__{k}") for k in keys))
    short = _framed(df.join(marks, same, "left_anti"), keys, order, frames)
    tasks = math.ceil(total / max(rows_per_task, LEAST_ROWS)) + 1
    # The id holds the number of the task and, below it, that of the row there.
    row = F.monotonically_increasing_id()
    task, place = F.shiftright(row, 33), row.bitwiseAND(F.lit((1 << 33) - 1))
    long = (
        df.join(marks, same, "left_semi")
        .repartitionByRange(tasks, *keys, *order)
        .sortWithinPartitions(*keys, *order)
        .withColumn("__chunk", F.struct(task, F.floor(place / rows_per_task)))
    )
    columns = [*df.columns, *frames]
    return short.unionByName(
        _framed_by_chunk(stage(long, "series-chunks"), keys, order, frames, lookback).select(
            *columns
        )
    )


def _framed(df: DataFrame, keys: Sequence[str], order: Sequence[str], frames: Framed) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumns({name: frame(w) for name, frame in frames.items()})


def _framed_by_chunk(
    chunked: DataFrame, keys: Sequence[str], order: Sequence[str], frames: Framed, lookback: int
) -> DataFrame:
    in_chunk = Window.partitionBy(*keys, "__chunk")
    placed = chunked.withColumns(
        {
            "__from_start": F.row_number().over(in_chunk.orderBy(*order)),
            "__size": F.count(F.lit(1)).over(in_chunk),
        }
    )
    starts = F.col("__from_start") <= lookback
    ends = F.col("__from_start") > F.col("__size") - lookback
    body = _framed(placed, [*keys, "__chunk"], order, frames).where(~starts)
    edges = _framed(placed.where(starts | ends), keys, order, frames).where(starts)
    return body.unionByName(edges)
