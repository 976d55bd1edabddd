"""Small helpers that several operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(df: DataFrame, column: str) -> Column:
    """The text column of ``df``; null reads as empty."""
    return F.coalesce(df[column].cast("string"), F.lit(""))


def ascii_lower(text: Column) -> Column:
    """``text`` with A-Z, and nothing else, in lower case."""
    return F.translate(text, UPPER, UPPER.lower())


def without(df: DataFrame, dropped: DataFrame, on: dict[str, Column]) -> DataFrame:
    """Rows of ``df`` that match no row of ``dropped``. ``on`` maps the columns of
    ``dropped`` to expressions over ``df``; nulls match each other. The columns of
    ``df`` stay as they are, whatever their names.

    What is dropped grows with the table, so both sides are dealt by key at every size;
    the rows of ``df``, which hold texts, are not sorted for it."""
    hidden = dropped.select([F.col(name).alias(f"__dropped_{name}") for name in on])
    condition = F.lit(True)
    for name, value in on.items():
        condition = condition & value.eqNullSafe(hidden[f"__dropped_{name}"])
    return df.join(hidden.hint("shuffle_hash"), condition, "left_anti")


def by_row(
    of_row: Callable[..., Iterable[tuple]],
    schema: pa.Schema,
    rows: int = 4096,
    size: int = 1 << 24,
    arrays: bool = False,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that turns each input row into result rows.

    A batch of results ends at ``rows`` rows or after input rows of ``size``
    characters, so a batch stays small however long its texts are. ``arrays``: see
    ``rows_of``."""

    def batch(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found) if found else ([] for _ in schema)
        arrays = [pa.array(list(c), f.type) for c, f in zip(columns, schema)]
        return pa.RecordBatch.from_arrays(arrays, schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: list[tuple] = []
        weight = 0
        for row in rows_of(batches, arrays=arrays):
            for result in of_row(*row):
                found.append(result)
                if len(found) >= rows:
                    yield batch(found)
                    found, weight = [], 0
            weight += sum(len(v) for v in row if isinstance(v, (str, bytes, np.ndarray)))
            if weight >= size:
                yield batch(found)
                found, weight = [], 0
        yield batch(found)

    return run


def rows_of(
    batches: Iterator[pa.RecordBatch], step: int = 64, arrays: bool = False
) -> Iterator[tuple]:
    """The rows of all batches, a few at a time as Python objects. With ``arrays`` lists of
    numbers, which hold no null, come as numpy arrays: that takes far less time."""
    for whole in batches:
        for at in range(0, whole.num_rows, step):
            part = whole.slice(at, step)
            yield from zip(*(objects(column, arrays) for column in part.columns))


def objects(column: pa.Array, arrays: bool) -> list:
    if not (arrays and pa.types.is_list(column.type)):
        return column.to_pylist()
    stops = np.cumsum(np.asarray(column.value_lengths()))[:-1]
    return np.split(column.flatten().to_numpy(), stops)
