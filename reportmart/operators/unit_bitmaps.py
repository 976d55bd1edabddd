"""Exact distinct counts that add up, by bitmaps over numbered units.

A unit gets a number once and keeps it, so the units of a group are a bitmap, and the units of
several groups, periods or loads are the bitmaps joined by ``or``. One row is kept for each
group and each stretch of 32,768 numbers: its bitmap, the sum, the values and the rows. All
summaries that are coarser come from the kept rows alone, without a look at the fact, and no
row of the fact is expanded for a second distinct count.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

#: The finest groups that the reports need.
TOTAL_KEYS = (
    "country_name", "program_id", "health_area", "data_element_id", "data_element_name",
    "period", "year_month", "year", "quarter",
)
#: Numbers are given within this many parts side by side; it must stay as it is between loads.
PARTS = 256


def number_units(
    rows: DataFrame, kept: DataFrame | None = None, unit: str = "org_unit_id", parts: int = PARTS
) -> DataFrame:
    """``unit`` and ``number`` for every unit of ``rows`` that ``kept`` does not number yet.

    Units are dealt to parts by their hash and numbered from 1 within them, after the last
    number that ``kept`` has there; parts take turns in the numbers. So numbers are nearly
    dense, no task sees all units, and none is given twice. A null unit gets none."""
    part = F.pmod(F.xxhash64(unit), F.lit(parts)).alias("__part")
    new = rows.select(unit).where(F.col(unit).isNotNull()).distinct()
    last = F.lit(0).cast("long")
    if kept is not None:
        new = new.join(kept.select(unit), unit, "left_anti")
        taken = kept.groupBy(part).agg(F.count(F.lit(1)).alias("__taken"))
        new = new.withColumn("__part", part).join(taken, "__part", "left")
        last = F.coalesce(F.col("__taken"), last)
    else:
        new = new.withColumn("__part", part)
    place = F.row_number().over(Window.partitionBy("__part").orderBy(unit)).cast("long") + last - 1
    return new.select(unit, (place * parts + F.col("__part") + 1).alias("number"))


def numbered(
    rows: DataFrame, numbers: DataFrame, unit: str = "org_unit_id", of: str | None = None
) -> DataFrame:
    """``rows`` with the ``number`` of their unit, null where there is none. ``of`` is the
    column of ``rows`` with the unit, if it has another name than in ``numbers``."""
    found = numbers.select(F.col(unit).alias("__unit"), "number")
    return rows.join(found, F.col(of or unit) == F.col("__unit"), "left").drop("__unit")


def unit_totals(
    rows: DataFrame,
    numbers: DataFrame | None = None,
    keys: Sequence[str] = TOTAL_KEYS,
    value: str = "typed_value",
    unit: str = "org_unit_id",
) -> DataFrame:
    """Per combination of ``keys`` and stretch of numbers: ``units``, a bitmap, ``total``,
    ``n_values`` without nulls and ``n_rows``. Rows without a unit count in a stretch of their
    own, whose bitmap is empty. Every other unit must be numbered. Without ``numbers`` the
    rows have their ``number`` with them.

    Narrow rows are brought together by group and stretch, and a bitmap is made once, where
    all its units are. Bitmaps made before a shuffle would be as many as tasks times groups
    times stretches, of which tasks and stretches both grow with the input."""
    # No more is shuffled with a row than is counted, if the numbers are too many to broadcast.
    if numbers is not None:
        rows = numbered(rows.select(*dict.fromkeys([*keys, value, unit])), numbers, unit)
    placed = rows.select(*keys, F.col(value).alias("__value"), "number")
    placed = placed.withColumn("stretch", F.bitmap_bucket_number("number"))
    # The hash tells most groups apart by a number, in the shuffle as in the sort.
    placed = placed.withColumn("__group", F.xxhash64(*keys, "stretch")).repartition("__group")
    made = placed.groupBy("__group", *keys, "stretch").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("units"),
        F.sum("__value").alias("total"),
        F.count("__value").alias("n_values"),
        F.count(F.lit(1)).alias("n_rows"),
    )
    return made.drop("__group")


def merged(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``totals`` for coarser ``keys``, of the same form: several loads or periods as one."""
    total = F.sum("total").cast(totals.schema["total"].dataType)
    return totals.groupBy(*keys, "stretch").agg(
        F.bitmap_or_agg("units").alias("units"),
        total.alias("total"),
        F.sum("n_values").alias("n_values"),
        F.sum("n_rows").alias("n_rows"),
    )


def roll_up(totals: DataFrame, keys: Sequence[str], also: str | None = None) -> DataFrame:
    """One row per combination of ``keys``: ``total``, ``mean``, ``n_values``, ``n_rows``,
    ``n_units`` and, where ``also`` names another column of ``totals``, ``n_also``, its
    distinct values but null."""
    own = merged(totals, keys).withColumn("__units", F.bitmap_count("units")).drop("stretch", "units")
    own = own.withColumn("__also", F.lit(0).cast("long"))
    if also is not None:
        # Rows of their own beside the totals, so that nothing is joined or expanded.
        values = totals.where(F.col(also).isNotNull()).select(*keys, also).distinct()
        nothing = [F.lit(None).cast(own.schema[c].dataType).alias(c) for c in ("total", "n_values", "n_rows")]
        own = own.unionByName(
            values.select(
                *keys, *nothing, F.lit(0).cast("long").alias("__units"), F.lit(1).cast("long").alias("__also")
            )
        )
    total = F.sum("total").cast(totals.schema["total"].dataType)
    found = own.groupBy(*keys).agg(
        total.alias("total"),
        mean(F.sum("total"), F.sum("n_values")).alias("mean"),
        F.sum("n_values").alias("n_values"),
        F.sum("n_rows").alias("n_rows"),
        F.sum("__units").alias("n_units"),
        F.sum("__also").alias("n_also"),
    )
    return found if also is not None else found.drop("n_also")


def mean(total: Column, n: Column) -> Column:
    return F.when(n > 0, total / n)


def totals_of(
    rows: DataFrame,
    keys: Sequence[str] = TOTAL_KEYS,
    value: str = "typed_value",
    unit: str = "org_unit_id",
) -> DataFrame:
    """The totals of ``rows`` alone, with numbers of their own, where none are kept."""
    return unit_totals(rows, number_units(rows, unit=unit), keys, value, unit)
