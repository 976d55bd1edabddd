"""Summaries, changes over time and rankings of the fact table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import change_percent, month_index, percent
from ..sources.staging import stage
from .measures import distinct, rows, summarise
from .series import ROWS_PER_TASK, with_frames
from .tree import FACILITY_LEVEL, known_facilities
from .unit_bitmaps import roll_up

# Names of the outputs' columns and the reports' parameters.
SERIES_KEY = ("org_unit_id", "data_element_id")
SERIES_ORDER = ("period", "coc_id", "program_id", "fact_id")
VOLUME_KEY = ("program_id", "health_area", "country_name", "period", "year_month")
KPI_KEY = ("data_element_id", "data_element_name", "country_name", "program_id")
DISTRICT_KEY = ("district_name", "country_name", "data_element_id", "data_element_name")
FACILITY_KEY = ("org_unit_id", "facility_name", "country_name", "health_area")
ROLLING_COLUMNS = (
    "org_unit_id", "facility_name", "country_name", "data_element_id", "data_element_name",
    "period", "year_month", "typed_value", "rolling_3m_avg",
)
ROLLING_PERIODS = 3
TOP_K = 5


def monthly_volume(
    fact: DataFrame,
    keys: Sequence[str] = VOLUME_KEY,
    value: str = "typed_value",
    unit: str = "org_unit_id",
    totals: DataFrame | None = None,
) -> DataFrame:
    """Total, rows and reporting facilities per programme, country and month. ``totals`` are
    kept unit totals of the fact, which is not read then."""
    if totals is not None:
        return roll_up(totals, keys).select(
            *keys,
            F.col("total").alias("total_value"),
            F.col("n_rows").alias("record_count"),
            F.col("n_units").alias("reporting_facilities"),
        )
    return summarise(
        fact, keys, total_value=F.sum(value), record_count=rows(), reporting_facilities=distinct(unit)
    )


def kpi_summary(
    fact: DataFrame, keys: Sequence[str] = KPI_KEY, value: str = "typed_value"
) -> DataFrame:
    """Total, mean, range, sample deviation and rows per element and country."""
    return summarise(
        fact,
        keys,
        total=F.sum(value),
        mean=F.avg(value),
        min=F.min(value),
        max=F.max(value),
        stddev=F.stddev_samp(value),
        n_records=rows(),
    )


def period_change(
    fact: DataFrame,
    keys: Sequence[str] = DISTRICT_KEY,
    period: str = "period",
    value: str = "typed_value",
    total: str = "district_total",
) -> DataFrame:
    """Total per series and period, the one before and the change in percent.

    The window runs over the totals: a series has at most one row per period."""
    totals = summarise(fact, [*keys, period], **{total: F.sum(value)})
    before = F.lag(total).over(Window.partitionBy(*keys).orderBy(period))
    return totals.withColumn("prev_value", before).withColumn(
        "pct_change", change_percent(F.col(total), F.col("prev_value"))
    )


def rolling_average(
    fact: DataFrame,
    *,
    keys: Sequence[str] = SERIES_KEY,
    order: Sequence[str] = SERIES_ORDER,
    value: str = "typed_value",
    size: int = ROLLING_PERIODS,
    name: str = "rolling_3m_avg",
    columns: Sequence[str] | None = ROLLING_COLUMNS,
    rows_per_task: int = ROWS_PER_TASK,
    found: DataFrame | None = None,
) -> DataFrame:
    """Mean over each row and the ``size - 1`` before it in its series. A row
    without a value keeps its place in the frame. See ``with_frames`` for ``found``."""
    back = size - 1
    frames = {name: lambda w: F.round(F.avg(value).over(w.rowsBetween(-back, 0)), 2)}
    needed = list(dict.fromkeys([*(columns or fact.columns), *keys, *order, value]))
    source = fact.select(*(c for c in needed if c != name))
    out = with_frames(source, keys, order, frames, back, rows_per_task, found)
    return out.select(*columns) if columns else out


def rolling_average_by_month(
    fact: DataFrame,
    *,
    keys: Sequence[str] = SERIES_KEY,
    period: str = "period",
    value: str = "typed_value",
    months: int = ROLLING_PERIODS,
    name: str = "rolling_3m_avg",
) -> DataFrame:
    """Mean over each month and the ``months - 1`` calendar months before it, one
    row per series and month. Unlike ``rolling_average``, a month without rows
    takes its place in the frame and several rows of a month count as one month."""
    monthly = summarise(fact, [*keys, period], __sum=F.sum(value), __n=F.count(value))
    w = (
        Window.partitionBy(*keys)
        .orderBy(month_index(F.col(period)))
        .rangeBetween(-(months - 1), 0)
    )
    mean = F.try_divide(F.sum("__sum").over(w), F.sum("__n").over(w))
    return monthly.withColumn(name, F.round(mean, 2)).select(*keys, period, name)


def reporting_rate(
    fact: DataFrame,
    flat_tree: DataFrame,
    *,
    keys: Sequence[str] = ("country_name", "period"),
    unit: str = "org_unit_id",
    level: int = FACILITY_LEVEL,
    totals: DataFrame | None = None,
) -> DataFrame:
    """Facilities that reported, in percent of those the tree knows in the country; see
    ``monthly_volume`` for ``totals``."""
    known = stage(known_facilities(flat_tree, level), "known-facilities")
    if totals is not None:
        reporting = roll_up(totals, keys).select(*keys, F.col("n_units").alias("reporting_facilities"))
    else:
        reporting = summarise(fact, keys, reporting_facilities=distinct(unit))
    return reporting.join(known, "country_name", "left").withColumn(
        "reporting_rate_pct",
        percent(F.col("reporting_facilities"), F.col("total_known_facilities")),
    )


def top_by_dense_rank(
    df: DataFrame, group: str, measure: str, k: int = TOP_K, rank: str = "rank"
) -> DataFrame:
    """Rows whose measure is among the ``k`` highest of their group, ties kept.

    Ranks are given to the distinct measures and joined back. However many rows
    of a group share a measure, none of them is ordered against the others."""
    w = Window.partitionBy(group).orderBy(F.desc(measure))
    levels = (
        df.select(group, measure).distinct()
        .withColumn(rank, F.dense_rank().over(w))
        .where(F.col(rank) <= k)
    )
    levels = stage(levels, "top-levels").select(
        F.col(group).alias("__group"), F.col(measure).alias("__measure"), rank
    )
    same = F.col(group).eqNullSafe(F.col("__group")) & F.col(measure).eqNullSafe(
        F.col("__measure")
    )
    return df.join(levels, same, "inner").drop("__group", "__measure")


def facility_gaps(
    fact: DataFrame,
    keys: Sequence[str] = FACILITY_KEY,
    zero: str = "is_explicit_zero",
    missing: str = "is_missing_value",
) -> DataFrame:
    """Rows that report zero or nothing, and all rows, per facility."""
    return summarise(
        fact,
        keys,
        zero_or_missing_periods=F.count_if(F.col(zero) | F.col(missing)),
        total_periods=rows(),
    )


def underreporters(
    fact: DataFrame, keys: Sequence[str] = FACILITY_KEY, group: str = "health_area", k: int = TOP_K
) -> DataFrame:
    """The facilities with the most zero or missing rows per health area."""
    gaps = stage(facility_gaps(fact, keys), "facility-gaps")
    return top_by_dense_rank(gaps, group, "zero_or_missing_periods", k)
