"""Comparisons across countries and streaks of low completeness."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from ..functions import month_index
from .measures import distinct, rows, summarise
from .unit_bitmaps import roll_up, totals_of

# Names of the outputs' columns and the reports' parameters.
COUNTRY_KPI_KEY = (
    "country_name", "program_id", "health_area", "data_element_id", "data_element_name",
)
QUARTER_KEY = ("health_area", "country_name", "year", "quarter")
GLOBAL_KEY = ("program_id", "health_area", "data_element_id", "data_element_name", "period")
LOW_COMPLETENESS_PCT = 80
MIN_STREAK = 3


def country_kpis(
    fact: DataFrame,
    keys: Sequence[str] = COUNTRY_KPI_KEY,
    value: str = "typed_value",
    unit: str = "org_unit_id",
    period: str = "period",
    totals: DataFrame | None = None,
) -> DataFrame:
    """Total, mean, facilities and periods per country and element. ``totals`` are kept
    unit totals of the fact, which is not read then."""
    if totals is None:
        totals = totals_of(fact, [*keys, period], value, unit)
    return roll_up(totals, keys, period).select(
        *keys,
        "total",
        F.col("mean").alias("mean_per_report"),
        F.col("n_units").alias("n_facilities"),
        F.col("n_also").alias("n_periods"),
    )


def quarterly_volumes(
    fact: DataFrame,
    keys: Sequence[str] = QUARTER_KEY,
    value: str = "typed_value",
    unit: str = "org_unit_id",
    totals: DataFrame | None = None,
) -> DataFrame:
    """Total, rows and facilities per quarter; see ``country_kpis`` for ``totals``."""
    if totals is not None:
        found = roll_up(totals, keys).select(
            *keys,
            F.col("total").alias("quarterly_total"),
            F.col("n_rows").alias("record_count"),
            F.col("n_units").alias("n_facilities"),
        )
        return found.orderBy(*keys)
    return summarise(
        fact, keys, quarterly_total=F.sum(value), record_count=rows(), n_facilities=distinct(unit)
    ).orderBy(*keys)


def global_totals(
    fact: DataFrame,
    keys: Sequence[str] = GLOBAL_KEY,
    value: str = "typed_value",
    country: str = "country_name",
    unit: str = "org_unit_id",
    totals: DataFrame | None = None,
) -> DataFrame:
    """Total, countries and facilities per element and period; see ``country_kpis``."""
    if totals is None:
        totals = totals_of(fact, [*keys, country], value, unit)
    return roll_up(totals, keys, country).select(
        *keys,
        F.col("total").alias("global_total"),
        F.col("n_also").alias("n_countries"),
        F.col("n_units").alias("n_facilities"),
    )


def coverage_matrix(
    fact: DataFrame,
    names: Sequence[str] | None = None,
    *,
    group: str = "country_name",
    element: str = "data_element_name",
    value: str = "typed_value",
) -> DataFrame:
    """One row per country, one column per element with its total. Without
    ``names`` Spark finds the elements first, up to ``spark.sql.pivotMaxValues``."""
    pivoted = fact.groupBy(group).pivot(element, list(names) if names is not None else None)
    return pivoted.agg(F.sum(value)).orderBy(group)


def completeness_by_country(
    scores: DataFrame, keys: Sequence[str] = ("country_name", "period")
) -> DataFrame:
    return summarise(
        scores, keys, avg_completeness_pct=F.avg("completeness_pct"), n_facilities=rows()
    )


def low_streaks(
    scores: DataFrame,
    *,
    keys: Sequence[str] = ("orgUnit", "country_name"),
    period: str = "period",
    score: str = "completeness_pct",
    below: float = LOW_COMPLETENESS_PCT,
    at_least: int = MIN_STREAK,
) -> DataFrame:
    """Runs of consecutive months, each scoring ``below`` the threshold.

    Month number less row number is the same for neighbouring months and grows
    with every gap. Scores have one row per unit and month, so a unit's window is
    as long as its history in months."""
    low = scores.where(F.col(score) < below)
    position = F.row_number().over(Window.partitionBy(*keys).orderBy(period))
    runs = low.withColumn("__run", month_index(F.col(period)) - position)
    return (
        summarise(
            runs,
            [*keys, "__run"],
            consecutive_low_periods=rows(),
            streak_start=F.min(period),
            streak_end=F.max(period),
            avg_completeness_pct=F.avg(score),
        )
        .where(F.col("consecutive_low_periods") >= at_least)
        .drop("__run")
        .orderBy(F.desc("consecutive_low_periods"), *keys, "streak_start")
    )
