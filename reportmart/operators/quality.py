"""Cleaning and flagging of resolved values, and completeness of reporting."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import (
    is_blank,
    is_explicit_zero,
    parse_instant,
    percent,
    period_end,
    submitted_at,
)
from ..sources.staging import stage
from .quantiles import approx_quantiles, exact_quantiles

VALUE_KEY = ("dataElement", "period", "orgUnit", "categoryOptionCombo")

# Thresholds of the quality flags.
LATE_DAYS = 60
QUARTILES = {"q1": 0.25, "q3": 0.75}
FENCE_IQRS = 3.0


def latest_order() -> list[Column]:
    """Newest update first. Equal times fall back on the other columns, so that
    the same row wins on every run."""
    newest = [parse_instant(F.col(c)).desc_nulls_last() for c in ("lastUpdated", "created")]
    texts = ("lastUpdated", "created", "value", "storedBy")
    return newest + [F.col(c).desc_nulls_last() for c in texts]


def latest_per_key(
    df: DataFrame, keys: Sequence[str] = VALUE_KEY, order: Sequence[Column] | None = None
) -> DataFrame:
    """One row per key: the first in ``order``. Exact copies and superseded
    values go in the same pass. The planner keeps one row per key in each map
    task before the shuffle, so many copies of one key cost no large task. A hash
    of the key comes first: the sort tells most keys apart by that number alone."""
    w = Window.partitionBy("__hash", *keys).orderBy(*(order or latest_order()))
    ranked = df.withColumn("__hash", F.xxhash64(*keys)).withColumn("__rank", F.row_number().over(w))
    return ranked.where("__rank = 1").drop("__rank", "__hash")


def distinct_copies(
    df: DataFrame, keys: Sequence[str] = VALUE_KEY, value: str = "value"
) -> DataFrame:
    """The distinct (key, value) combinations."""
    return df.select(*keys, value).distinct()


def duplicate_tally(
    df: DataFrame, keys: Sequence[str] = VALUE_KEY, value: str = "value"
) -> DataFrame:
    """One row: rows in, exact copies, superseded values, rows left."""
    per_value = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("copies"))
    per_key = per_value.groupBy(*keys).agg(
        F.sum("copies").alias("n"), F.count(F.lit(1)).alias("n_values")
    )
    total = F.coalesce(F.sum("n"), F.lit(0))
    values = F.coalesce(F.sum("n_values"), F.lit(0))
    return per_key.agg(
        total.alias("rows_in"),
        (total - values).alias("exact_duplicates"),
        (values - F.count(F.lit(1))).alias("near_duplicates"),
        F.count(F.lit(1)).alias("rows_left"),
    )


def with_value_flags(df: DataFrame, value: str = "value") -> DataFrame:
    """A reported zero, a missing value and the number, three separate columns."""
    text = F.col(value)
    return df.withColumns(
        {
            "is_explicit_zero": is_explicit_zero(text),
            "is_missing_value": is_blank(text),
            "typed_value": text.try_cast("double"),
        }
    )


def with_late_flag(
    df: DataFrame,
    submitted: Sequence[str] = ("lastUpdated", "created"),
    period: str = "period",
    max_days: int = LATE_DAYS,
) -> DataFrame:
    """True when submitted more than ``max_days`` after the period's last day;
    false when either date is unknown."""
    when = submitted_at(*(F.col(c) for c in submitted))
    delay = F.datediff(when, period_end(F.col(period)))
    return df.withColumn("is_late_reported", F.coalesce(delay > max_days, F.lit(False)))


def outlier_limits(
    df: DataFrame,
    key: str = "dataElement",
    value: str = "typed_value",
    *,
    exact: bool = False,
    iqrs: float = FENCE_IQRS,
) -> DataFrame:
    """Quartiles and fences per group, over all rows of the group."""
    quantiles = exact_quantiles if exact else approx_quantiles
    return with_fences(quantiles(df, key, value, QUARTILES), iqrs)


def with_fences(quartiles: DataFrame, iqrs: float = FENCE_IQRS) -> DataFrame:
    """Add the fences, ``iqrs`` times the distance of the quartiles beyond them."""
    spread = F.col("q3") - F.col("q1")
    return quartiles.withColumns(
        {"fence_low": F.col("q1") - iqrs * spread, "fence_high": F.col("q3") + iqrs * spread}
    )


def with_outlier_flag(
    df: DataFrame, limits: DataFrame, key: str = "dataElement", value: str = "typed_value"
) -> DataFrame:
    """True outside the fences; false for no value or quartiles that coincide.

    Stage ``limits`` first: it then has a known, small size, and the values keep
    their partitioning instead of being shuffled on a few keys."""
    fences = limits.where("q3 > q1").select(
        F.col(key).alias("__key"), "fence_low", "fence_high"
    )
    outside = ~F.col(value).between(F.col("fence_low"), F.col("fence_high"))
    return (
        df.join(fences, F.col(key) == F.col("__key"), "left")
        .withColumn("is_outlier", F.coalesce(outside, F.lit(False)))
        .drop("__key", "fence_low", "fence_high")
    )


def flag_outliers(
    df: DataFrame, key: str = "dataElement", value: str = "typed_value", *, exact: bool = False
) -> DataFrame:
    """Compute the limits once, then flag against them."""
    limits = stage(outlier_limits(df, key, value, exact=exact), "outlier-limits")
    return with_outlier_flag(df, limits, key, value)


def completeness(
    df: DataFrame,
    *,
    group: str = "country_name",
    unit: str = "orgUnit",
    period: str = "period",
    element: str = "dataElement",
) -> DataFrame:
    """Distinct elements reported per unit and period, in percent of the elements
    seen anywhere in the unit's country. A row without a value counts as reported;
    a unit without any row in a period does not appear."""
    # One pass over the rows, whose names may still have to be joined: both sides come from it.
    counted = df.groupBy(group, unit, period, element).agg(F.count(F.lit(1)).alias("__rows"))
    counted = stage(counted, "counted-elements")
    expected = stage(expected_elements(counted, group, element), "expected-elements")
    actual = counted.groupBy(group, unit, period).agg(
        F.count(element).alias("actual_de_count"), F.sum("__rows").alias("row_count")
    )
    return score(actual, expected, group)


def expected_elements(
    df: DataFrame, group: str = "country_name", element: str = "dataElement"
) -> DataFrame:
    """The number of elements seen anywhere in each country."""
    return (
        df.where(F.col(group).isNotNull())
        .groupBy(group)
        .agg(F.count_distinct(element).alias("expected_de_count"))
    )


def reported_elements(
    df: DataFrame,
    group: str = "country_name",
    unit: str = "orgUnit",
    period: str = "period",
    element: str = "dataElement",
) -> DataFrame:
    """The number of elements, and of rows, of each unit and period."""
    return df.groupBy(group, unit, period).agg(
        F.count_distinct(element).alias("actual_de_count"),
        F.count(F.lit(1)).alias("row_count"),
    )


def score(actual: DataFrame, expected: DataFrame, group: str = "country_name") -> DataFrame:
    """Reported in percent of expected elements."""
    return actual.join(expected, group, "left").withColumn(
        "completeness_pct", percent(F.col("actual_de_count"), F.col("expected_de_count"))
    )


def flag_tally_columns() -> list[Column]:
    """Aggregates that count the flags; usable in ``agg`` and in ``observe``."""
    return [
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("is_late_reported")).alias("late_rows"),
        F.count_if(F.col("is_outlier")).alias("outlier_rows"),
        F.count_if(F.col("is_explicit_zero")).alias("zero_rows"),
        F.count_if(F.col("is_missing_value")).alias("missing_rows"),
    ]


def average_completeness(scores: DataFrame) -> DataFrame:
    return scores.agg(F.avg("completeness_pct").alias("avg_completeness_pct"))


def quality_tally(cleaned: DataFrame, scores: DataFrame) -> DataFrame:
    """One row: the flag counts and the average completeness."""
    average = average_completeness(scores).scalar()
    return cleaned.agg(*flag_tally_columns()).withColumn("avg_completeness_pct", average)
