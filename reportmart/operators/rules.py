"""Row rules: rows that break one are set aside together with the reasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import PERIOD_PATTERN, is_absent
from .errors import GateError

MAX_QUARANTINE_PCT = 10.0
REASON = "quarantine_reason"

QUARANTINE_COLUMNS = ("dataElement", "period", "orgUnit", "categoryOptionCombo", "raw_value", REASON)


def required(column: str) -> Column:
    """Reason text where ``column`` is null or empty, else null."""
    return F.when(is_absent(F.col(column)), F.lit(f"missing:{column}"))


def required_format(column: str, pattern: str, label: str) -> Column:
    """As ``required``, and a reason with the offending text where the pattern fails."""
    text = F.col(column)
    return F.coalesce(
        required(column),
        F.when(~text.rlike(pattern), F.concat(F.lit(f"invalid_{label}:"), text)),
    )


def landing_rules() -> list[Column]:
    """What every reported value must have, in the order the reasons are listed."""
    return [
        required("orgUnit"),
        required_format("period", PERIOD_PATTERN, "period"),
        required("dataElement"),
    ]


def with_reason(df: DataFrame, rules: Sequence[Column], reason: str = REASON) -> DataFrame:
    """Add the broken rules' reasons joined by ``|``; empty text where none is broken."""
    return df.withColumn(reason, F.concat_ws("|", *rules))


def valid_rows(flagged: DataFrame, reason: str = REASON) -> DataFrame:
    return flagged.where(F.col(reason) == "").drop(reason)


def quarantined_rows(flagged: DataFrame, reason: str = REASON) -> DataFrame:
    return flagged.where(F.col(reason) != "")


def quarantine_table(flagged: DataFrame) -> DataFrame:
    """The set-aside values in the layout of the quarantine output."""
    return quarantined_rows(flagged).withColumnRenamed("value", "raw_value").select(
        *QUARANTINE_COLUMNS
    )


def quarantine_rate(
    flagged: DataFrame, max_pct: float = MAX_QUARANTINE_PCT, reason: str = REASON
) -> DataFrame:
    """One row: rows seen, rows set aside, their share in percent and whether it
    is within the limit. A table without rows has the rate 0."""
    counts = flagged.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(reason) != "").alias("quarantined_rows"),
    )
    rate = F.coalesce(F.try_divide("quarantined_rows", "total_rows") * 100, F.lit(0.0))
    return counts.withColumn("quarantine_pct", rate).withColumn(
        "passed", F.col("quarantine_pct") <= max_pct
    )


def check_quarantine_rate(total: int, quarantined: int, max_pct: float = MAX_QUARANTINE_PCT) -> float:
    """The rate in percent; raises when it is above the limit."""
    pct = quarantined / total * 100 if total else 0.0
    if pct > max_pct:
        raise GateError(f"{pct:.2f} % of the rows are quarantined, limit {max_pct} %")
    return pct
