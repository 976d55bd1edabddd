"""Values that stand out from their own series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import change_percent
from .series import ROWS_PER_TASK, with_frames
from .trends import SERIES_KEY, SERIES_ORDER

# Names of the output and the thresholds.
ANOMALY_COLUMNS = (
    "fact_id", "period", "country_name", "facility_name", "data_element_name", "health_area",
    "typed_value",
)
Z_SCORE = "z_score_outlier"
SPIKE = "period_spike"
WINDOW_ROWS = 12
MAX_Z = 3.0
MAX_GROWTH_PCT = 300


def with_scores(
    fact: DataFrame,
    *,
    keys: Sequence[str] = SERIES_KEY,
    order: Sequence[str] = SERIES_ORDER,
    value: str = "typed_value",
    window_rows: int = WINDOW_ROWS,
    rows_per_task: int = ROWS_PER_TASK,
    found: DataFrame | None = None,
) -> DataFrame:
    """Add ``__z``, the distance from the rolling mean in deviations, the row itself
    included, and ``__growth``, the change in percent over the row before. Both
    frames share one sort of the series."""
    back = window_rows - 1
    frames = {
        "__mean": lambda w: F.avg(value).over(w.rowsBetween(-back, 0)),
        "__sd": lambda w: F.stddev_samp(value).over(w.rowsBetween(-back, 0)),
        "__before": lambda w: F.lag(value).over(w),
    }
    current = F.col(value)
    framed = with_frames(fact, keys, order, frames, max(back, 1), rows_per_task, found)
    return framed.withColumns(
        {
            "__z": F.when(
                F.col("__sd") > 0, F.abs(current - F.col("__mean")) / F.col("__sd")
            ),
            "__growth": F.when(
                F.col("__before") > 0, change_percent(current, F.col("__before"), None)
            ),
        }
    ).drop("__mean", "__sd", "__before")


def _finding(kind: str, score: Column, limit: float) -> Column:
    return F.when(
        score > limit, F.struct(score.alias("z_score"), F.lit(kind).alias("anomaly_type"))
    )


def detect_anomalies(
    fact: DataFrame,
    *,
    keys: Sequence[str] = SERIES_KEY,
    order: Sequence[str] = SERIES_ORDER,
    value: str = "typed_value",
    columns: Sequence[str] = ANOMALY_COLUMNS,
    window_rows: int = WINDOW_ROWS,
    max_z: float | None = MAX_Z,
    max_growth_pct: float | None = MAX_GROWTH_PCT,
    rows_per_task: int = ROWS_PER_TASK,
    found: DataFrame | None = None,
) -> DataFrame:
    """One row per finding: a row that is both an outlier and a spike appears
    twice. ``z_score`` holds the distance in deviations for ``z_score_outlier`` and
    the growth in percent for ``period_spike``. Pass None to leave a kind out."""
    needed = list(dict.fromkeys([*columns, *keys, *order, value]))
    scored = with_scores(
        fact.select(*needed),
        keys=keys,
        order=order,
        value=value,
        window_rows=window_rows,
        rows_per_task=rows_per_task,
        found=found,
    )
    findings = []
    if max_z is not None:
        findings.append(_finding(Z_SCORE, F.col("__z"), max_z))
    if max_growth_pct is not None:
        findings.append(_finding(SPIKE, F.col("__growth"), max_growth_pct))
    return scored.select(*columns, F.inline(F.array_compact(F.array(*findings))))
