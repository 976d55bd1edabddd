"""Quantiles per group, approximate or exact, without sorting a whole group."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..sources.staging import stage
from .series import ROWS_PER_TASK

ACCURACY = 10_000
SLICES = 1_000


def approx_quantiles(
    df: DataFrame, key: str, value: str, probs: Mapping[str, float], accuracy: int = ACCURACY
) -> DataFrame:
    """One row per group with a sketch-based quantile per entry of ``probs``. All entries come
    from one sketch: the few tasks that merge the sketches of all others do so once."""
    found = F.percentile_approx(value, list(probs.values()), accuracy).alias("__quantiles")
    return df.groupBy(key).agg(found).select(
        key, *(F.col("__quantiles")[i].alias(name) for i, name in enumerate(probs))
    )


def exact_quantiles(
    df: DataFrame,
    key: str,
    value: str,
    probs: Mapping[str, float],
    accuracy: int = ACCURACY,
    rows_per_task: int = ROWS_PER_TASK,
) -> DataFrame:
    """One row per group with the exact discrete quantiles: the smallest value
    whose cumulative share reaches p.

    The sketch of a first pass brackets each quantile between two values that
    enclose it. A second pass counts, map-side first, the rows outside the brackets
    and the rows per value inside. Brackets that still hold more values than one
    task should sort are cut into slices, of which only the one with the quantile
    is kept, until all are small. So no sort grows with the group, even where one
    group holds a third of the table. A sketch that broke its error bound would
    fail the query, not falsify it.
    """
    margin = 2.0 / accuracy
    names = sorted(probs, key=probs.__getitem__)
    edges = {f"lo_{name}": max(probs[name] - margin, 0.0) for name in names}
    edges |= {f"hi_{name}": min(probs[name] + margin, 1.0) for name in names}
    rows = df.select(F.col(key).alias("key"), F.col(value).alias("v")).where("v IS NOT NULL")
    brackets = approx_quantiles(rows.withColumn("v", _sortable(rows)), "key", "v", edges, accuracy)
    if _has_nan(rows):
        # What lies beyond infinity is NaN.
        highest = {c: F.when(F.col(c) < float("inf"), F.col(c)).otherwise(float("nan")) for c in edges if c.startswith("hi_")}
        brackets = brackets.withColumns(highest)
    brackets = stage(brackets, "quantile-brackets")

    # Rows outside all brackets are counted by the number of brackets they exceed.
    v = F.col("v")
    inside, exceeded = F.lit(False), F.lit(0)
    for name in names:
        inside = inside | _within(v, name)
        exceeded = exceeded + F.when(v > F.col(f"hi_{name}"), 1).otherwise(0)
    cells = stage(
        _with_group(rows, brackets)
        .select("key", exceeded.alias("exceeded"), F.when(inside, v).alias("cell"))
        .groupBy("key", "exceeded", "cell")
        .agg(F.count(F.lit(1)).alias("n")),
        "quantile-cells",
    )

    # Outside rows that exceed i brackets lie below the (i + 1)th and all after it.
    cell = F.col("cell")
    ranks = stage(
        _with_group(cells, brackets)
        .groupBy("key")
        .agg(
            F.sum("n").alias("total"),
            *(
                F.sum(
                    F.when(
                        F.coalesce(cell < F.col(f"lo_{name}"), F.col("exceeded") <= i), F.col("n")
                    ).otherwise(0)
                ).alias(f"below_{name}")
                for i, name in enumerate(names)
            ),
        ),
        "quantile-ranks",
    )

    def candidate(name: str) -> Column:
        target = F.greatest(F.ceil(F.lit(probs[name]) * F.col("total")), F.lit(1))
        wanted = F.struct(
            F.lit(name).alias("quantile"), (target - F.col(f"below_{name}")).alias("rank")
        )
        return F.when(_within(cell, name), wanted)

    candidates = _with_group(_with_group(cells.where("cell IS NOT NULL"), brackets), ranks).select(
        "key", "cell", "n", F.inline(F.array_compact(F.array(*(candidate(n) for n in names))))
    )
    if _largest_group(cells, "key") > rows_per_task:
        candidates = stage(candidates, "quantile-candidates")
        candidates = _part_with_rank(candidates, 1 + candidates.count() // rows_per_task)

    picked = _at_rank(candidates, "cell").groupBy("key").agg(
        *(F.max(F.when(F.col("quantile") == name, cell)).alias(name) for name in names)
    )
    lost = F.raise_error(F.lit("a quantile lies outside its bracket"))
    complete = ranks.select("key").join(
        picked.withColumnRenamed("key", "__key"), F.col("key").eqNullSafe(F.col("__key")), "left"
    )
    return complete.select(
        F.col("key").alias(key),
        *(F.coalesce(name, lost.cast(picked.schema[name].dataType)).alias(name) for name in probs),
    )


def _has_nan(rows: DataFrame) -> bool:
    """Whether the type of ``v`` knows NaN."""
    return rows.schema["v"].dataType.typeName() in ("float", "double")


def _sortable(rows: DataFrame) -> Column:
    """The values as a sketch can order them: NaN, the greatest, as infinity."""
    v = F.col("v")
    return F.when(F.isnan(v), float("inf")).otherwise(v) if _has_nan(rows) else v


def _within(value: Column, name: str) -> Column:
    return value.between(F.col(f"lo_{name}"), F.col(f"hi_{name}"))


def _with_group(df: DataFrame, groups: DataFrame) -> DataFrame:
    """Attach the one row per group; null is a group as well."""
    right = groups.withColumnRenamed("key", "__key")
    return df.join(right, F.col("key").eqNullSafe(F.col("__key"))).drop("__key")


def _largest_group(df: DataFrame, *keys: str) -> int:
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))
    return sizes.agg(F.max("size")).first()[0] or 0


def _at_rank(counted: DataFrame, order: str) -> DataFrame:
    """Per group and quantile the entry at ``rank``, ``before`` rows being below it."""
    w = Window.partitionBy("key", "quantile").orderBy(order)
    upto = F.sum("n").over(w.rowsBetween(Window.unboundedPreceding, 0))
    return counted.withColumn("before", upto - F.col("n")).where(
        "before < rank AND rank <= before + n"
    )


def _part_with_rank(candidates: DataFrame, parts: int) -> DataFrame:
    """Order all candidates over ``parts`` tasks and keep, per group and quantile, those
    of the one task that holds the rank. A value occurs once in a group, so no task gets
    more than its share, and any order of values will do, infinities and NaN included."""
    ordered = candidates.repartitionByRange(parts, "key", "quantile", "cell")
    ordered = stage(ordered.withColumn("part", F.spark_partition_id()), "quantile-parts")
    counted = ordered.groupBy("key", "quantile", "rank", "part").agg(F.sum("n").alias("n"))
    kept = _at_rank(counted, "part").select("key", "quantile", F.col("part").alias("kept"), "before")
    return (
        _same_group(ordered, stage(kept, "quantile-ranked-parts"))
        .where("part = kept")
        .select("key", "cell", "n", "quantile", (F.col("rank") - F.col("before")).alias("rank"))
    )


def _same_group(df: DataFrame, groups: DataFrame) -> DataFrame:
    right = groups.withColumnsRenamed({"key": "__key", "quantile": "__quantile"})
    same = F.col("key").eqNullSafe(F.col("__key")) & (F.col("quantile") == F.col("__quantile"))
    return df.join(right, same).drop("__key", "__quantile")
