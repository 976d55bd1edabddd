"""Changes of a registry between two snapshots of it."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..sources.tables import read_if_present, write_table

# The kinds of change and the text of a renaming.
BASELINE = "new_baseline"
ADDED = "added"
REMOVED = "removed"
RENAMED = "renamed"
RENAME_ARROW = " -> "

VERSION = "version"


def registry_snapshot(registry: DataFrame, id_: str = "id", name: str = "name") -> DataFrame:
    """One (id, name) row per id; a missing name is the id."""
    named = F.coalesce(F.col(name), F.col(id_))
    return registry.groupBy(F.col(id_).alias("id")).agg(F.max(named).alias("name"))


def baseline(current: DataFrame) -> DataFrame:
    """The report of a first run: every entry is new."""
    return current.select(
        F.col("id").alias("element_id"),
        F.col("name").alias("element_name"),
        F.lit(BASELINE).alias("drift_type"),
    )


def compare_snapshots(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Entries added, removed or renamed since ``previous``."""
    now = current.select("id", F.col("name").alias("now"))
    then = previous.select("id", F.col("name").alias("then"))
    kind = (
        F.when(F.col("then").isNull(), ADDED)
        .when(F.col("now").isNull(), REMOVED)
        .when(F.col("now") != F.col("then"), RENAMED)
    )
    # a name that is missing on one side leaves only the other
    return (
        now.join(then, "id", "full_outer")
        .withColumn("drift_type", kind)
        .where(F.col("drift_type").isNotNull())
        .select(
            F.col("id").alias("element_id"),
            F.concat_ws(RENAME_ARROW, "then", "now").alias("element_name"),
            "drift_type",
        )
    )


def detect_drift(current: DataFrame, previous: DataFrame | None) -> DataFrame:
    """Compare with the previous snapshot, or report a baseline where there is none."""
    return baseline(current) if previous is None else compare_snapshots(current, previous)


def drift_counts(drift: DataFrame) -> DataFrame:
    return drift.groupBy("drift_type").agg(F.count(F.lit(1)).alias("n_elements"))


def _versions(spark: SparkSession, path: str) -> tuple[DataFrame | None, int]:
    snapshots = read_if_present(spark, path)
    if snapshots is None:
        return None, 0
    # From the names of the files: a version may hold no rows.
    found = (re.search(rf"/{VERSION}=(\d+)/", name) for name in snapshots.inputFiles())
    return snapshots, max((int(version[1]) for version in found if version), default=0)


def latest_snapshot(spark: SparkSession, path: str) -> DataFrame | None:
    """The newest version under ``path``, None before the first run."""
    snapshots, newest = _versions(spark, path)
    if snapshots is None:
        return None
    return snapshots.where(F.col(VERSION) == newest).drop(VERSION)


def save_snapshot(snapshot: DataFrame, path: str) -> int:
    """Write the next version beside the older ones, which stay as they are, so a
    failed write leaves the last good snapshot in place. Returns the version."""
    _, newest = _versions(snapshot.sparkSession, path)
    write_table(snapshot, f"{path}/{VERSION}={newest + 1}")
    return newest + 1
