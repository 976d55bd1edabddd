"""Location trees given as ``/root/child/leaf`` paths."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from .resolve import attach, unknown

# The names of the tree's upper levels, and the level that reports.
LEVEL_NAMES = {1: "country_name", 2: "region_name", 3: "district_name"}
FACILITY_LEVEL = 4

UNIT_ON = {"orgUnit": "id"}


def flatten_tree(units: DataFrame, level_names: Mapping[int, str] = LEVEL_NAMES) -> DataFrame:
    """One row per unit: its own name, level and path, and the name of its
    ancestor at each named level, null where the path has none there.

    The work is done on the registry: one join of (unit, ancestor) pairs with the
    tree whatever its depth, so that the far larger value table is joined once.
    """
    ancestors = units.select(
        "id", F.posexplode(F.split("path", "/")).alias("depth", "ancestor")
    ).where(F.col("depth").isin(*level_names))
    nodes = units.where(F.col("level").isin(*level_names)).select(
        F.col("id").alias("ancestor"), F.col("level").alias("depth"), F.col("name").alias("label")
    )
    labels = (
        ancestors.join(nodes, ["ancestor", "depth"])
        .groupBy("id")
        .agg(
            *(
                F.max(F.when(F.col("depth") == level, F.col("label"))).alias(name)
                for level, name in level_names.items()
            )
        )
    )
    return units.join(labels, "id", "left").select(
        "id",
        F.col("name").alias("facility_name"),
        F.col("level").alias("facility_level"),
        F.col("path").alias("ou_path"),
        *level_names.values(),
    )


def resolve_units(values: DataFrame, flat_tree: DataFrame) -> DataFrame:
    """Values of known units, with everything the flat tree knows about them."""
    attrs = {name: name for name in flat_tree.columns if name != "id"}
    return attach(values, flat_tree, UNIT_ON, attrs)


def unresolved_units(values: DataFrame, units: DataFrame) -> DataFrame:
    return unknown(values, units, UNIT_ON)


def known_facilities(flat_tree: DataFrame, level: int = FACILITY_LEVEL) -> DataFrame:
    """Units of the reporting level per country."""
    return (
        flat_tree.where(F.col("facility_level") == level)
        .groupBy("country_name")
        .agg(F.count(F.lit(1)).alias("total_known_facilities"))
    )
