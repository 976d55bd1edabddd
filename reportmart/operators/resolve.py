"""Resolution of ids against registries.

No broadcast is asked for. A registry read from files or staged has a known
size, so the planner broadcasts it below ``spark.sql.autoBroadcastJoinThreshold``
and otherwise joins by shuffle, where the adaptive skew join splits a hot id.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

DEFAULT_COMBO_NAME = "Default"


def _registry(lookup: DataFrame, on: Mapping[str, str], attrs: Mapping[str, str]) -> DataFrame:
    keys = [F.col(theirs).alias(f"__{ours}") for ours, theirs in on.items()]
    return lookup.select(*keys, *(F.col(c).alias(name) for c, name in attrs.items()))


def _condition(on: Mapping[str, str]) -> list[Column]:
    return [F.col(ours) == F.col(f"__{ours}") for ours in on]


def attach(
    df: DataFrame, lookup: DataFrame, on: Mapping[str, str], attrs: Mapping[str, str]
) -> DataFrame:
    """Rows with a known id, with the registry's attributes.

    ``on`` maps columns of ``df`` to columns of ``lookup``; ``attrs`` maps
    columns of ``lookup`` to the names they get."""
    joined = df.join(_registry(lookup, on, attrs), _condition(on), "inner")
    return joined.drop(*(f"__{ours}" for ours in on))


def known(df: DataFrame, lookup: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose id the registry has, unchanged."""
    return df.join(_registry(lookup, on, {}), _condition(on), "left_semi")


def unknown(df: DataFrame, lookup: DataFrame, on: Mapping[str, str]) -> DataFrame:
    """Rows whose id the registry lacks, null ids included."""
    return df.join(_registry(lookup, on, {}), _condition(on), "left_anti")


def attach_optional(
    df: DataFrame,
    lookup: DataFrame,
    on: Mapping[str, str],
    attrs: Mapping[str, str],
    *,
    missing_flag: str | None = None,
    defaults: Mapping[str, str] | None = None,
) -> DataFrame:
    """All rows, with attributes where the id is known. ``missing_flag`` names a
    column that is true where it is not; ``defaults`` fills named attributes."""
    joined = df.join(_registry(lookup, on, attrs), _condition(on), "left")
    added: dict[str, Column] = {
        name: F.coalesce(F.col(name), F.lit(value)) for name, value in (defaults or {}).items()
    }
    if missing_flag:
        added[missing_flag] = F.col(f"__{next(iter(on))}").isNull()
    if added:
        joined = joined.withColumns(added)
    return joined.drop(*(f"__{ours}" for ours in on))


def repeated_keys(lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that a registry holds more than once, which would multiply rows."""
    return (
        lookup.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n_rows"))
        .where(F.col("n_rows") > 1)
    )


def one_per_key(lookup: DataFrame, keys: Sequence[str]) -> DataFrame:
    """A registry with each key once: of several entries the first by their text."""
    others = [c for c in lookup.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*others)
    return lookup.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


# The columns that resolution reads and the names it gives them.
ELEMENT_ON = {"dataElement": "id"}
ELEMENT_ATTRS = {"name": "data_element_name", "valueType": "valueType", "domainType": "domainType"}
COMBO_ON = {"categoryOptionCombo": "id"}
COMBO_ATTRS = {"name": "coc_name"}
COMBO_FLAG = "is_orphaned_coc"


def resolve_elements(values: DataFrame, data_elements: DataFrame) -> DataFrame:
    """Values of known elements, with name and types."""
    return attach(values, data_elements, ELEMENT_ON, ELEMENT_ATTRS)


def unresolved_elements(values: DataFrame, data_elements: DataFrame) -> DataFrame:
    return unknown(values, data_elements, ELEMENT_ON)


def resolve_combos(values: DataFrame, category_option_combos: DataFrame) -> DataFrame:
    """All values; an unknown category gets the default name and a flag."""
    return attach_optional(
        values,
        category_option_combos,
        COMBO_ON,
        COMBO_ATTRS,
        missing_flag=COMBO_FLAG,
        defaults={"coc_name": DEFAULT_COMBO_NAME},
    )


def orphaned_combos(resolved: DataFrame) -> DataFrame:
    return resolved.where(F.col(COMBO_FLAG))
