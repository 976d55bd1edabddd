"""The fact table and its dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import natural_key, period_month, period_year, quarter_label, year_month
from ..sources.tables import write_table
from .errors import GateError
from .resolve import attach_optional

# Layout and names of the warehouse tables.
FACT_NAME = "fact_service_delivery"
FACT_PARTITIONS = ("health_area", "year_month")
FACT_KEY = ("dataElement", "period", "orgUnit", "categoryOptionCombo")
WAREHOUSE_NAMES = {
    "dataElement": "data_element_id",
    "orgUnit": "org_unit_id",
    "categoryOptionCombo": "coc_id",
    "lastUpdated": "last_updated",
}
FACT_COLUMNS = """
    fact_id period year month quarter year_month date_key
    org_unit_id facility_name facility_level ou_path country_name region_name district_name
    data_element_id data_element_name valueType domainType program_id health_area
    coc_id coc_name is_orphaned_coc value typed_value is_explicit_zero is_missing_value
    is_late_reported is_outlier created last_updated storedBy
""".split()
PERIOD_COLUMNS = ("period", "year", "month", "quarter", "year_month")
DIMENSION_NAMES = {
    "dim_data_element": {
        "id": "data_element_id",
        "name": "data_element_name",
        "valueType": "value_type",
        "domainType": "domain_type",
        "categoryComboId": "category_combo_id",
    },
    "dim_org_unit": {
        "id": "org_unit_id",
        "name": "org_unit_name",
        "level": "ou_level",
        "path": "ou_path",
        "parentId": "parent_id",
    },
    "dim_program": {
        "id": "program_id",
        "name": "program_name",
        "healthArea": "health_area",
        "country": "country",
        "reportingFrequency": "reporting_frequency",
    },
}


def time_columns(period: str = "period") -> dict[str, Column]:
    text = F.col(period)
    return {
        "year": period_year(text),
        "month": period_month(text),
        "quarter": quarter_label(period_month(text)),
        "year_month": year_month(text),
        "date_key": year_month(text),
    }


def with_programs(df: DataFrame, de_program: DataFrame) -> DataFrame:
    """Attach programme and health area by element and country. An element that
    two programmes of one country list yields a row for each."""
    return attach_optional(
        df,
        de_program,
        {"dataElement": "de_id", "country_name": "country"},
        {"program_id": "program_id", "health_area": "health_area"},
    )


def build_fact(cleaned: DataFrame, de_program: DataFrame, also: Sequence[str] = ()) -> DataFrame:
    """The fact table of cleaned values, in warehouse layout, and the columns ``also``."""
    keyed = with_programs(cleaned, de_program).withColumns(
        {"fact_id": natural_key(FACT_KEY), **time_columns()}
    )
    return keyed.withColumnsRenamed(WAREHOUSE_NAMES).select(*FACT_COLUMNS, *also)


def derived_columns() -> dict[str, Column]:
    """Columns of the fact, none of its partitions, that follow from its others. The row id
    alone, which nothing compresses, is a fifth of what a row takes in a shuffle."""
    key = [WAREHOUSE_NAMES.get(c, c) for c in FACT_KEY]
    found = {"fact_id": natural_key(key), **time_columns()}
    return {name: column for name, column in found.items() if name not in FACT_PARTITIONS}


def write_fact(fact: DataFrame, path: str, *, replace: str = "all") -> None:
    """Write the fact by health area and month; see ``write_table`` for ``replace``."""
    write_table(fact, path, partition_by=FACT_PARTITIONS, replace=replace, derived=derived_columns())


def build_dimension(name: str, table: DataFrame) -> DataFrame:
    """One of ``DIMENSION_NAMES`` from the flat table behind it."""
    return table.select(*(F.col(c).alias(out) for c, out in DIMENSION_NAMES[name].items()))


def period_dimension(fact: DataFrame) -> DataFrame:
    """The months the fact has rows for, in order."""
    return fact.select(*PERIOD_COLUMNS).distinct().orderBy("period")


def row_gate(fact: DataFrame) -> DataFrame:
    """One row: the number of rows and whether there are any."""
    return fact.agg(F.count(F.lit(1)).alias("fact_rows")).withColumn(
        "passed", F.col("fact_rows") > 0
    )


def check_nonempty(fact: DataFrame, name: str = FACT_NAME) -> None:
    if fact.isEmpty():
        raise GateError(f"{name} has no rows")
