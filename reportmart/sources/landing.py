"""Landing documents: JSON objects that hold arrays of records.

Three layouts of the same content are read:

``document``  one JSON object per file, of any formatting. A file is read by one
              task, so export many files rather than one large one.
``lines``     one JSON object per line, each with its own arrays. Splittable.
``records``   one document per file with one record per line between the
              brackets, as most exporters format it. Splittable, so a file that
              holds a third of all records is read by many tasks. A line does not
              say which array it is in, so a document with another array than the
              wanted one fails the read.

Schemas are fixed, never inferred, and malformed input fails the read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StructType, VariantType

# The record layouts, file names and defaults of the export format.
VALUE_RECORD = """
    dataElement STRING, period STRING, orgUnit STRING, categoryOptionCombo VARIANT,
    value STRING, created STRING, lastUpdated STRING, storedBy STRING
"""
ELEMENT_RECORD = """
    id STRING, name STRING, valueType STRING, domainType STRING, categoryCombo STRUCT<id: STRING>
"""
COMBO_RECORD = "id STRING, name STRING"
UNIT_RECORD = "id STRING, name STRING, level INT, path STRING, parent STRUCT<id: STRING>"
PROGRAM_RECORD = """
    id STRING, name STRING, healthArea STRING, country STRING, reportingFrequency STRING,
    dataElements ARRAY<STRING>
"""
DOCUMENT_FILES = {
    "values": "data_values.json",
    "metadata": "metadata.json",
    "units": "org_units.json",
    "programs": "programs.json",
}
DEFAULT_COMBO = "COC_DEF"
DEFAULT_VALUE_TYPE = "NUMBER"
DEFAULT_DOMAIN_TYPE = "AGGREGATE"

LAYOUTS = ("document", "lines", "records")


@dataclass(frozen=True)
class Landing:
    """The flat tables of one export. ``values`` is not yet checked."""

    values: DataFrame
    data_elements: DataFrame
    org_units: DataFrame
    category_option_combos: DataFrame
    programs: DataFrame
    de_program: DataFrame


def read_records(
    spark: SparkSession, path: str, array: str, record: str, layout: str = "document"
) -> DataFrame:
    """The records of one top-level array; no rows where a document lacks it."""
    if layout not in LAYOUTS:
        raise ValueError(f"layout must be one of {LAYOUTS}, not {layout!r}")
    if layout == "records":
        return _read_record_lines(spark, path, array, record)
    schema = StructType().add(array, ArrayType(StructType.fromDDL(record)))
    documents = (
        spark.read.schema(schema)
        .option("multiLine", layout == "document")
        .option("mode", "FAILFAST")
        .json(path)
    )
    return documents.select(F.inline(array))


def _read_record_lines(spark: SparkSession, path: str, array: str, record: str) -> DataFrame:
    """Records that stand one per line. The lines around them may only open or
    close the document; anything else fails the read rather than losing a record."""
    line = F.trim(F.col("value"))
    text = F.regexp_replace(line, r",$", "")
    is_record = text.rlike(r"^\{.*\}$")
    is_frame = text.rlike(r'^(\{)?\s*("[A-Za-z]+"\s*:\s*)?\[?$|^\]?\s*\}?$')
    opened = F.regexp_extract(text, r'"([A-Za-z]+)"\s*:\s*\[', 1)
    checked = (
        F.when(is_record, text)
        .when(~is_frame, F.raise_error(F.concat(F.lit("not one record per line: "), line)))
        .when(~opened.isin("", array), F.raise_error(F.concat(F.lit("another array: "), line)))
    )
    return (
        spark.read.text(path)
        .select(checked.alias("json"))
        .where(F.col("json").isNotNull())
        .select(F.from_json("json", StructType.fromDDL(record), {"mode": "FAILFAST"}).alias("r"))
        .select("r.*")
    )


def flatten_values(records: DataFrame) -> DataFrame:
    """Reported values. A record without a category gets the default one; a category
    given as null stays null. Read as a variant the two differ: the first is null,
    the second a variant that holds a null."""
    combo = F.col("categoryOptionCombo")
    if isinstance(records.schema["categoryOptionCombo"].dataType, VariantType):
        given = F.variant_get(combo, "$", "string")
        filled = F.when(~F.is_variant_null(combo), F.coalesce(given, F.lit(DEFAULT_COMBO)))
    else:
        filled = F.coalesce(combo, F.lit(DEFAULT_COMBO))
    return records.withColumn("categoryOptionCombo", filled)


def flatten_elements(records: DataFrame) -> DataFrame:
    return records.select(
        "id",
        F.coalesce("name", "id").alias("name"),
        F.coalesce("valueType", F.lit(DEFAULT_VALUE_TYPE)).alias("valueType"),
        F.coalesce("domainType", F.lit(DEFAULT_DOMAIN_TYPE)).alias("domainType"),
        F.col("categoryCombo.id").alias("categoryComboId"),
    )


def path_parts(path: Column) -> Column:
    """The ids on a ``/a/b/c`` path."""
    return F.filter(F.split(path, "/"), lambda part: part != "")


def flatten_units(records: DataFrame) -> DataFrame:
    """Units with path, level and parent filled in from one another."""
    path = F.coalesce("path", F.concat(F.lit("/"), F.col("id")))
    parts = path_parts(path)
    # one before the last; get() gives null past either end
    above = F.get(parts, F.size(parts) - 2)
    return records.select(
        "id",
        F.coalesce("name", "id").alias("name"),
        F.coalesce(F.col("level"), F.size(parts)).alias("level"),
        path.alias("path"),
        F.coalesce(F.col("parent.id"), above).alias("parentId"),
    )


def flatten_combos(records: DataFrame) -> DataFrame:
    return records.select("id", F.coalesce("name", "id").alias("name"))


def flatten_programs(records: DataFrame) -> DataFrame:
    return records.select(
        "id", F.coalesce("name", "id").alias("name"), "healthArea", "country", "reportingFrequency"
    )


def flatten_memberships(records: DataFrame) -> DataFrame:
    """One row per programme and element it lists."""
    return records.select(
        F.explode("dataElements").alias("de_id"),
        F.col("id").alias("program_id"),
        F.col("healthArea").alias("health_area"),
        "country",
    )


def unique_memberships(memberships: DataFrame, programs: DataFrame) -> DataFrame:
    """Each element of a programme once, with area and country as in ``programs``, which
    has one row per programme."""
    named = programs.select(
        F.col("id").alias("program_id"), F.col("healthArea").alias("health_area"), "country"
    )
    return memberships.select("de_id", "program_id").distinct().join(named, "program_id")


def load_landing(
    spark: SparkSession,
    folder: str,
    *,
    layout: str = "document",
    values_layout: str | None = None,
) -> Landing:
    """Read one export. Each entry of ``DOCUMENT_FILES`` may be a file or a
    folder of files of that name; ``values_layout`` is the layout of the values
    where it differs from that of the small documents."""

    def records(document: str, array: str, record: str, how: str = layout) -> DataFrame:
        return read_records(spark, f"{folder}/{DOCUMENT_FILES[document]}", array, record, how)

    programs = records("programs", "programs", PROGRAM_RECORD)
    return Landing(
        values=flatten_values(
            records("values", "dataValues", VALUE_RECORD, values_layout or layout)
        ),
        data_elements=flatten_elements(records("metadata", "dataElements", ELEMENT_RECORD)),
        org_units=flatten_units(records("units", "organisationUnits", UNIT_RECORD)),
        category_option_combos=flatten_combos(
            records("metadata", "categoryOptionCombos", COMBO_RECORD)
        ),
        programs=flatten_programs(programs),
        de_program=flatten_memberships(programs),
    )


__all__ = [
    "Landing",
    "load_landing",
    "read_records",
    "unique_memberships",
]
