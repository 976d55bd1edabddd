"""Landing records derived from the tables, and the stages built on them."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reportmart.operators.quality import flag_outliers
from reportmart.operators.resolve import ELEMENT_ON, known, resolve_combos, resolve_elements
from reportmart.operators.rules import landing_rules, valid_rows, with_reason
from reportmart.operators.star import build_fact
from reportmart.operators.tree import UNIT_ON, flatten_tree, resolve_units
from reportmart.plans.reporting import clean, describe
from reportmart.sources.landing import (
    Landing,
    flatten_combos,
    flatten_elements,
    flatten_memberships,
    flatten_programs,
    flatten_units,
    flatten_values,
)
from reportmart.sources.staging import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _cell(discount: float, tax: float) -> Column:
    return (F.col("l_discount") == discount) & (F.col("l_tax") == tax)


def value_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One reported value per line, as it would land."""
    shipped = F.to_date("l_shipdate")
    day = shipped.cast("string")
    month = F.substring(day, 1, 7)
    amount = F.col("l_quantity").cast("int")
    midnight = F.lit("T00:00:00.000")
    updated = F.date_add(shipped, F.col("l_linenumber") * 20).cast("string")
    return table(spark, sf_dir, "lineitem").select(
        F.when(_cell(0.1, 0.08), "DE_GHOST")
        .when(_cell(0.1, 0.07), None)
        .otherwise(F.concat(F.lit("DE_"), "l_returnflag", "l_linestatus"))
        .alias("dataElement"),
        F.when(_cell(0.0, 0.0), None)
        .when(_cell(0.0, 0.08), month)
        .otherwise(F.replace(month, F.lit("-"), F.lit("")))
        .alias("period"),
        F.when(_cell(0.1, 0.0), "")
        .when(_cell(0.1, 0.01), "OU_GHOST")
        .otherwise(F.concat(F.lit("OU_S"), F.col("l_suppkey").cast("string")))
        .alias("orgUnit"),
        F.when(F.col("l_linenumber") < 7, F.concat(F.lit("COC_"), F.col("l_linenumber")))
        .alias("categoryOptionCombo"),
        F.when(F.col("l_tax") == 0.0, "0")
        .when(F.col("l_tax") == 0.08, None)
        .when(_cell(0.05, 0.07), " ")
        .when(_cell(0.05, 0.06), "N/A")
        .when((F.col("l_tax") == 0.05) & (F.col("l_quantity") == 50), (amount * 100).cast("string"))
        .otherwise(amount.cast("string"))
        .alias("value"),
        F.concat(F.date_add(shipped, 5).cast("string"), midnight).alias("created"),
        F.when(F.col("l_discount") == 0.03, None)
        .when(F.col("l_discount") == 0.04, updated)
        .otherwise(F.concat(updated, midnight))
        .alias("lastUpdated"),
        F.concat_ws("-", "l_orderkey", "l_partkey").alias("storedBy"),
    )


def element_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One element per flag and status; the returns carry no name or types."""
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus").distinct()
    typed = F.col("l_returnflag") != "R"
    return lines.select(
        F.concat(F.lit("DE_"), "l_returnflag", "l_linestatus").alias("id"),
        F.when(typed, F.concat_ws(" ", F.lit("Lines"), "l_returnflag", "l_linestatus")).alias("name"),
        F.when(typed, "INTEGER").alias("valueType"),
        F.when(F.col("l_linestatus") == "O", "TRACKER").alias("domainType"),
        F.when(typed, F.struct(F.concat(F.lit("CC_"), "l_linestatus").alias("id"))).alias(
            "categoryCombo"
        ),
    )


def combo_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first five line numbers are registered categories."""
    lines = table(spark, sf_dir, "lineitem").where("l_linenumber <= 5")
    number = F.col("l_linenumber")
    return lines.select("l_linenumber").distinct().select(
        F.concat(F.lit("COC_"), number).alias("id"),
        F.when(number > 1, F.concat(F.lit("Line "), number)).alias("name"),
    )


def unit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region / nation / balance band / supplier. Names, levels, paths and parents
    are left out of some suppliers, to be filled in from the rest."""
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    supplier = table(spark, sf_dir, "supplier")
    band = F.floor(F.col("s_acctbal") / 2500).cast("int")
    placed = supplier.withColumn("band", band).join(
        nation, F.col("s_nationkey") == F.col("n_nationkey")
    )
    r = F.concat(F.lit("OU_R"), F.col("r_regionkey"))
    of_region = F.concat(F.lit("/OU_R"), F.col("n_regionkey"))
    n = F.concat(F.lit("OU_N"), F.col("n_nationkey"))
    b = F.concat(n, F.lit("B"), F.col("band"))
    s = F.concat(F.lit("OU_S"), F.col("s_suppkey"))

    def record(df: DataFrame, id_: Column, name: Column, level: Column, path: Column, parent: Column):
        return df.select(
            id_.alias("id"),
            name.alias("name"),
            level.cast("int").alias("level"),
            path.alias("path"),
            F.when(parent.isNotNull(), F.struct(parent.alias("id"))).alias("parent"),
        )

    no_parent = F.lit(None).cast("string")
    balance = F.col("s_acctbal")
    return (
        record(region, r, F.col("r_name"), F.lit(1), F.concat(F.lit("/"), r), no_parent)
        .unionByName(
            record(nation, n, F.col("n_name"), F.lit(2), F.concat_ws("/", of_region, n), no_parent)
        )
        .unionByName(
            record(
                placed.select("n_nationkey", "n_regionkey", "n_name", "band").distinct(),
                b,
                F.concat_ws(" ", F.col("n_name"), F.lit("band"), F.col("band")),
                F.lit(3),
                F.concat_ws("/", of_region, n, b),
                n,
            )
        )
        .unionByName(
            record(
                placed,
                s,
                F.when(balance >= 0, F.col("s_name")),
                F.when(balance <= 9000, F.lit(4)),
                F.when(~balance.between(4000, 4100), F.concat_ws("/", of_region, n, b, s)),
                F.when(balance >= 5000, b),
            )
        )
    )


def program_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns and sales programmes per region. One region's sales programme lists
    no elements; one region audits an element that its returns programme has too."""
    region = table(spark, sf_dir, "region")

    def programs(df: DataFrame, code: str, name: Column, area: str, elements: Column) -> DataFrame:
        return df.select(
            F.concat(F.lit(f"PR_{code}_"), F.col("r_regionkey")).alias("id"),
            name.alias("name"),
            F.lit(area).alias("healthArea"),
            F.col("r_name").alias("country"),
            F.lit("Monthly").alias("reportingFrequency"),
            elements.alias("dataElements"),
        )

    def ids(*codes: str) -> Column:
        return F.array(*(F.lit(f"DE_{code}") for code in codes))

    unnamed = F.lit(None).cast("string")
    return (
        programs(region, "RET", unnamed, "Returns", ids("RF", "RO", "AF", "AO"))
        .unionByName(
            programs(
                region,
                "SAL",
                F.concat_ws(" ", F.lit("Sales"), "r_name"),
                "Sales",
                F.when(F.col("r_name") != "ASIA", ids("NF", "NO")),
            )
        )
        .unionByName(
            programs(region.where("r_name = 'EUROPE'"), "AUD", unnamed, "Audit", ids("RF"))
        )
    )


@lru_cache(maxsize=None)
def _registries(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    programs = program_records(spark, sf_dir)
    units = stage(flatten_units(unit_records(spark, sf_dir)), "units")
    return {
        "elements": stage(flatten_elements(element_records(spark, sf_dir)), "elements"),
        "combos": stage(flatten_combos(combo_records(spark, sf_dir)), "combos"),
        "units": units,
        "tree": stage(flatten_tree(units), "tree"),
        "programs": stage(flatten_programs(programs), "programs"),
        "bridge": stage(flatten_memberships(programs), "programme-elements"),
    }


def registry(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A small table that many queries look things up in, staged once per session."""
    return _registries(spark, sf_dir)[name]


@lru_cache(maxsize=None)
def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The values as landed: written once per session, as an export would be, by the tasks
    that read the lines, without a shuffle of them all."""
    return stage(flatten_values(value_records(spark, sf_dir)), "landed-values")


def landing(spark: SparkSession, sf_dir: str) -> Landing:
    """The flat tables, as if read from landing documents."""
    return Landing(
        values=landed(spark, sf_dir),
        data_elements=registry(spark, sf_dir, "elements"),
        org_units=registry(spark, sf_dir, "units"),
        category_option_combos=registry(spark, sf_dir, "combos"),
        programs=registry(spark, sf_dir, "programs"),
        de_program=registry(spark, sf_dir, "bridge"),
    )


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_reason(landed(spark, sf_dir), landing_rules())


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return valid_rows(checked(spark, sf_dir))


def described(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid values with element and category names."""
    known_rows = resolve_elements(valid(spark, sf_dir), registry(spark, sf_dir, "elements"))
    return resolve_combos(known_rows, registry(spark, sf_dir, "combos"))


def resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve_units(described(spark, sf_dir), registry(spark, sf_dir, "tree"))


def known_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid values of known elements and units, without names."""
    rows = known(valid(spark, sf_dir), registry(spark, sf_dir, "elements"), ELEMENT_ON)
    return known(rows, registry(spark, sf_dir, "tree"), UNIT_ON)


def flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per key with all flags."""
    return flag_outliers(stage(clean(known_rows(spark, sf_dir)), "cleaned"), exact=True)


@lru_cache(maxsize=None)
def flagged_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagged values with their staged rows and limits, made once per session."""
    return flagged(spark, sf_dir)


def named(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    """Values with the names of element, category and location."""
    return describe(rows, *(registry(spark, sf_dir, name) for name in ("elements", "combos", "tree")))


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per key with all flags and names."""
    return named(spark, sf_dir, flagged(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_fact(cleaned(spark, sf_dir), registry(spark, sf_dir, "bridge"))


@lru_cache(maxsize=None)
def cleaned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned values, of which the rows and limits are staged and shared. Names are
    attached where they are read, so that no column is made or written that a query does
    not read."""
    return named(spark, sf_dir, flagged_table(spark, sf_dir))


@lru_cache(maxsize=None)
def fact_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact over the shared cleaned values. As with them, a query makes only the columns
    it reads; ``sink_fact`` writes them all."""
    return build_fact(cleaned_table(spark, sf_dir), registry(spark, sf_dir, "bridge"))
