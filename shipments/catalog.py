"""One query per operator, each over the whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from reportmart.operators import anomaly, drift, quality, quantiles, resolve, rollups, rules, star, tree, trends
from reportmart.operators import value_sketches
from reportmart.operators.contract import (
    FACT_CONTRACT,
    ColumnSpec,
    Constraint,
    Contract,
    contract_report,
)
from reportmart.plans.reporting import run
from reportmart.sources import landing as land
from reportmart.sources.releases import Releases
from reportmart.sources.staging import new_path, stage
from reportmart.sources.tables import write_table
from reportmart.streaming.incremental import loaded_periods, new_periods

from . import model
from .model import registry, table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

CUTOFF = "199901"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    """Means and deviations depend in their last digits on the order of addition."""
    return df.withColumns({c: F.round(c, digits) for c in columns})


def through_documents(df: DataFrame, array: str, record: str) -> DataFrame:
    """Write records as JSON documents, one per line, and read them as landed."""
    path = new_path(df.sparkSession, "documents")
    document = F.to_json(F.struct(F.array(F.struct("*")).alias(array)))
    df.select(document.alias("value")).write.text(path)
    return land.read_records(df.sparkSession, path, array, record, "lines")


# --- landing -----------------------------------------------------------------


@query
def landing_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = model.value_records(spark, sf_dir)
    return land.flatten_values(through_documents(records, "dataValues", land.VALUE_RECORD))


@query
def landing_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = model.element_records(spark, sf_dir)
    return land.flatten_elements(through_documents(records, "dataElements", land.ELEMENT_RECORD))


@query
def landing_combos(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = model.combo_records(spark, sf_dir)
    return land.flatten_combos(through_documents(records, "categoryOptionCombos", land.COMBO_RECORD))


@query
def landing_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = model.unit_records(spark, sf_dir)
    return land.flatten_units(through_documents(records, "organisationUnits", land.UNIT_RECORD))


@query
def landing_programs(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = model.program_records(spark, sf_dir)
    return land.flatten_programs(through_documents(records, "programs", land.PROGRAM_RECORD))


@query
def landing_explode_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = model.program_records(spark, sf_dir)
    return land.flatten_memberships(through_documents(records, "programs", land.PROGRAM_RECORD))


@query
def landing_json_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.from_json("props", "k STRING", {"mode": "FAILFAST"})
    return table(spark, sf_dir, "events").select("event_id", props["k"].alias("k"))


# --- row rules ---------------------------------------------------------------


@query
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quarantine_table(model.checked(spark, sf_dir))


@query
def valid_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.valid(spark, sf_dir)


@query
def quarantine_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quarantine_rate(model.checked(spark, sf_dir))


# --- resolution --------------------------------------------------------------


@query
def resolve_reject(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.resolve_elements(model.valid(spark, sf_dir), registry(spark, sf_dir, "elements"))


@query
def resolve_rejected_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.unresolved_elements(
        model.valid(spark, sf_dir), registry(spark, sf_dir, "elements")
    )


@query
def resolve_flag_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.described(spark, sf_dir)


@query
def orphaned_combos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.orphaned_combos(model.described(spark, sf_dir))


@query
def label_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagging lookup on the documents and their labels."""
    labels = table(spark, sf_dir, "labels").withColumn("quality", F.col("quality").cast("string"))
    return resolve.attach_optional(
        table(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars"),
        labels,
        {"doc_id": "doc_id"},
        {"quality": "quality_label"},
        missing_flag="is_unlabelled",
        defaults={"quality_label": "none"},
    )


@query
def repeated_registry_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resolve.repeated_keys(registry(spark, sf_dir, "bridge"), ["de_id", "country"])


@query
def tree_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.flatten_tree(registry(spark, sf_dir, "units"))


@query
def resolve_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return model.resolved(spark, sf_dir)


@query
def orphaned_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree.unresolved_units(
        model.described(spark, sf_dir), registry(spark, sf_dir, "units")
    )


# --- quality -----------------------------------------------------------------


@query
def dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.distinct_copies(model.known_rows(spark, sf_dir))


@query
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.latest_per_key(model.known_rows(spark, sf_dir))


@query
def dedup_latest_line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest shipment per order line, over the raw line table."""
    return quality.latest_per_key(
        table(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        [F.desc("l_shipdate"), F.desc("l_partkey"), F.desc("l_suppkey")],
    )


@query
def duplicate_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.duplicate_tally(model.known_rows(spark, sf_dir))


@query
def value_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_value_flags(model.valid(spark, sf_dir))


@query
def late_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.with_late_flag(model.valid(spark, sf_dir))


@query
def outlier_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.outlier_limits(model.cleaned_table(spark, sf_dir), exact=True)


#: So few rows a task that every series and every bracket is split, at any scale.
SPLIT_ROWS = 20


@query
def outlier_limits_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The exact limits, with the values of all brackets ordered over many tasks."""
    values = model.cleaned_table(spark, sf_dir)
    quartiles = quantiles.exact_quantiles(
        values, "dataElement", "typed_value", quality.QUARTILES, accuracy=20, rows_per_task=SPLIT_ROWS
    )
    return quality.with_fences(quartiles)


def kept_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The sketches after a load of the early months and one of the later ones."""
    values = model.cleaned_table(spark, sf_dir)
    path = new_path(spark, "value-sketches")
    for months in (F.col("period") < CUTOFF, F.col("period") >= CUTOFF):
        found = value_sketches.sketch_values(values.where(months))
        write_table(found, path, partition_by=["period"], replace="touched")
    return spark.read.schema(found.schema).parquet(path)


@query
def sketched_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the quartiles of kept sketches have the ranks they should, by counting."""
    values = model.cleaned_table(spark, sf_dir).where("typed_value IS NOT NULL")
    kept = stage(kept_sketches(spark, sf_dir), "kept-sketches")
    limits = stage(value_sketches.sketched_limits(kept), "sketched-limits")
    n_kept = kept.groupBy("dataElement").agg(F.sum("n").alias("n_kept"))
    counted = values.join(limits, "dataElement").groupBy("dataElement").agg(
        F.count(F.lit(1)).alias("n_values"),
        *(F.avg((F.col("typed_value") < F.col(q)).cast("int")).alias(f"{q}_below") for q in quality.QUARTILES),
        *(F.avg((F.col("typed_value") <= F.col(q)).cast("int")).alias(f"{q}_upto") for q in quality.QUARTILES),
    )
    error = value_sketches.RANK_ERROR

    def in_rank(name: str, p: float) -> Column:
        return (F.col(f"{name}_below") <= p + error) & (F.col(f"{name}_upto") >= p - error)

    return counted.join(n_kept, "dataElement").select(
        "dataElement", "n_values", "n_kept", *(in_rank(q, p).alias(f"{q}_in_rank") for q, p in quality.QUARTILES.items())
    )


@query
def moved_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of the early months whose flag the later ones change, found in those months
    only that the kept sketches name."""
    values = model.cleaned_table(spark, sf_dir)
    early = values.where(F.col("period") < CUTOFF)
    before = stage(quality.outlier_limits(early, exact=True), "early-limits")
    after = stage(quality.outlier_limits(values, exact=True), "all-limits")
    kept = kept_sketches(spark, sf_dir).where(F.col("period") < CUTOFF)
    parts = stage(value_sketches.moved_parts(kept, before, after), "moved-parts")
    rows = early.join(parts, "period", "left_semi").select("dataElement", "period", "orgUnit", "categoryOptionCombo", "typed_value")
    was = quality.with_outlier_flag(rows, before).withColumnRenamed("is_outlier", "was_outlier")
    return quality.with_outlier_flag(was, after).where("was_outlier <> is_outlier")


@query
def iqr_outlier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flagged_events(spark, sf_dir).where("is_outlier")


def flagged_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "value")
    return quality.flag_outliers(events, "event_type", "value", exact=True)


@query
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.completeness(model.cleaned_table(spark, sf_dir))


@query
def dq_tally(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = model.cleaned_table(spark, sf_dir)
    return rounded(
        quality.quality_tally(cleaned, quality.completeness(cleaned)), "avg_completeness_pct"
    )


# --- star schema -------------------------------------------------------------


@query
def fact_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole chain from the landed values, nothing reused but the registries."""
    return model.fact(spark, sf_dir)


@query
def fact_nonempty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.row_gate(model.fact_table(spark, sf_dir))


@query
def dim_data_element(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.build_dimension("dim_data_element", registry(spark, sf_dir, "elements"))


@query
def dim_org_unit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.build_dimension("dim_org_unit", registry(spark, sf_dir, "units"))


@query
def dim_program(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.build_dimension("dim_program", registry(spark, sf_dir, "programs"))


@query
def dim_period(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.period_dimension(model.fact_table(spark, sf_dir))


# --- contract ----------------------------------------------------------------


@query
def contract_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contract_report(model.fact_table(spark, sf_dir), FACT_CONTRACT)


LINE_CONTRACT = Contract(
    name="lines",
    columns=(
        ColumnSpec("l_orderkey", "long", nullable=False, min=0),
        ColumnSpec("l_quantity", "integer", max=49),
        ColumnSpec("l_comment"),
    ),
    constraints=(
        Constraint("taxed", "l_tax > 0"),
        Constraint("null_passes", "nullif(l_tax, 0) >= 0.05"),
        Constraint("no_such_column", "l_nothing > 0"),
    ),
    min_rows=100,
)


@query
def contract_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = contract_report(table(spark, sf_dir, "lineitem"), LINE_CONTRACT)
    # the engine's own wording of an analysis error is left out
    return report.drop("detail")


# --- incremental -------------------------------------------------------------


def loaded_fact(spark: SparkSession, sf_dir: str) -> str:
    """A fact that holds the periods before the cutoff."""
    path = new_path(spark, star.FACT_NAME)
    star.write_fact(model.fact_table(spark, sf_dir).where(F.col("period") < CUTOFF), path)
    return path


@query
def loaded_period_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return loaded_periods(spark, loaded_fact(spark, sf_dir))


@query
def new_period_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    loaded = loaded_periods(spark, loaded_fact(spark, sf_dir))
    return new_periods(model.valid(spark, sf_dir), loaded, reprocess=["199701"])


@query
def incremental_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Load the late periods beside the early ones, then read everything back."""
    path = loaded_fact(spark, sf_dir)
    late = model.fact_table(spark, sf_dir).where(F.col("period") >= CUTOFF)
    star.write_fact(late, path, replace="touched")
    return (
        spark.read.schema(late.schema).parquet(path)
        .groupBy("health_area", "period")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.sum("typed_value").alias("total"))
    )


# --- analytics ---------------------------------------------------------------


@query
def monthly_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.monthly_volume(model.fact_table(spark, sf_dir))


@query
def kpi_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(trends.kpi_summary(model.fact_table(spark, sf_dir)), "mean", "stddev")


@query
def period_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.period_change(model.fact_table(spark, sf_dir))


@query
def nation_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change of the monthly order value per nation of the customer."""
    cents = F.round(F.col("o_totalprice") * 100).cast("long")
    orders = (
        table(spark, sf_dir, "orders")
        .join(table(spark, sf_dir, "customer"), F.col("o_custkey") == F.col("c_custkey"))
        .join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            "r_name", "n_name",
            F.date_format("o_orderdate", "yyyyMM").alias("period"),
            cents.alias("cents"),
        )
    )
    return trends.period_change(orders, ["r_name", "n_name"], value="cents", total="total_cents")


@query
def rolling_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.rolling_average(model.fact_table(spark, sf_dir))


@query
def rolling_avg_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rolling average with long series windowed by chunk."""
    return trends.rolling_average(model.fact_table(spark, sf_dir), rows_per_task=SPLIT_ROWS)


@query
def rolling_avg_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.rolling_average_by_month(model.fact_table(spark, sf_dir))


@query
def reporting_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.reporting_rate(model.fact_table(spark, sf_dir), registry(spark, sf_dir, "tree"))


@query
def underreporters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trends.underreporters(model.fact_table(spark, sf_dir))


# --- cross country -----------------------------------------------------------


@query
def country_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(rollups.country_kpis(model.fact_table(spark, sf_dir)), "mean_per_report")


@query
def quarterly_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.quarterly_volumes(model.fact_table(spark, sf_dir))


ELEMENT_NAMES = ("Lines A F", "Lines A O", "Lines N F", "Lines N O", "DE_RF", "DE_RO")


@query
def coverage_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.coverage_matrix(model.fact_table(spark, sf_dir), ELEMENT_NAMES)


@query
def coverage_matrix_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pivot with its columns found in the data."""
    return rollups.coverage_matrix(model.fact_table(spark, sf_dir))


@query
def completeness_by_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality.completeness(model.cleaned_table(spark, sf_dir))
    return rounded(rollups.completeness_by_country(scores), "avg_completeness_pct")


@query
def low_streaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = quality.completeness(model.cleaned_table(spark, sf_dir))
    return rounded(rollups.low_streaks(scores), "avg_completeness_pct")


@query
def global_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.global_totals(model.fact_table(spark, sf_dir))


# --- anomalies ---------------------------------------------------------------


@query
def zscore_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anomaly.detect_anomalies(model.fact_table(spark, sf_dir), max_growth_pct=None)
    return rounded(found, "z_score")


@query
def spike_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(anomaly.detect_anomalies(model.fact_table(spark, sf_dir), max_z=None), "z_score")


@query
def anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(anomaly.detect_anomalies(model.fact_table(spark, sf_dir)), "z_score")


@query
def anomalies_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The findings with long series windowed by chunk."""
    fact = model.fact_table(spark, sf_dir)
    return rounded(anomaly.detect_anomalies(fact, rows_per_task=SPLIT_ROWS), "z_score")


@query
def event_anomalies(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = anomaly.detect_anomalies(
        table(spark, sf_dir, "events"),
        keys=["user_id", "event_type"],
        order=["ts", "event_id"],
        value="value",
        columns=["event_id", "user_id", "event_type", "value"],
    )
    return rounded(found, "z_score")


# --- drift -------------------------------------------------------------------


def _snapshot(parts: DataFrame, name: Column) -> DataFrame:
    entries = parts.select(F.col("p_partkey").cast("string").alias("id"), name.alias("name"))
    return drift.registry_snapshot(entries)


def earlier_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _snapshot(table(spark, sf_dir, "part").where("p_size > 5"), F.col("p_name"))


def later_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.when(F.col("p_brand") == "Brand#13", F.upper("p_name")).otherwise(F.col("p_name"))
    return _snapshot(table(spark, sf_dir, "part").where("p_size <= 45"), name)


@query
def drift_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.detect_drift(later_parts(spark, sf_dir), None)


@query
def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.detect_drift(later_parts(spark, sf_dir), earlier_parts(spark, sf_dir))


@query
def drift_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.drift_counts(drift_report(spark, sf_dir))


@query
def snapshot_rollforward(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Save two versions; the second is what the next run compares with."""
    path = new_path(spark, "snapshots")
    drift.save_snapshot(earlier_parts(spark, sf_dir), path)
    drift.save_snapshot(later_parts(spark, sf_dir), path)
    return drift.latest_snapshot(spark, path)


# --- sinks and the whole run -------------------------------------------------


@query
def sink_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact written by health area and month and read back."""
    fact = model.fact_table(spark, sf_dir)
    path = new_path(spark, star.FACT_NAME)
    star.write_fact(fact, path)
    return spark.read.schema(fact.schema).parquet(path)


@query
def sink_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Set-aside rows written as CSV with a header and read back."""
    rows = rules.quarantine_table(model.checked(spark, sf_dir))
    path = new_path(spark, "quarantine")
    write_table(rows, path, fmt="csv")
    return spark.read.schema(rows.schema).option("header", True).csv(path)


@query
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = run(
        spark,
        model.landing(spark, sf_dir),
        new_path(spark, "warehouse"),
        exact_quartiles=True,
        count_duplicates=True,
    )
    frame = report.as_frame(spark).drop("seconds")
    return rounded(frame, "quarantine_pct", "avg_completeness_pct")


@lru_cache(maxsize=2)
def loaded_in_two(spark: SparkSession, sf_dir: str, releases: bool = False) -> str:
    """The folder of a run over the early months, then an incremental run over all of them.
    Several queries look at the outputs of the same two runs."""
    target = new_path(spark, "warehouse")
    whole = model.landing(spark, sf_dir)
    early = {**vars(whole), "values": whole.values.where(F.col("period") < CUTOFF)}
    run(spark, land.Landing(**early), target, exact_quartiles=True, releases=releases)
    run(spark, whole, target, mode="incremental", exact_quartiles=True, releases=releases)
    return target


@query
def run_released_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of the newest release: partitions of both loads."""
    return Releases(spark, loaded_in_two(spark, sf_dir, True)).read(star.FACT_NAME)


@query
def run_release_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals by country of each release; the first stays as it was read after it."""
    target = loaded_in_two(spark, sf_dir, True)
    found = [
        Releases(spark, target, number)
        .read(star.FACT_NAME)
        .groupBy(F.lit(number).alias("release"), "country_name")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("typed_value").alias("total"),
            F.max("period").alias("last_period"),
        )
        for number in (1, 2)
    ]
    return found[0].union(found[1])


@query
def run_incremental_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact of an incremental load: every column as a full load gives it."""
    fact = spark.read.parquet(f"{loaded_in_two(spark, sf_dir)}/{star.FACT_NAME}")
    return fact.withColumn("year_month", F.col("year_month").cast("string"))


@query
def run_incremental_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The completeness of an incremental load."""
    scores = spark.read.parquet(f"{loaded_in_two(spark, sf_dir)}/completeness_scores")
    return scores.withColumn("period", F.col("period").cast("string"))


@query
def run_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run over the early months, then an incremental run over all of them."""
    target = loaded_in_two(spark, sf_dir)
    return (
        spark.read.parquet(f"{target}/{star.FACT_NAME}")
        .groupBy("country_name", "quarter", "year")
        .agg(
            F.count(F.lit(1)).alias("n_rows"),
            F.sum("typed_value").alias("total"),
            F.count_if("is_late_reported").alias("n_late"),
        )
    )


# Reports of an incremental load, which come from kept unit totals.


@query
def run_incremental_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spark.read.parquet(f"{loaded_in_two(spark, sf_dir)}/cross_country_kpis")
    return rounded(found, "mean_per_report")


@query
def run_incremental_quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{loaded_in_two(spark, sf_dir)}/cross_country_quarterly")


@query
def run_incremental_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{loaded_in_two(spark, sf_dir)}/cross_country_coverage_matrix")


@query
def run_incremental_global(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{loaded_in_two(spark, sf_dir)}/global_aggregation")


@query
def run_incremental_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{loaded_in_two(spark, sf_dir)}/analytics_monthly_volume")


@query
def run_incremental_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{loaded_in_two(spark, sf_dir)}/analytics_reporting_rate")
