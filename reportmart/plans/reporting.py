"""The whole run: landing documents in, warehouse and reports out."""

from __future__ import annotations

import time
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import asdict, dataclass
from functools import partial

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions import natural_key
from ..operators.anomaly import ANOMALY_COLUMNS, detect_anomalies
from ..operators.contract import FACT_CONTRACT, Contract, validate_contract
from ..operators.drift import detect_drift, latest_snapshot, registry_snapshot, save_snapshot
from ..operators.quality import (
    duplicate_tally,
    expected_elements,
    flag_tally_columns,
    latest_per_key,
    outlier_limits,
    reported_elements,
    score,
    with_late_flag,
    with_outlier_flag,
    with_value_flags,
)
from ..operators.resolve import (
    COMBO_FLAG,
    COMBO_ON,
    DEFAULT_COMBO_NAME,
    ELEMENT_ON,
    attach_optional,
    one_per_key,
    orphaned_combos,
    resolve_combos,
    resolve_elements,
)
from ..operators.rollups import (
    completeness_by_country,
    country_kpis,
    coverage_matrix,
    global_totals,
    low_streaks,
    quarterly_volumes,
)
from ..operators.rules import (
    MAX_QUARANTINE_PCT,
    REASON,
    check_quarantine_rate,
    landing_rules,
    quarantine_table,
    with_reason,
)
from ..operators.series import long_series
from ..operators.star import (
    DIMENSION_NAMES,
    FACT_KEY,
    FACT_NAME,
    FACT_PARTITIONS,
    WAREHOUSE_NAMES,
    build_dimension,
    build_fact,
    check_nonempty,
    derived_columns,
    period_dimension,
)
from ..operators.tree import UNIT_ON, flatten_tree, resolve_units
from ..operators.trends import (
    SERIES_KEY,
    SERIES_ORDER,
    kpi_summary,
    monthly_volume,
    period_change,
    reporting_rate,
    rolling_average,
    underreporters,
)
from ..operators.unit_bitmaps import number_units, numbered, unit_totals
from ..operators.value_sketches import moved_parts, sketch_values, sketched_limits
from ..sources.landing import Landing, load_landing, unique_memberships
from ..sources.releases import InPlace, Releases
from ..sources.staging import own_folder, stage
from ..streaming.incremental import changed_partitions, of_other_periods, periods_of

SCORES = "completeness_scores"
SKETCHES = "value_sketches"
LIMITS = "outlier_limits"
UNIT_NUMBERS = "unit_numbers"
TOTALS = "unit_totals"
SNAPSHOT = "metadata_snapshot"

#: The id of a row follows from its series, period and category, and so orders nothing.
FACT_ORDER = tuple(c for c in SERIES_ORDER if c != "fact_id")

OUTCOME = "outcome"
QUARANTINED = "quarantined"
ALREADY_LOADED = "already_loaded"
UNKNOWN_ELEMENT = "unknown_element"
UNKNOWN_UNIT = "unknown_unit"
RESOLVED = "resolved"
OUTCOMES = (QUARANTINED, ALREADY_LOADED, UNKNOWN_ELEMENT, UNKNOWN_UNIT, RESOLVED)


@dataclass(frozen=True)
class RunReport:
    """What a run did. ``finished`` is ``complete`` or ``no_new_data``."""

    finished: str
    total_rows: int
    quarantined_rows: int
    quarantine_pct: float
    already_loaded_rows: int
    unknown_element_rows: int
    orphaned_combo_rows: int
    unknown_unit_rows: int
    resolved_rows: int
    exact_duplicates: int | None
    near_duplicates: int | None
    fact_rows: int
    late_rows: int
    outlier_rows: int
    zero_rows: int
    missing_rows: int
    avg_completeness_pct: float | None
    anomalies: int
    drifted_elements: int
    seconds: float

    def as_frame(self, spark: SparkSession) -> DataFrame:
        types = {"str": "string", "int": "bigint", "float": "double"}
        fields = type(self).__dataclass_fields__.values()
        schema = ", ".join(f"{f.name} {types[f.type.split(' ')[0]]}" for f in fields)
        return spark.createDataFrame([tuple(asdict(self).values())], schema)


def route(
    values: DataFrame,
    data_elements: DataFrame,
    combos: DataFrame,
    flat_tree: DataFrame,
    loaded: DataFrame | None = None,
) -> DataFrame:
    """Every landed row with its broken rules, the orphan flag and one ``outcome``.

    Rules, both rejecting lookups and the flagging one take a single pass over
    the values instead of one pass per kept and per rejected set. Names are not
    attached yet: the rows stay narrow until they are deduplicated."""
    routed = with_reason(values, landing_rules())
    for lookup, on, flag in (
        (data_elements, ELEMENT_ON, "__no_element"),
        (combos, COMBO_ON, COMBO_FLAG),
    ):
        routed = attach_optional(routed, lookup, on, {}, missing_flag=flag)
    units = partial(attach_optional, lookup=flat_tree, on=UNIT_ON, attrs={}, missing_flag="__no_unit")
    seen = F.lit(False)
    if loaded is None:
        routed = units(routed)
    else:
        routed = attach_optional(
            routed, loaded, {"period": "period"}, {}, missing_flag="__not_loaded"
        )
        seen = ~F.col("__not_loaded")
        # The tree may be joined by shuffle: rows that are loaded already, often most, do not
        # go there.
        others = routed.where(seen).withColumn("__no_unit", F.lit(False))
        routed = units(routed.where(~seen)).unionByName(others)
    outcome = (
        F.when(F.col(REASON) != "", QUARANTINED)
        .when(seen, ALREADY_LOADED)
        .when(F.col("__no_element"), UNKNOWN_ELEMENT)
        .when(F.col("__no_unit"), UNKNOWN_UNIT)
        .otherwise(RESOLVED)
    )
    return routed.withColumn(OUTCOME, outcome).drop("__no_element", "__no_unit", "__not_loaded")


def with_outcome(routed: DataFrame, outcome: str) -> DataFrame:
    return routed.where(F.col(OUTCOME) == outcome).drop(OUTCOME)


def clean(known_rows: DataFrame) -> DataFrame:
    """Latest row per key with value and lateness flags; outliers need a second look.

    The key holds the ids that are resolved, so names may as well be attached
    afterwards, to fewer rows, and need not be shuffled with them."""
    return with_late_flag(with_value_flags(latest_per_key(known_rows)))


def describe(
    known_rows: DataFrame, data_elements: DataFrame, combos: DataFrame, flat_tree: DataFrame
) -> DataFrame:
    """Attach the names of element, category and location."""
    named = resolve_combos(resolve_elements(known_rows, data_elements), combos)
    return resolve_units(named, flat_tree)


def of_one_program(loaded: DataFrame) -> DataFrame:
    """Each value of a fact once, though an element of several programmes has a row for each.

    Values of a country, element and period were loaded together and have the same
    programmes, so the rows of the first one hold all of them, and none is shuffled."""
    group, program = ["country_name", "data_element_id", "period"], ["program_id", "health_area"]
    kept = loaded.select(*group, *program).distinct()
    kept = kept.groupBy(*group).agg(F.min(F.struct(*program)).alias("__first"))
    kept = kept.select(*(F.col(c).alias(f"__{c}") for c in group), "__first.*")
    kept = stage(kept.withColumnsRenamed({c: f"__{c}" for c in program}), "first-programmes")
    same = [F.col(c).eqNullSafe(F.col(f"__{c}")) for c in [*group, *program]]
    return loaded.join(kept, same, "left_semi")


def find_anomalies(fact: DataFrame, found: DataFrame | None = None) -> DataFrame:
    """``detect_anomalies`` over a fact, whose long row ids are made anew for the few findings
    instead of being shuffled and sorted with all rows."""
    parts = [WAREHOUSE_NAMES.get(c, c) for c in FACT_KEY]
    columns = list(dict.fromkeys([*(c for c in ANOMALY_COLUMNS if c != "fact_id"), *parts]))
    findings = detect_anomalies(fact, columns=columns, order=FACT_ORDER, found=found)
    findings = findings.withColumn("fact_id", natural_key(parts))
    return findings.select(*ANOMALY_COLUMNS, "z_score", "anomaly_type")


Reports = dict[str, Callable[[], DataFrame]]


def analytics(
    fact: DataFrame,
    flat_tree: DataFrame,
    found: DataFrame | None = None,
    totals: DataFrame | None = None,
) -> Reports:
    """The programme reports by output name; ``found`` are the fact's long series, ``totals``
    its kept unit totals."""
    return {
        "analytics_monthly_volume": lambda: monthly_volume(fact, totals=totals),
        "analytics_kpi_summary": lambda: kpi_summary(fact),
        "analytics_period_over_period": lambda: period_change(fact),
        "analytics_rolling_avg": lambda: rolling_average(fact, order=FACT_ORDER, found=found),
        "analytics_reporting_rate": lambda: reporting_rate(fact, flat_tree, totals=totals),
        "analytics_underreporters": lambda: underreporters(fact),
    }


def cross_country(fact: DataFrame, scores: DataFrame, totals: DataFrame | None = None) -> Reports:
    """The cross-country reports by output name, from kept unit totals where given."""
    matrix = partial(coverage_matrix, fact) if totals is None else partial(coverage_matrix, totals, value="total")
    return {
        "cross_country_kpis": lambda: country_kpis(fact, totals=totals),
        "cross_country_quarterly": lambda: quarterly_volumes(fact, totals=totals),
        "cross_country_coverage_matrix": matrix,
        "cross_country_completeness": lambda: completeness_by_country(scores),
        "consecutive_low_completeness": lambda: low_streaks(scores),
        "global_aggregation": lambda: global_totals(fact, totals=totals),
    }


def run(
    spark: SparkSession,
    source: str | Landing,
    target: str,
    *,
    mode: str = "full",
    reprocess: Sequence[str] = (),
    layout: str = "document",
    values_layout: str | None = None,
    fmt: str = "parquet",
    contract: Contract = FACT_CONTRACT,
    max_quarantine_pct: float = MAX_QUARANTINE_PCT,
    exact_quartiles: bool = False,
    count_duplicates: bool = False,
    concurrent_reports: int = 4,
    releases: bool = False,
    keep_releases: int = 2,
) -> RunReport:
    """Run every stage and write every output under ``target``.

    ``mode="incremental"`` loads only periods the fact lacks, plus those named in
    ``reprocess``. Outlier limits and expected elements are those of all periods, so
    the scores are written anew, and of the fact's other partitions those in which a
    flag changes. Both come from sketches that are kept beside the fact, and only months
    with a value between an old and a new limit are read; ``exact_quartiles`` reads the
    values of all months for the limits. A month named in ``reprocess`` that has rows again is replaced in
    every area. ``fmt`` is the format of the reports; the fact and the completeness
    table are Parquet.
    ``count_duplicates`` splits the removed rows into exact copies and superseded
    values, at the cost of one more shuffle. Raises ``GateError`` when too many
    rows are quarantined or no fact row results, ``ContractViolation`` when the
    fact breaks its contract.

    With ``releases`` all outputs change at once, when the last one is written, and are
    read through ``Releases(spark, target)``; the newest ``keep_releases`` can be opened.
    Otherwise each output is replaced in place, one after the other. Staged tables are
    removed when the run ends.
    """
    if mode not in ("full", "incremental"):
        raise ValueError(f"mode must be 'full' or 'incremental', not {mode!r}")
    tables = Releases(spark, target) if releases else InPlace(spark, target)
    options = {
        "mode": mode,
        "reprocess": reprocess,
        "fmt": fmt,
        "contract": contract,
        "max_quarantine_pct": max_quarantine_pct,
        "exact_quartiles": exact_quartiles,
        "count_duplicates": count_duplicates,
        "concurrent_reports": concurrent_reports,
    }
    with own_folder(spark):
        landing = source
        if not isinstance(landing, Landing):
            landing = load_landing(spark, source, layout=layout, values_layout=values_layout)
        report = load(landing, tables, **options)
        tables.commit()
    if releases:
        tables.sweep(keep_releases)
    return report


def load(
    landing: Landing,
    tables: InPlace | Releases,
    *,
    mode: str,
    reprocess: Sequence[str],
    fmt: str,
    contract: Contract,
    max_quarantine_pct: float,
    exact_quartiles: bool,
    count_duplicates: bool,
    concurrent_reports: int,
) -> RunReport:
    """The stages of ``run``: read and write the tables of a warehouse, without committing."""
    spark = tables.spark
    started = time.monotonic()

    def publish(name: str, df: DataFrame) -> None:
        tables.write(df, name, fmt=fmt)

    elements = stage(one_per_key(landing.data_elements, ["id"]), "elements")
    combos = stage(one_per_key(landing.category_option_combos, ["id"]), "combos")
    units = stage(one_per_key(landing.org_units, ["id"]), "units")
    tree = stage(flatten_tree(units), "tree")
    programs = stage(one_per_key(landing.programs, ["id"]), "programmes")
    bridge = stage(unique_memberships(landing.de_program, programs), "programme-elements")

    loaded, known_numbers = None, None
    # All units of the registry are numbered, so that values get the number with the names.
    listed = units.select(F.col("id").alias("org_unit_id"))
    if mode == "incremental":
        known_fact = tables.read(FACT_NAME)
        if known_fact is not None:
            loaded = stage(periods_of(known_fact), "loaded-periods")
            if reprocess:
                loaded = loaded.where(~F.col("period").isin(*reprocess))
            known_numbers = tables.read(UNIT_NUMBERS)
            if known_numbers is None or known_numbers.isEmpty():
                # A fact from before totals were kept, or a run that ended early: totals are
                # made from all of it, once.
                known_numbers = None
                listed = listed.union(known_fact.select("org_unit_id"))
    numbers = number_units(listed, known_numbers)
    numbers = stage(numbers if known_numbers is None else numbers.union(known_numbers), "unit-numbers")
    numbered_tree = stage(numbered(tree, numbers, of="id"), "numbered-tree")

    # One pass over the landed values: check, resolve, route, count.
    seen = Observation("routing")
    routed = route(landing.values, elements, combos, tree, loaded).observe(
        seen,
        *(F.count_if(F.col(OUTCOME) == outcome).alias(outcome) for outcome in OUTCOMES),
        F.count_if(
            F.col(COMBO_FLAG) & F.col(OUTCOME).isin(UNKNOWN_UNIT, RESOLVED)
        ).alias("orphaned_combos"),
    )
    # Rows of loaded periods are counted and go no further.
    routed = routed.where(F.col(OUTCOME) != ALREADY_LOADED)
    routed = stage(routed, "routed", partition_by=[OUTCOME])
    n = seen.get
    total = sum(n[outcome] for outcome in OUTCOMES)
    pct = check_quarantine_rate(total, n[QUARANTINED], max_quarantine_pct)
    publish("quarantine", quarantine_table(with_outcome(routed, QUARANTINED)))

    def report(finished: str, **found: int | float | None) -> RunReport:
        empty = {
            name: None if name in ("exact_duplicates", "near_duplicates") else 0
            for name in RunReport.__dataclass_fields__
        } | {"avg_completeness_pct": None}
        return RunReport(
            **empty
            | {
                "finished": finished,
                "total_rows": total,
                "quarantined_rows": n[QUARANTINED],
                "quarantine_pct": pct,
                "already_loaded_rows": n[ALREADY_LOADED],
                "unknown_element_rows": n[UNKNOWN_ELEMENT],
                "orphaned_combo_rows": n["orphaned_combos"],
                "unknown_unit_rows": n[UNKNOWN_UNIT],
                "resolved_rows": n[RESOLVED],
                "seconds": time.monotonic() - started,
            }
            | found
        )

    if mode == "incremental" and total == n[QUARANTINED] + n[ALREADY_LOADED]:
        return report("no_new_data")

    publish("unresolvable_data_elements", with_outcome(routed, UNKNOWN_ELEMENT).drop(REASON))
    rows = routed.drop(REASON, COMBO_FLAG)
    no_unit = resolve_elements(with_outcome(rows, UNKNOWN_UNIT), elements)
    publish("orphaned_org_units", resolve_combos(no_unit, combos))
    orphaned = orphaned_combos(routed.where(F.col(OUTCOME).isin(UNKNOWN_UNIT, RESOLVED)))
    publish(
        "unresolvable_coc",
        resolve_elements(orphaned.drop(OUTCOME, REASON), elements).withColumn(
            "coc_name", F.lit(DEFAULT_COMBO_NAME)
        ),
    )

    resolved = with_outcome(rows, RESOLVED)
    # Values meet the tree once after routing: each unit is there, and there once, so that the
    # rows stay the same, and all that follows finds the names of the locations with them.
    cleaned = stage(resolve_units(clean(resolved), numbered_tree), "cleaned")
    # Staged, so that loaded rows are set against few periods of known size, not shuffled by them.
    arrived = stage(cleaned.select("period").distinct(), "arrived-periods")
    # Limits and expected elements are those of all periods, loaded ones included.
    seen_in = cleaned.select("country_name", "dataElement")
    measured = cleaned.select("dataElement", "typed_value")
    actual = reported_elements(cleaned)
    sketches = stage(sketch_values(cleaned), "value-sketches")
    all_sketches, kept = sketches, None
    if loaded is not None:
        # A period reads back as a number unless its type is given.
        kept = tables.read(SKETCHES, sketches.schema)
        if kept is not None:
            kept = stage(of_other_periods(kept, arrived), "kept-sketches")
            all_sketches = sketches.unionByName(kept)
            seen_in = seen_in.unionByName(kept.select("country_name", "dataElement"))
        if kept is None or exact_quartiles:
            before = of_one_program(of_other_periods(known_fact, arrived))
            before = before.withColumnRenamed("data_element_id", "dataElement")
            values = before.select("country_name", "dataElement", "period", "typed_value")
            values = stage(values, "loaded-values")
            measured = measured.unionByName(values.select("dataElement", "typed_value"))
            if kept is None:
                # A fact from before sketches were kept: they are made from it, once.
                values = values.withColumn("period", F.col("period").cast("string"))
                kept_now = stage(sketch_values(values), "kept-sketches")
                all_sketches = sketches = sketches.unionByName(kept_now)
                seen_in = seen_in.unionByName(before.select("country_name", "dataElement"))
        scored = tables.read(SCORES)
        if scored is not None:
            scored = scored.withColumn("period", F.col("period").cast("string"))
            actual = actual.unionByName(
                of_other_periods(scored, arrived).select(*actual.columns)
            )
    found_limits = outlier_limits(measured, exact=True) if exact_quartiles else sketched_limits(all_sketches)
    limits = stage(found_limits, "outlier-limits")
    expected = stage(expected_elements(seen_in), "expected-elements")
    scores = stage(score(actual, expected), "scores")
    flagged_rows = with_outlier_flag(cleaned, limits)
    # Not staged: its rows are wide, and those who look at it before it is published read few columns.
    named = resolve_combos(resolve_elements(flagged_rows, elements), combos)
    fact = build_fact(named, bridge)

    counted = build_fact(named, bridge, also=["number"])
    if loaded is not None and known_numbers is None:
        old = of_other_periods(tables.read(FACT_NAME, fact.schema), arrived)
        counted = counted.unionByName(numbered(old, numbers))
    totals = stage(unit_totals(counted), "unit-totals")

    # Both gates come before anything is published, so a failed run leaves the last good
    # tables as they are and its periods count as not loaded.
    check_nonempty(fact)
    validate_contract(fact, contract)
    # Counted on staged rows: a task that runs twice counts once.
    flagged = flagged_rows.agg(*flag_tally_columns()).first()
    published, outdated = fact, []
    if loaded is not None:
        old = of_other_periods(tables.read(FACT_NAME, fact.schema), arrived)
        known = tables.read(LIMITS)
        if kept is not None and known is not None:
            # Months in which no value lies between an old fence and the new one are not read.
            moved = [r[0] for r in moved_parts(kept, known, limits).collect()]
            old = old.where(F.col("year_month").isin([f"{p[:4]}-{p[4:6]}" for p in moved]))
        changed = stage(changed_partitions(old, limits, FACT_PARTITIONS), "changed-rows")
        published = fact.unionByName(changed)
        # At most as many months as were named.
        months = fact.where(F.col("period").isin(*reprocess)) if reprocess else fact.limit(0)
        months = [r[0] for r in months.select("year_month").distinct().collect()]
        # What a month held in areas that it has no more rows for.
        outdated = [f"*/year_month={m}" for m in months]
    replace = "all" if loaded is None else "touched"
    # Limits that flags no longer follow, should the run end early, are worse than none.
    tables.invalidate(limits, LIMITS)
    tables.invalidate(numbers, UNIT_NUMBERS)
    tables.write(scores, SCORES, partition_by=["period"])
    tables.write(
        published,
        FACT_NAME,
        partition_by=FACT_PARTITIONS,
        replace=replace,
        outdated=outdated,
        derived=derived_columns(),
    )
    tables.write(sketches, SKETCHES, partition_by=["period"], replace=replace)
    tables.write(limits, LIMITS)
    tables.write(totals, TOTALS, partition_by=["period"], replace=replace)
    # Numbers come last: without them the next load makes all totals again.
    tables.write(numbers, UNIT_NUMBERS)

    # A period reads back as a number unless its type is given.
    fact = tables.read(FACT_NAME, fact.schema)
    scores = tables.read(SCORES, scores.schema)
    totals = tables.read(TOTALS, totals.schema)

    flat_tables = {
        "dim_data_element": elements,
        "dim_org_unit": units,
        "dim_program": programs,
    }
    found = long_series(fact, SERIES_KEY)
    findings = Observation("anomalies")
    reports: Reports = {
        **analytics(fact, tree, found, totals),
        **cross_country(fact, scores, totals),
        "anomalies": lambda: find_anomalies(fact, found).observe(
            findings, F.count(F.lit(1)).alias("n")
        ),
        "dim_period": lambda: period_dimension(fact),
    }
    for name in DIMENSION_NAMES:
        reports[name] = partial(build_dimension, name, flat_tables[name])
    # The reports do not depend on one another; several at a time keep the
    # cluster busy through the tail of each.
    with ThreadPoolExecutor(concurrent_reports) as pool:
        contexts = {name: copy_context() for name in reports}  # they know the staging folder
        list(pool.map(lambda name: contexts[name].run(lambda: publish(name, reports[name]())), reports))

    current = stage(registry_snapshot(elements), "registry")
    if isinstance(tables, InPlace):
        snapshots = tables.path("_metadata_snapshot")
        previous = latest_snapshot(spark, snapshots)
    else:
        previous = tables.read(SNAPSHOT)
    drift = detect_drift(current, previous)
    drifted = Observation("drift")
    publish("metadata_drift", drift.observe(drifted, F.count(F.lit(1)).alias("n")))
    if isinstance(tables, InPlace):
        save_snapshot(current, snapshots)
    else:
        tables.write(current, SNAPSHOT)

    copies = duplicate_tally(resolved).first() if count_duplicates else None
    return report(
        "complete",
        exact_duplicates=copies["exact_duplicates"] if copies else None,
        near_duplicates=copies["near_duplicates"] if copies else None,
        fact_rows=fact.count(),
        late_rows=flagged["late_rows"],
        outlier_rows=flagged["outlier_rows"],
        zero_rows=flagged["zero_rows"],
        missing_rows=flagged["missing_rows"],
        avg_completeness_pct=scores.agg(F.avg("completeness_pct")).first()[0],
        anomalies=findings.get["n"],
        drifted_elements=drifted.get["n"],
        seconds=time.monotonic() - started,
    )
