"""How often, and how wide, values are written and joined on their way to the reports."""

import datetime

import pytest
from pyspark.sql import functions as F
from test_run import good_values, write_landing

from reportmart.functions import natural_key
from reportmart.operators import quality, quantiles, rollups, star
from reportmart.operators.anomaly import detect_anomalies
from reportmart.operators.unit_bitmaps import numbered, unit_totals
from reportmart.plans import reporting
from reportmart.sources import tables as tables_module
from shipments import model

ROWS, UNITS = 60, 6


@pytest.fixture
def tables(spark, tmp_path):
    """Lines of six suppliers over five months, two elements."""
    day = datetime.datetime(1997, 1, 15)
    lines = [
        (i, i, i % UNITS, 1 + i % 3, float(i % 9 + 1), 0.02, 0.01, "NR"[i % 2], "O",
         day.replace(month=1 + i % 5))
        for i in range(ROWS)
    ]
    names = "l_orderkey l_partkey l_suppkey l_linenumber l_quantity l_discount l_tax".split()
    written = {
        "lineitem": (lines, [*names, "l_returnflag", "l_linestatus", "l_shipdate"]),
        "supplier": ([(i, f"S{i}", i % 2, 1000.0 + i) for i in range(UNITS)],
                     ["s_suppkey", "s_name", "s_nationkey", "s_acctbal"]),
        "nation": ([(0, "N0", 0), (1, "N1", 1)], ["n_nationkey", "n_name", "n_regionkey"]),
        "region": ([(0, "R0"), (1, "R1")], ["r_regionkey", "r_name"]),
    }
    for name, (rows, columns) in written.items():
        df = spark.createDataFrame(rows, columns)
        if "l_linenumber" in columns:
            df = df.withColumn("l_linenumber", F.col("l_linenumber").cast("int"))
        df.write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.fixture
def staged(monkeypatch):
    """The names and columns of all that a module stages, as it is staged."""
    seen = []

    def watch(module):
        plain = module.stage

        def noted(df, name, **options):
            table = plain(df, name, **options)
            seen.append((name, table))
            return table

        monkeypatch.setattr(module, "stage", noted)

    for module in (model, reporting, quality, quantiles):
        watch(module)
    return seen


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_a_report_makes_only_the_columns_it_reads(spark, tables, staged):
    matrix = rollups.coverage_matrix(model.fact_table(spark, tables), ["Lines N O", "DE_RO"])
    assert {"fact", "cleaned-named"}.isdisjoint(name for name, _ in staged)
    assert "md5" in plan(model.fact_table(spark, tables))
    assert "md5" not in plan(matrix)
    rows = {r[0]: r[1] for r in matrix.collect()}
    lines = {i: (i % UNITS, 1 + i % 3, 1 + i % 5, i % 2) for i in range(ROWS)}
    # The latest of a key is the one with the greatest text; all of a key are equal but for that.
    latest = {key: max((str(i % 9 + 1) for i in lines if lines[i] == key)) for key in lines.values()}
    want = {}
    for (unit, _, _, kind), text in latest.items():
        if kind == 0:
            region = f"R{unit % 2}"
            want[region] = want.get(region, 0.0) + float(text)
    assert {k: v for k, v in rows.items() if v is not None} == want


def test_completeness_reads_its_rows_once(spark, staged):
    rows = [("A", "u", "1", "E1"), ("A", "u", "1", "E1"), ("A", "u", "1", None), ("A", "v", "1", "E2"),
            (None, "w", "1", "E1")]
    df = spark.createDataFrame(rows, "country_name string, orgUnit string, period string, dataElement string")
    scores = quality.completeness(df.where(F.col("period") == "1"))
    assert [name for name, _ in staged] == ["counted-elements", "expected-elements"]
    assert plan(scores).count("LogicalRDD") == 0
    found = {r["orgUnit"]: (r["actual_de_count"], r["row_count"], r["completeness_pct"]) for r in scores.collect()}
    assert found == {"u": (1, 3, 50.0), "v": (1, 1, 50.0), "w": (1, 1, None)}


def test_quantiles_of_a_group_share_a_sketch(spark):
    df = spark.createDataFrame([("a", float(i)) for i in range(101)] + [("b", None)], "k string, v double")
    found = quantiles.approx_quantiles(df, "k", "v", {"q1": 0.25, "q3": 0.75})
    assert plan(found).count("percentile_approx(") == 1
    assert {tuple(r) for r in found.collect()} == {("a", 25.0, 75.0), ("b", None, None)}


def test_a_load_stages_neither_wide_rows_nor_loaded_ones(spark, tmp_path, staged):
    first, both = good_values(("202301",)), good_values(("202301", "202302"))
    target = str(tmp_path / "out")
    # A load removes what it staged, so the tables are looked at when they are made.
    reporting.run(spark, write_landing(tmp_path / "one", first), target)
    sizes, plain = {}, reporting.stage

    def counted(df, name, **options):
        table = plain(df, name, **options)
        if name == "routed":
            sizes.update({r[0]: r[1] for r in table.groupBy("outcome").count().collect()})
        return table

    with pytest.MonkeyPatch.context() as m:
        m.setattr(reporting, "stage", counted)
        report = reporting.run(spark, write_landing(tmp_path / "two", both), target, mode="incremental")
    assert report.already_loaded_rows == len(first)
    assert sizes == {"resolved": len(both) - len(first)}
    names = [name for name, _ in staged]
    assert "fact" not in names
    cleaned = [table for name, table in staged if name == "cleaned"]
    assert len(cleaned) == 2 and all("country_name" in table.columns for table in cleaned)


def executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_partitions_are_written_side_by_side(spark, tmp_path):
    """Rows are not sorted by folder, and folders beyond those kept open get theirs all the same."""
    setting, path = tables_module.WRITERS_SETTING, str(tmp_path / "t")
    rows = [(i, i % (2 * tables_module.WRITERS)) for i in range(200)]
    tables_module.write_table(spark.createDataFrame(rows, "i int, k int"), path, partition_by=["k"])
    assert {tuple(r) for r in spark.read.parquet(path).select("i", "k").collect()} == set(rows)
    before = spark.conf.get(setting)
    with tables_module.side_by_side(spark):
        assert spark.conf.get(setting) == str(tables_module.WRITERS)
    assert spark.conf.get(setting) == before == "0"
    spark.conf.set(setting, "3")
    try:
        with tables_module.side_by_side(spark):
            assert spark.conf.get(setting) == "3"
    finally:
        spark.conf.unset(setting)


def test_loaded_rows_do_not_meet_the_tree(spark):
    names = "dataElement period orgUnit categoryOptionCombo value created lastUpdated storedBy".split()
    values = [("E", "202301", "U", "C"), ("E", "202302", "U", "X"), ("E", "202302", "V", None),
              ("G", "202302", "U", "C"), ("E", "202301", None, "C"), ("E", None, "U", "C"),
              ("G", "202301", "V", "C")]
    values = [(*v, "1", "2023-02-01", None, "s") for v in values]
    values = spark.createDataFrame(values, ", ".join(f"{n} string" for n in names))
    registries = [spark.createDataFrame([(i,)], "id string") for i in "ECU"]
    loaded = spark.createDataFrame([("202301",)], "period string")
    routed = reporting.route(values, *registries, loaded)
    found = sorted((r["period"] or "", r["dataElement"], r["orgUnit"] or "", r["outcome"]) for r in routed.collect())
    assert found == [
        ("", "E", "U", "quarantined"), ("202301", "E", "", "quarantined"), ("202301", "E", "U", "already_loaded"),
        ("202301", "G", "V", "already_loaded"), ("202302", "E", "U", "resolved"), ("202302", "E", "V", "unknown_unit"),
        ("202302", "G", "U", "unknown_element"),
    ]
    # Elements, categories, loaded periods and the tree; loaded rows join all but the tree.
    assert plan(routed).count("Join ") == 4 + 3


def test_values_of_several_programmes_count_once_without_a_shuffle(spark):
    rows = [("A", "e", "1", p, h, v) for p, h in (("P", "X"), ("Q", None)) for v in (1.0, 1.0, None)]
    rows += [(None, "e", "1", None, None, 2.0), ("A", "f", "1", "Q", None, 3.0), ("A", "e", "2", "Q", None, 4.0)]
    names = "country_name string, data_element_id string, period string, program_id string, health_area string"
    fact = spark.createDataFrame(rows, f"{names}, typed_value double")
    found = reporting.of_one_program(fact)
    assert "Exchange hashpartitioning" not in executed(found)
    got = sorted((r["typed_value"] or 0.0) for r in found.collect())
    assert got == [0.0, 1.0, 1.0, 2.0, 3.0, 4.0]


def test_anomalies_are_found_without_row_ids_in_the_shuffle(spark):
    key = ["data_element_id", "period", "org_unit_id", "coc_id"]
    rows = [("e", f"2023{m:02d}", "u", c, p, 500.0 if m == 9 else 1.0 + m % 2)
            for m in range(1, 13) for c in ("c", None) for p in ("P", "Q")]
    fact = spark.createDataFrame(
        rows, ", ".join(f"{c} string" for c in [*key, "program_id"]) + ", typed_value double"
    )
    for c in ("country_name", "facility_name", "data_element_name", "health_area"):
        fact = fact.withColumn(c, F.lit(c))
    fact = fact.withColumn("fact_id", natural_key(key))
    found = reporting.find_anomalies(fact)
    shuffled = [executed(df).split("Exchange", 1)[1] for df in (found, detect_anomalies(fact))]
    assert ["md5" in text for text in shuffled] == [False, True]
    want = sorted(map(repr, detect_anomalies(fact).collect()))
    assert want and sorted(map(repr, found.collect())) == want
    assert found.columns == detect_anomalies(fact).columns


def test_totals_take_numbers_that_came_with_the_rows(spark):
    rows = [("a", "u", 1.0), ("a", "v", None), ("b", "v", 2.0), ("b", None, 3.0)]
    df = spark.createDataFrame(rows, "k string, org_unit_id string, typed_value double")
    numbers = spark.createDataFrame([("u", 1), ("v", 2)], "org_unit_id string, number long")
    own = unit_totals(numbered(df, numbers), keys=["k"])
    assert "Join" not in plan(unit_totals(df.withColumn("number", F.lit(1)), keys=["k"]))
    assert sorted(map(repr, own.collect())) == sorted(map(repr, unit_totals(df, numbers, ["k"]).collect()))


def test_derived_columns_are_not_shuffled(spark, tmp_path, monkeypatch):
    """Row ids and dates follow from the key, so they are made when the rows are together."""
    shuffled = []
    hint = type(spark.range(1)).hint

    def hinted(df, name, *columns):
        shuffled.append(df.columns)
        return hint(df, name, *columns)

    monkeypatch.setattr(type(spark.range(1)), "hint", hinted)
    row = {"period": "202403", "data_element_id": "e", "org_unit_id": "u", "coc_id": None}
    row |= {"value": "7", "health_area": "H", "year_month": "2024-03"}
    given = spark.createDataFrame([row], ", ".join(f"{c} string" for c in row))
    columns = ["value", "fact_id", *star.PERIOD_COLUMNS, "date_key", *list(row)[1:4], "health_area"]
    fact = given.withColumns(star.derived_columns()).select(columns)
    star.write_fact(fact, str(tmp_path / "fact"))
    assert [set(columns) for columns in shuffled] == [set(row)]
    found = spark.read.schema(fact.schema).parquet(str(tmp_path / "fact"))
    assert found.first().asDict() == fact.first().asDict()


def test_values_land_without_a_shuffle(spark, tables, monkeypatch):
    plans = []
    monkeypatch.setattr(model, "stage", lambda df, name: plans.append(executed(df)) or df)
    assert model.landed(spark, tables).count() == ROWS
    assert len(plans) == 1 and "Exchange" not in plans[0]
