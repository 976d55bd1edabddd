"""End to end on landing documents with planted defects."""

import json

import pytest
from pyspark.sql import functions as F

from reportmart.operators.errors import GateError
from reportmart.plans.reporting import run
from reportmart.sources.landing import load_landing

UNITS = [("C1", "Northland"), ("C2", "Southland")]


def units():
    out = []
    for c, name in UNITS:
        out.append({"id": c, "name": name, "level": 1, "path": f"/{c}"})
        out.append({"id": f"{c}R", "name": f"{name} region", "level": 2, "path": f"/{c}/{c}R",
                    "parent": {"id": c}})
        out.append({"id": f"{c}D", "name": f"{name} district", "level": 3,
                    "path": f"/{c}/{c}R/{c}D", "parent": None})
        for i in (1, 2):
            # level and parent come from the path
            out.append({"id": f"{c}F{i}", "name": f"{name} clinic {i}",
                        "path": f"/{c}/{c}R/{c}D/{c}F{i}", "groups": [{"name": "x"}]})
    return out


def value(element, period, unit, text, updated="2023-02-10T08:00:00.000", coc="K1", **more):
    row = {"dataElement": element, "period": period, "orgUnit": unit,
           "categoryOptionCombo": coc, "value": text, "created": "2023-02-10",
           "lastUpdated": updated, "storedBy": "t"}
    row.update(more)
    return {k: v for k, v in row.items() if v != "__absent"}


def good_values(periods=("202301", "202302", "202303")):
    return [
        value(e, p, f"{c}F{i}", str(10 * i + n), updated="2023-04-02T00:00:00.000")
        for n, p in enumerate(periods) for c, _ in UNITS for i in (1, 2) for e in ("E1", "E2")
    ]


def defects():
    return [
        value("E1", "202301", "C1F1", "11", updated="2023-04-03T00:00:00.000"),  # correction
        value("E1", "202302", "C1F1", "11", updated="2023-04-02T00:00:00.000"),  # exact copy
        value("GHOST", "202301", "C1F1", "1"),
        value("E1", "202301", "GHOST", "1"),
        value("E2", "202303", "C2F2", "0", coc="K9"),  # orphaned category, zero
        value("E2", "202302", "C2F2", None, coc="__absent"),  # missing value, default category
        value("E1", "202303", "C2F2", "5", coc=None),  # null is not absent
        value("E1", "202301", None, "1"),
        value("E1", "2023-01", "C1F1", "1"),
    ]


def write_landing(folder, values, elements=None):
    folder.mkdir(parents=True, exist_ok=True)
    docs = {
        "data_values.json": {"dataValues": values},
        "metadata.json": {
            "dataElements": elements or [
                {"id": "E1", "name": "Births", "valueType": "NUMBER", "categoryCombo": {"id": "x"}},
                {"id": "E2"},
            ],
            "categoryOptionCombos": [{"id": "K1", "name": "Under 5"}, {"id": "COC_DEF"}],
        },
        "org_units.json": {"organisationUnits": units()},
        "programs.json": {"programs": [
            {"id": f"P{c}", "name": "p", "healthArea": "Maternal", "country": name,
             "reportingFrequency": "Monthly", "dataElements": ["E1"]} for c, name in UNITS
        ]},
    }
    for name, doc in docs.items():
        (folder / name).write_text(json.dumps(doc, indent=1))
    return str(folder)


def test_full_run(spark, tmp_path):
    source = write_landing(tmp_path / "in", good_values() + defects())
    target = str(tmp_path / "out")
    r = run(spark, source, target, count_duplicates=True, exact_quartiles=True)
    assert r.finished == "complete"
    assert (r.total_rows, r.quarantined_rows) == (33, 2)
    assert (r.unknown_element_rows, r.unknown_unit_rows, r.orphaned_combo_rows) == (1, 1, 2)
    assert (r.exact_duplicates, r.near_duplicates) == (1, 1)
    assert r.fact_rows == 27
    assert (r.zero_rows, r.missing_rows) == (1, 1)
    assert r.avg_completeness_pct == 100.0
    # submitted in April for a period that ended in January
    assert r.late_rows == 8
    assert r.drifted_elements == 2

    fact = spark.read.option("basePath", target).parquet(f"{target}/fact_service_delivery")
    kept = fact.where("org_unit_id = 'C1F1' and data_element_id = 'E1' and period = '202301'")
    assert [x["value"] for x in kept.collect()] == ["11"]
    row = fact.where("coc_id = 'COC_DEF'").first()
    assert row["is_missing_value"] and row["coc_name"] == "COC_DEF" and row["data_element_name"] == "E2"
    null_coc = fact.where("coc_id is null").collect()
    assert [(x["value"], x["coc_name"], x["is_orphaned_coc"]) for x in null_coc] == [
        ("5", "Default", True)]
    assert row["district_name"] == "Southland district" and row["facility_level"] == 4
    reasons = {x["quarantine_reason"] for x in spark.read.parquet(f"{target}/quarantine").collect()}
    assert reasons == {"missing:orgUnit", "invalid_period:2023-01"}
    assert r.as_frame(spark).first()["fact_rows"] == 27


def test_second_run_reports_drift(spark, tmp_path):
    target = str(tmp_path / "out")
    run(spark, write_landing(tmp_path / "a", good_values()), target)
    renamed = [{"id": "E1", "name": "Live births"}, {"id": "E3", "name": "New"},
               {"id": "E2"}]
    r = run(spark, write_landing(tmp_path / "b", good_values(), renamed), target)
    drift = {tuple(x) for x in spark.read.parquet(f"{target}/metadata_drift").collect()}
    assert drift == {("E1", "Births -> Live births", "renamed"), ("E3", "New", "added")}
    r = run(spark, write_landing(tmp_path / "c", good_values(), renamed), target)
    assert r.drifted_elements == 0
    assert spark.read.parquet(f"{target}/metadata_drift").count() == 0  # not the stale report


def test_incremental_run_keeps_loaded_periods(spark, tmp_path):
    target = str(tmp_path / "out")
    run(spark, write_landing(tmp_path / "a", good_values(("202301", "202302"))), target)
    changed = [dict(v, value="99") for v in good_values(("202301", "202302", "202303"))]
    source = write_landing(tmp_path / "b", changed)
    r = run(spark, source, target, mode="incremental")
    assert (r.already_loaded_rows, r.resolved_rows, r.fact_rows) == (16, 8, 24)
    fact = spark.read.parquet(f"{target}/fact_service_delivery")
    assert fact.where("value = '99'").select("period").distinct().collect() == [("202303",)]
    assert run(spark, source, target, mode="incremental").finished == "no_new_data"
    r = run(spark, source, target, mode="incremental", reprocess=["202301"])
    assert r.fact_rows == 24
    assert spark.read.parquet(f"{target}/fact_service_delivery").where("value='99'").count() == 16


def outcome(spark, target):
    fact = spark.read.parquet(f"{target}/fact_service_delivery")
    scores = spark.read.parquet(f"{target}/completeness_scores")
    return [
        sorted(map(repr, df.select(*sorted(df.columns)).collect())) for df in (fact, scores)
    ]


@pytest.mark.parametrize("exact", [True, False])
def test_an_incremental_load_equals_a_full_load(spark, tmp_path, exact):
    """The later months lack an element that is expected, and bring values beside which
    loaded ones are outliers; by itself each load would be judged otherwise."""
    early = good_values(("202301",))
    early[0], early[2] = (dict(v, value="5000") for v in (early[0], early[2]))
    late = [v for v in good_values(("202302", "202303")) if v["dataElement"] == "E1"]
    full, two = str(tmp_path / "full"), str(tmp_path / "two")
    run(spark, write_landing(tmp_path / "a", early + late), full, exact_quartiles=exact)
    run(spark, write_landing(tmp_path / "b", early), two, exact_quartiles=exact)
    before = outcome(spark, two)
    source = write_landing(tmp_path / "c", late)  # the loaded month is not landed again
    run(spark, source, two, mode="incremental", exact_quartiles=exact)
    assert outcome(spark, two) == outcome(spark, full)
    fact = spark.read.parquet(f"{two}/fact_service_delivery")
    assert [r.value for r in fact.where("is_outlier").collect()] == ["5000"] * 2
    assert not any("is_outlier=True" in r for r in before[0])  # the flag came with the load
    scores = spark.read.parquet(f"{two}/completeness_scores")
    assert {r.completeness_pct for r in scores.where("period = 202303").collect()} == {50.0}


def test_reprocessing_replaces_a_month_in_every_area(spark, tmp_path):
    target = str(tmp_path / "out")
    months = ("202301", "202302")
    run(spark, write_landing(tmp_path / "a", good_values(months)), target)
    source = load_landing(spark, write_landing(tmp_path / "b", good_values(months)))
    moved = source.programs.withColumn("healthArea", F.lit("Moved"))
    bridge = source.de_program.withColumn("health_area", F.lit("Moved"))
    source = type(source)(**{**vars(source), "programs": moved, "de_program": bridge})
    r = run(spark, source, target, mode="incremental", reprocess=["202301"])
    fact = spark.read.parquet(f"{target}/fact_service_delivery")
    assert r.fact_rows == 16 == fact.select("fact_id").distinct().count()
    areas = fact.where("period = '202301'").select("health_area").distinct().collect()
    # Some elements are in no programme; what was in one is in the new area only.
    assert {r.health_area for r in areas} == {"Moved", None}
    assert fact.where("period = '202302' AND health_area = 'Moved'").isEmpty()


def test_gates(spark, tmp_path):
    bad = [value("E1", None, "C1F1", "1")] * 2 + good_values()[:8]
    with pytest.raises(GateError, match="20.00 %"):
        run(spark, write_landing(tmp_path / "a", bad), str(tmp_path / "out_a"))
    ghosts = [value("GHOST", "202301", "C1F1", "1")]
    with pytest.raises(GateError, match="no rows"):
        run(spark, write_landing(tmp_path / "b", ghosts), str(tmp_path / "out_b"))


def test_layouts_agree(spark, tmp_path):
    rows = good_values() + defects()
    whole = write_landing(tmp_path / "doc", rows)
    (tmp_path / "rec").mkdir()
    body = ",\n".join("  " + json.dumps(v) for v in rows)
    (tmp_path / "rec" / "data_values.json").write_text('{"dataValues": [\n' + body + "\n]}\n")
    (tmp_path / "lin").mkdir()
    (tmp_path / "lin" / "data_values.json").write_text(
        "\n".join(json.dumps({"dataValues": [v, v][:1]}) for v in rows) + "\n{}\n"
    )
    from reportmart.sources.landing import VALUE_RECORD, flatten_values, read_records

    expected = sorted(map(str, load_landing(spark, whole).values.collect()))
    for folder, layout in (("rec", "records"), ("lin", "lines")):
        df = read_records(
            spark, str(tmp_path / folder / "data_values.json"), "dataValues", VALUE_RECORD, layout
        )
        assert sorted(map(str, flatten_values(df).collect())) == expected

    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "v.json").write_text('{"dataValues": [\n{"period":\n"202301"}\n]}')
    with pytest.raises(Exception, match="not one record per line"):
        read_records(
            spark, str(tmp_path / "bad" / "v.json"), "dataValues", VALUE_RECORD, "records"
        ).collect()


def test_missing_and_malformed_documents_fail(spark, tmp_path):
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        load_landing(spark, str(tmp_path / "nowhere"))
    folder = write_landing(tmp_path / "x", good_values())
    (tmp_path / "x" / "data_values.json").write_text('{"dataValues": [{')
    with pytest.raises(Exception):
        load_landing(spark, folder).values.collect()
    (tmp_path / "x" / "data_values.json").write_text("{}")
    assert load_landing(spark, folder).values.where(F.lit(True)).count() == 0
