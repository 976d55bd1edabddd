"""Faults of runs that the registered queries cannot see."""

import pytest
from test_run import good_values, value, write_landing

from reportmart.operators.contract import ContractViolation
from reportmart.operators.drift import latest_snapshot, save_snapshot
from reportmart.operators.quantiles import exact_quantiles
from reportmart.plans.reporting import run
from reportmart.sources.landing import ELEMENT_RECORD, read_records


def test_quantiles_of_a_split_group_with_infinities(spark):
    values = [float(i) for i in range(200)] + [float("inf")] * 3 + [float("-inf")] * 2
    df = spark.createDataFrame([("g", v) for v in values], "key string, v double")
    found = exact_quantiles(df, "key", "v", {"p": 0.99}, accuracy=20, rows_per_task=3)
    want = sorted(values)[-(-99 * len(values) // 100) - 1]
    assert found.first()["p"] == want


def test_an_empty_snapshot_is_the_latest(spark, tmp_path):
    path = str(tmp_path / "s")
    some = spark.createDataFrame([("a", "x")], "id string, name string")
    assert save_snapshot(some, path) == 1
    assert save_snapshot(some.limit(0), path) == 2
    assert latest_snapshot(spark, path).count() == 0
    assert save_snapshot(some, path) == 3
    assert latest_snapshot(spark, path).count() == 1


def test_records_of_another_array_are_refused(spark, tmp_path):
    path = tmp_path / "metadata.json"
    path.write_text('{"dataElements": [\n{"id": "E1"}\n],\n"categoryOptionCombos": [\n{"id": "K"}\n]}')
    with pytest.raises(Exception, match="another array|not one record"):
        read_records(spark, str(path), "dataElements", ELEMENT_RECORD, "records").collect()


def test_a_failed_gate_publishes_nothing(spark, tmp_path):
    target = str(tmp_path / "out")
    run(spark, write_landing(tmp_path / "a", good_values(("202301",))), target)
    fact = f"{target}/fact_service_delivery"
    before = spark.read.parquet(fact).count()
    bad = [value(e, "202302", "C1F1", "-1") for e in ("E1", "E2")]
    with pytest.raises(ContractViolation):
        run(spark, write_landing(tmp_path / "b", bad), target, mode="incremental")
    assert spark.read.parquet(fact).count() == before
    good = good_values(("202302",))
    report = run(spark, write_landing(tmp_path / "c", good), target, mode="incremental")
    assert report.finished == "complete"
    assert spark.read.parquet(fact).where("value = '-1'").count() == 0
    assert spark.read.parquet(fact).count() == before + len(good)
