"""Sinks, registries and the tree."""

import os

import pytest
from pyspark.sql import functions as F

from reportmart.operators import drift
from reportmart.operators.quality import latest_per_key
from reportmart.operators.resolve import attach_optional, known, one_per_key, repeated_keys, unknown
from reportmart.operators.rules import check_quarantine_rate, landing_rules, with_reason
from reportmart.operators.errors import GateError
from reportmart.operators.tree import flatten_tree, known_facilities
from reportmart.sources.landing import UNIT_RECORD, flatten_units
from reportmart.sources.tables import read_if_present, write_table
from reportmart.streaming import loaded_periods, new_periods


def files(path):
    return [f for f in os.listdir(path) if f.startswith("part-")]


def test_hot_partition_is_split_and_small_ones_are_not(spark, tmp_path):
    """A third of the rows share one partition value."""
    df = spark.range(0, 600_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("p"), F.col("id") % 6)).alias("p"),
        F.sha2(F.col("id").cast("string"), 256).alias("x"),
    )
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "2m")
    try:
        write_table(df, str(tmp_path / "t"), partition_by=["p"])
    finally:
        spark.conf.unset(size)
    assert len(files(tmp_path / "t" / "p=hot")) > 2
    assert spark.read.parquet(str(tmp_path / "t")).count() == 600_000

    write_table(df, str(tmp_path / "u"), partition_by=["p"])
    assert all(len(files(tmp_path / "u" / d)) <= 2 for d in ("p=hot", "p=p1", "p=p2"))


def test_replace_modes_and_empty_results(spark, tmp_path):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "n int, p string")
    write_table(rows, path, partition_by=["p"])
    write_table(rows.where("p = 'b'").withColumn("n", F.lit(9)), path, partition_by=["p"],
                replace="touched")
    assert sorted(tuple(r) for r in spark.read.parquet(path).collect()) == [(1, "a"), (9, "b")]
    flat = str(tmp_path / "flat")
    write_table(rows, flat)
    write_table(rows.limit(0), flat)
    assert spark.read.parquet(flat).count() == 0
    write_table(rows, str(tmp_path / "csv"), fmt="csv", files=1)
    assert len(files(tmp_path / "csv")) == 1
    with pytest.raises(ValueError):
        write_table(rows, flat, replace="some")


def test_only_an_absent_path_counts_as_empty(spark, tmp_path):
    assert read_if_present(spark, str(tmp_path / "none")) is None
    assert loaded_periods(spark, str(tmp_path / "none")) is None
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_text("not parquet")
    with pytest.raises(Exception, match="(?i)parquet|footer"):
        read_if_present(spark, str(tmp_path / "broken")).count()


def test_new_periods(spark):
    values = spark.createDataFrame([("a", "202301"), ("b", "202302"), ("c", None)], "v string, period string")
    loaded = spark.createDataFrame([("202301",)], "period string")
    kept = lambda df: sorted(r["v"] for r in df.collect())
    assert kept(new_periods(values, None)) == ["a", "b", "c"]
    assert kept(new_periods(values, loaded)) == ["b", "c"]
    assert kept(new_periods(values, loaded, reprocess=["202301"])) == ["a", "b", "c"]


def test_lookups(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "k string")
    lookup = spark.createDataFrame([("a", "x"), ("a", "w"), ("c", "z")], "id string, name string")
    on = {"k": "id"}
    assert [r["k"] for r in known(df, lookup, on).collect()] == ["a"]
    assert {r["k"] for r in unknown(df, lookup, on).collect()} == {"b", None}
    assert [tuple(r) for r in repeated_keys(lookup, ["id"]).collect()] == [("a", 2)]
    single = one_per_key(lookup, ["id"])
    got = attach_optional(df, single, on, {"name": "n"}, missing_flag="gone", defaults={"n": "-"})
    assert {tuple(r) for r in got.collect()} == {
        ("a", "w", False), ("b", "-", True), (None, "-", True)}


def test_reasons(spark):
    df = spark.createDataFrame(
        [("u", "202301", "e"), ("", None, None), ("u", "2023-1", ""), (None, "٢٠٢٣٠١", "e")],
        "orgUnit string, period string, dataElement string")
    got = [r["quarantine_reason"] for r in with_reason(df, landing_rules()).collect()]
    assert got == ["", "missing:orgUnit|missing:period|missing:dataElement",
                   "invalid_period:2023-1|missing:dataElement",
                   "missing:orgUnit|invalid_period:٢٠٢٣٠١"]
    assert check_quarantine_rate(0, 0) == 0.0
    assert check_quarantine_rate(10, 1) == 10.0  # the limit itself passes
    with pytest.raises(GateError):
        check_quarantine_rate(100, 11)


def test_tree_of_any_depth(spark):
    records = spark.createDataFrame(
        [("A", "Top", 1, "/A", None), ("B", None, None, "/A/B", None), ("C", "Mid", 3, "/A/B/C", ("B",)),
         ("D", "Deep", None, "/A/B/C/D/E/D", None), ("L", "Lone", None, None, None),
         ("X", "Odd", 4, "/Z/B", None)],
        UNIT_RECORD)
    units = flatten_units(records)
    parents = {r["id"]: (r["level"], r["path"], r["parentId"]) for r in units.collect()}
    assert parents["B"] == (2, "/A/B", "A") and parents["D"] == (6, "/A/B/C/D/E/D", "E")
    assert parents["L"] == (1, "/L", None) and parents["C"][2] == "B"
    names = {r["id"]: (r["country_name"], r["region_name"], r["district_name"])
             for r in flatten_tree(units).collect()}
    assert names == {"A": ("Top", None, None), "B": ("Top", "B", None), "C": ("Top", "B", "Mid"),
                     "D": ("Top", "B", "Mid"), "L": ("Lone", None, None), "X": (None, "B", None)}
    assert [tuple(r) for r in known_facilities(flatten_tree(units)).collect()] == [(None, 1)]
    deep = flatten_tree(units, {1: "top", 3: "third"})
    assert deep.columns[-2:] == ["top", "third"]


def test_latest_keeps_one_row_of_a_hot_key_per_task(spark, capsys):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), "id")
    latest = latest_per_key(df, ["k"], [F.desc("id")])
    latest.explain()
    plan = capsys.readouterr().out
    limit, exchange = plan.rfind("WindowGroupLimit"), plan.rfind("Exchange")
    assert limit > exchange > 0  # below the exchange, that is before the shuffle
    assert latest.count() == 2001 and latest.where("k = 0").first()["id"] == 2997


def test_drift_and_snapshots(spark, tmp_path):
    path = str(tmp_path / "snapshots")
    assert drift.latest_snapshot(spark, path) is None
    first = drift.registry_snapshot(
        spark.createDataFrame([("a", "x"), ("b", None), ("c", "z")], "id string, name string"))
    assert {r["drift_type"] for r in drift.detect_drift(first, None).collect()} == {"new_baseline"}
    for _ in range(11):  # version 10 is newer than version 9
        version = drift.save_snapshot(first, path)
    assert version == 11
    later = spark.createDataFrame([("a", "x"), ("b", "named"), ("d", "new")], "id string, name string")
    drift.save_snapshot(later, path)
    found = drift.detect_drift(drift.latest_snapshot(spark, path), first)
    assert {tuple(r) for r in found.collect()} == {
        ("b", "b -> named", "renamed"), ("c", "z", "removed"), ("d", "new", "added")}
