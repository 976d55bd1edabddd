"""Cleaning, flags, quantiles and completeness on small tables, by hand."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from reportmart.functions import month_index, natural_key, parse_instant, quarter_label
from reportmart.operators import quality as q
from reportmart.operators.quantiles import approx_quantiles, exact_quantiles
from reportmart.operators.rollups import coverage_matrix, low_streaks

COLUMNS = """dataElement string, period string, orgUnit string, categoryOptionCombo string,
             value string, created string, lastUpdated string, storedBy string"""


def values(spark, *rows):
    return spark.createDataFrame(
        [("E", p, "U", "K", v, c, u, "s") for p, v, c, u in rows], COLUMNS)


def test_instants(spark):
    texts = {
        "2023-02-05T10:00:00.000": dt.datetime(2023, 2, 5, 10),
        "2023-02-05T10:00:00.250+0000": dt.datetime(2023, 2, 5, 10, 0, 0, 250000),
        "2023-02-05": dt.datetime(2023, 2, 5),
        "2023-02-05T10:00": dt.datetime(2023, 2, 5),
        "2023-02-31": None, "2023": None, "2023-02": None, "05.02.2023": None, "": None,
        "10:20:30": None,
    }
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = {r["t"]: r["x"] for r in df.select("t", parse_instant(F.col("t")).alias("x")).collect()}
    assert got == texts
    assert spark.sql("select cast(null as string) t").select(parse_instant(F.col("t"))).first()[0] is None


def test_quarters_and_month_numbers(spark):
    df = spark.createDataFrame([(m,) for m in (0, 1, 3, 4, 9, 10, 12, 13, None)], "m int")
    got = [r[0] for r in df.select(quarter_label(F.col("m"))).collect()]
    assert got == ["Q1", "Q1", "Q1", "Q2", "Q3", "Q4", "Q4", "Q4", "Q4"]
    p = spark.createDataFrame([("202212", "202301")], "a string, b string")
    a, b = p.select(month_index(F.col("a")), month_index(F.col("b"))).first()
    assert b - a == 1


def test_keys_with_nulls_differ(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x string, y string, z string")
    assert df.select(natural_key(["x", "y", "z"]).alias("k")).distinct().count() == 2


def test_latest_row_wins(spark):
    df = values(
        spark,
        ("202301", "1", None, "2023-02-01"),
        ("202301", "2", None, "2023-02-02T00:00:00.000"),
        ("202301", "1", None, "2023-02-03"),  # an exact copy, but the newest
        ("202302", "7", None, None),
        ("202302", "8", "2023-03-01", None),
        ("202303", "4", None, "2023-04-01"),
        ("202303", "5", None, "2023-04-01"),  # same time: decided by the text
    )
    assert {r["period"]: r["value"] for r in q.latest_per_key(df).collect()} == {
        "202301": "1", "202302": "8", "202303": "5"}
    tally = q.duplicate_tally(df).first().asDict()
    assert tally == {"rows_in": 7, "exact_duplicates": 1, "near_duplicates": 3, "rows_left": 3}
    assert q.duplicate_tally(df.limit(0)).first()["rows_in"] == 0


def test_value_flags(spark):
    texts = {"0": (True, False, 0.0), "0.0": (False, False, 0.0), " 0": (False, False, 0.0),
             "": (False, True, None), "  ": (False, True, None), None: (False, True, None),
             "N/A": (False, False, None), "12.5": (False, False, 12.5)}
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    got = {r[0]: tuple(r[1:]) for r in q.with_value_flags(df).collect()}
    assert got == texts


def test_late_flag(spark):
    df = values(
        spark,
        ("202301", "a", None, "2023-04-01"),  # 60 days after January ended
        ("202301", "b", None, "2023-04-02"),
        ("202301", "c", "2023-07-01", None),
        ("202301", "d", "2023-07-01", "2023-02-01"),
        ("202313", "e", None, "2025-01-01"),  # no such month
        ("202301", "f", "soon", None),
    )
    got = {r["value"]: r["is_late_reported"] for r in q.with_late_flag(df).collect()}
    assert got == dict(a=False, b=True, c=True, d=False, e=False, f=False)


def test_outliers(spark):
    data = [("a", float(v)) for v in range(1, 9)] + [("a", 1000.0), ("a", -1000.0), ("a", None)]
    data += [("flat", 5.0)] * 8 + [("flat", 500.0)]
    df = spark.createDataFrame(data, "dataElement string, typed_value double")
    for exact in (True, False):
        flagged = q.flag_outliers(df, exact=exact)
        assert flagged.count() == len(data)
        found = {tuple(r)[:2] for r in flagged.where("is_outlier").collect()}
        assert found == {("a", 1000.0), ("a", -1000.0)}


@pytest.mark.parametrize("accuracy, rows_per_task", [(20, 40), (20, 10**6), (100, 3), (10_000, 10**6)])
def test_exact_quantiles(spark, accuracy, rows_per_task):
    rnd = random.Random(7)
    data = [("big", round(rnd.gauss(0, 50), 1)) for _ in range(4000)]
    data += [("ties", float(rnd.choice([1, 1, 1, 2, 9]))) for _ in range(500)]
    data += [("one", 3.5), ("two", 1.0), ("two", 2.0), ("none", None), (None, 4.0), ("big", None)]
    probs = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99, "p100": 1.0}
    df = spark.createDataFrame(data, "k string, v double").repartition(5)
    df.createOrReplaceTempView("quantile_input")
    wanted = ", ".join(
        f"percentile_disc({p}) WITHIN GROUP (ORDER BY v) AS {n}" for n, p in probs.items())
    want = spark.sql(f"SELECT k, {wanted} FROM quantile_input WHERE v IS NOT NULL GROUP BY k")
    got = exact_quantiles(df, "k", "v", probs, accuracy, rows_per_task)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_approximate_quantiles_are_close(spark):
    df = spark.range(10_001).select(F.lit("k").alias("k"), F.col("id").cast("double").alias("v"))
    row = approx_quantiles(df, "k", "v", {"a": 0.25, "b": 0.75}, 1000).first()
    assert abs(row["a"] - 2500) <= 20 and abs(row["b"] - 7500) <= 20


def test_completeness(spark):
    data = [("N", "u1", "p1", "a"), ("N", "u1", "p1", "b"), ("N", "u1", "p1", "b"),
            ("N", "u1", "p2", "a"), ("N", "u2", "p1", "c"), (None, "u3", "p1", "a")]
    df = spark.createDataFrame(
        data, "country_name string, orgUnit string, period string, dataElement string")
    got = {(r["orgUnit"], r["period"]): (r["actual_de_count"], r["row_count"],
                                         r["expected_de_count"], r["completeness_pct"])
           for r in q.completeness(df).collect()}
    assert got == {("u1", "p1"): (2, 3, 3, 66.67), ("u1", "p2"): (1, 1, 3, 33.33),
                   ("u2", "p1"): (1, 1, 3, 33.33), ("u3", "p1"): (1, 1, None, None)}


def test_streaks_are_consecutive_across_years(spark):
    low = ["202211", "202212", "202301", "202303", "202304", "202306"]
    data = [("u", "c", p, 50.0) for p in low] + [("u", "c", "202302", 90.0)]
    df = spark.createDataFrame(
        data, "orgUnit string, country_name string, period string, completeness_pct double")
    got = [tuple(r) for r in low_streaks(df).collect()]
    assert got == [("u", "c", 3, "202211", "202301", 50.0)]


def test_coverage_matrix_with_and_without_names(spark):
    df = spark.createDataFrame(
        [("N", "a", 1.0), ("N", "a", 2.0), ("S", "b", 5.0)],
        "country_name string, data_element_name string, typed_value double")
    assert [tuple(r) for r in coverage_matrix(df).collect()] == [("N", 3.0, None), ("S", None, 5.0)]
    given = coverage_matrix(df, ["b", "z"])
    assert given.columns == ["country_name", "b", "z"]
    assert [tuple(r) for r in given.collect()] == [("N", None, None), ("S", 5.0, None)]
