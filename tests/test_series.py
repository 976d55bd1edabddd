"""Windows over split series give what a plain window gives."""

import pytest
from pyspark.sql import Window, functions as F

from reportmart.operators import series
from reportmart.operators.anomaly import detect_anomalies
from reportmart.operators.series import long_series, with_frames
from reportmart.operators.trends import (
    rolling_average,
    rolling_average_by_month,
    top_by_dense_rank,
    underreporters,
)

KEYS = ["unit", "element"]
ORDER = ["t", "id"]


@pytest.fixture(scope="module")
def rows(spark):
    """One series holds a third of the rows, another shares one time in all of its
    rows, one has a null key; the rest are short."""
    df = spark.range(900)
    unit = F.when(F.col("id") < 300, "hot").when(F.col("id") < 400, "same").when(
        F.col("id") < 450, None
    ).otherwise(F.concat(F.lit("u"), F.col("id") % 40))
    return df.select(
        unit.alias("unit"),
        F.lit("e").alias("element"),
        F.when(unit == "same", F.lit(5)).otherwise((F.col("id") * 37) % 101).alias("t"),
        "id",
        F.when(F.col("id") % 11 == 0, None).otherwise(
            F.when(F.col("id") % 97 == 1, 5000.0).otherwise((F.col("id") * 13 % 29).cast("double"))
        ).alias("v"),
    )


FRAMES = {
    "mean": lambda w: F.avg("v").over(w.rowsBetween(-4, 0)),
    "n": lambda w: F.count("v").over(w.rowsBetween(-4, 0)),
    "before": lambda w: F.lag("v").over(w),
}


def plain(rows):
    w = Window.partitionBy(*KEYS).orderBy(*ORDER)
    return rows.withColumns({name: f(w) for name, f in FRAMES.items()})


def contents(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("rows_per_task", [3, 20, 64, 299, 10_000])
def test_split_series_match_plain_windows(spark, rows, rows_per_task):
    got = with_frames(rows, KEYS, ORDER, FRAMES, 4, rows_per_task)
    assert contents(got.select(*rows.columns, *FRAMES)) == contents(plain(rows))


def test_small_chunks_share_a_task(spark, rows, monkeypatch):
    staged, stage = {}, series.stage

    def spy(df, name):
        staged[name] = stage(df, name)
        return staged[name]

    monkeypatch.setattr(series, "stage", spy)
    with_frames(rows, KEYS, ORDER, FRAMES, 4, 3).count()
    chunks = staged["series-chunks"]
    assert len(chunks.inputFiles()) <= 2
    assert chunks.groupBy(*KEYS, "__chunk").count().agg(F.max("count")).first()[0] <= 3


def test_long_series_are_found(spark, rows):
    found = {r["unit"]: r["n_rows"] for r in long_series(rows, KEYS, 40).collect()}
    assert found == {"hot": 300, "same": 100, None: 50}


def as_fact(rows):
    period = F.concat(F.lit("20"), F.lpad((F.col("t") % 20).cast("string"), 2, "0"), F.lit("01"))
    return rows.select(
        F.col("unit").alias("org_unit_id"), F.col("element").alias("data_element_id"),
        F.col("unit").alias("facility_name"), F.lit("c").alias("country_name"),
        F.lit("n").alias("data_element_name"), F.lit("h").alias("health_area"),
        period.alias("period"), F.lit("x").alias("year_month"), F.lit("k").alias("coc_id"),
        F.lit("p").alias("program_id"), F.col("id").cast("string").alias("fact_id"),
        F.col("v").alias("typed_value"),
    )


def test_reports_do_not_depend_on_the_split(spark, rows):
    fact = as_fact(rows)
    assert contents(rolling_average(fact, rows_per_task=30)) == contents(rolling_average(fact))
    split = detect_anomalies(fact, rows_per_task=30)
    assert contents(split) == contents(detect_anomalies(fact))
    assert {r["anomaly_type"] for r in split.collect()} == {"z_score_outlier", "period_spike"}


def test_anomalies_by_hand(spark):
    def fact(values):
        columns = """fact_id period country_name facility_name data_element_name health_area
                     org_unit_id data_element_id coc_id program_id""".split()
        data = [(f"f{i:02}", f"2023{i + 1:02}", *["c"] * 8, v) for i, v in enumerate(values)]
        schema = ", ".join(f"{c} string" for c in columns) + ", typed_value double"
        return spark.createDataFrame(data, schema)

    def found(values):
        rows = detect_anomalies(fact(values)).collect()
        return sorted((r["fact_id"], r["anomaly_type"], round(r["z_score"], 3)) for r in rows)

    assert found([298.0, 50000.0]) == [("f01", "period_spike", 16678.523)]
    assert found([10.0, 40.0]) == []  # exactly 300 %
    assert found([0.0, 40.0]) == []  # no growth over zero
    assert found([10.0, None, 500.0]) == []  # a missing row keeps its place
    # with n rows the largest possible distance is (n - 1) / sqrt(n): 11 rows are needed
    assert found([5.0] * 9 + [20.0]) == []
    assert found([5.0] * 10 + [20.0]) == [("f10", "z_score_outlier", 3.015)]
    assert found([5.0] * 10 + [50.0]) == [
        ("f10", "period_spike", 900.0), ("f10", "z_score_outlier", 3.015)]


def test_rolling_by_calendar_month(spark):
    data = [("u", "e", p, v) for p, v in
            [("202211", 3.0), ("202212", 9.0), ("202301", 6.0), ("202301", None), ("202305", 1.0)]]
    fact = spark.createDataFrame(
        data, "org_unit_id string, data_element_id string, period string, typed_value double")
    got = {r["period"]: r["rolling_3m_avg"] for r in rolling_average_by_month(fact).collect()}
    assert got == {"202211": 3.0, "202212": 6.0, "202301": 6.0, "202305": 1.0}


def test_top_by_dense_rank_keeps_ties(spark):
    data = [("a", i, i % 4) for i in range(40)] + [(None, 1, 7), ("b", 1, None)]
    df = spark.createDataFrame(data, "area string, id int, n int")
    got = top_by_dense_rank(df, "area", "n", 2)
    w = Window.partitionBy("area").orderBy(F.desc("n"))
    want = df.withColumn("rank", F.dense_rank().over(w)).where("rank <= 2")
    assert contents(got.select(*want.columns)) == contents(want)
    assert got.where("area = 'a'").count() == 20


def test_underreporters_count_zero_and_missing(spark):
    data = [("u1", True, False), ("u1", False, True), ("u1", False, False), ("u2", False, False)]
    fact = spark.createDataFrame(
        data, "org_unit_id string, is_explicit_zero boolean, is_missing_value boolean"
    ).withColumns({c: F.lit("x") for c in ("facility_name", "country_name", "health_area")})
    got = {r["org_unit_id"]: (r["zero_or_missing_periods"], r["total_periods"], r["rank"])
           for r in underreporters(fact).collect()}
    assert got == {"u1": (2, 3, 1), "u2": (0, 1, 2)}
