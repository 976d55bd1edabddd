"""Kept unit totals against plain counting, over any split into loads."""

import random

import pytest
from pyspark.sql import functions as F

from reportmart.operators import unit_bitmaps as ub

SCHEMA = "area string, period string, org_unit_id string, typed_value double"


def rows(seed, n, units):
    rng = random.Random(seed)
    return [
        (
            rng.choice(["N", "S", None]),
            f"2020{rng.randint(1, 6):02}",
            None if rng.random() < 0.1 else f"u{rng.randrange(units)}",
            None if rng.random() < 0.2 else float(rng.randint(0, 9)),
        )
        for _ in range(n)
    ]


def counted(given, keys, also):
    groups = {}
    for row in given:
        named = dict(zip(("area", "period", "org_unit_id", "typed_value"), row))
        groups.setdefault(tuple(named[k] for k in keys), []).append(named)
    found = set()
    for key, members in groups.items():
        values = [m["typed_value"] for m in members if m["typed_value"] is not None]
        found.add((
            *key,
            sum(values) if values else None,
            round(sum(values) / len(values), 9) if values else None,
            len(values),
            len(members),
            len({m["org_unit_id"] for m in members} - {None}),
            len({m[also] for m in members} - {None}),
        ))
    return found


def rolled(totals, keys, also):
    found = ub.roll_up(totals, keys, also).withColumn("mean", F.round("mean", 9))
    names = (*keys, "total", "mean", "n_values", "n_rows", "n_units", "n_also")
    return {tuple(r) for r in found.select(*names).collect()}


@pytest.mark.parametrize("parts, units", [(256, 50), (3, 50), (2000, 400)])
def test_loads_add_up(spark, parts, units):
    """With 2,000 parts the numbers of a group reach over several stretches."""
    loads = [rows(seed, 400, units) for seed in (1, 2, 3)] + [[]]
    numbers, totals = None, None
    for load in loads:
        df = spark.createDataFrame(load, SCHEMA)
        new = ub.number_units(df, numbers, parts=parts)
        numbers = new if numbers is None else numbers.union(new)
        numbers = spark.createDataFrame(numbers.collect(), new.schema)
        own = ub.unit_totals(df, numbers, ["area", "period"])
        kept = spark.createDataFrame(own.collect(), own.schema)
        totals = kept if totals is None else totals.unionByName(kept)
    given = [r for load in loads for r in load]
    seen = {r[2] for r in given} - {None}
    found = numbers.collect()
    assert {r["org_unit_id"] for r in found} == seen
    assert len({r["number"] for r in found}) == len(found) == len(seen)
    assert min(r["number"] for r in found) >= 1
    for keys, also in ((["area"], "period"), (["period"], "area"), ([], "period")):
        assert rolled(totals, keys, also) == counted(given, keys, also)
        assert rolled(ub.merged(totals, ["area", "period"]), keys, also) == counted(given, keys, also)


def test_nothing_is_expanded(spark):
    df = spark.createDataFrame(rows(4, 50, 9), SCHEMA)
    found = ub.roll_up(ub.totals_of(df, ["area", "period"]), ["area"], "period")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_no_rows(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert ub.number_units(none).collect() == []
    assert ub.roll_up(ub.totals_of(none, ["area", "period"]), ["area"], "period").collect() == []


def test_bitmaps_are_made_after_the_shuffle(spark):
    """Made before it, they would be as many as tasks times groups."""
    given = spark.createDataFrame(rows(5, 200, 30), SCHEMA)
    numbers = spark.createDataFrame([(f"u{i}", i + 1) for i in range(30)], "org_unit_id string, number long")
    totals = ub.unit_totals(given, numbers, ["area", "period"])
    plan = totals._jdf.queryExecution().executedPlan().toString().splitlines()
    made = [i for i, line in enumerate(plan) if "bitmap_construct_agg" in line]
    dealt = [i for i, line in enumerate(plan) if "Exchange hashpartitioning" in line]
    assert made and dealt and max(made) < min(dealt)
