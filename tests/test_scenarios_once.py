"""Scenarios that share their rides: one shuffle for all, orders that no fault hits staged once."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from ledgerflow import Period
from ledgerflow.operators import faults, quality, staging
from ledgerflow.plans import queries as Q
from tests import fixtures

YEARS = Period(date(2025, 1, 1), date(2027, 12, 31))
CHAINS = {"clean": (), "all": ("null", "outlier", "duplicate"), "copies": ("duplicate",), "mixed": ("null", "country")}
RATES = {"null": 0.1, "outlier": 0.05, "duplicate": 0.2, "country": 0.1}
TAGS = (faults.SCENARIO,)


def content(df, columns):
    return sorted(map(str, df.select(*columns).collect()))


@pytest.fixture()
def rides(spark):
    base = fixtures.rides(spark)
    # an order of many rows of one ride that share every hash, another of many rides, one row an order, and null orders
    spread = (base.where("ride_id = 1").crossJoin(spark.range(60).withColumnRenamed("id", "n"))
              .withColumn("order_id", F.when(F.col("n") < 20, "h").when(F.col("n") < 35, "k").otherwise(F.concat(F.lit("s"), "n")))
              .withColumn("ride_id", F.when(F.col("n") < 20, F.lit(5)).otherwise(F.col("n")))
              .withColumn("amount", (F.col("n") % 7).cast(base.schema["amount"].dataType)))
    return base.unionByName(spread.select(*base.columns))


@pytest.mark.parametrize("block", [staging.COPIES_A_BLOCK, 5])
def test_scenarios_staged_by_order_equal_those_staged_alone(spark, rides, monkeypatch, block):
    monkeypatch.setattr(faults, "BOUNDARY_ROWS", 3)
    monkeypatch.setattr(staging, "COPIES_A_BLOCK", block)
    found = faults.scenarios(rides, CHAINS, rates=RATES)
    parts = found.by_order()
    assert len(parts) == (2 if block == 5 else 1)
    staged = quality.union_all([staging.stage_rides(p, YEARS, tags=TAGS) for p in parts])
    once = staged.where(F.col(faults.SCENARIO).isNull()).select("order_id").distinct().count()
    assert 10 < once < rides.select("order_id").distinct().count()
    got = found.each(staged)
    for name, chain in CHAINS.items():
        alone = staging.stage_rides(faults.inject_faults(rides, chain, rates=RATES), YEARS)
        assert content(got.where(F.col(faults.SCENARIO) == name), alone.columns) == content(alone, alone.columns), name


def test_rows_by_order_are_the_scenarios_rows(spark, rides):
    found = faults.scenarios(rides, CHAINS, rates=RATES)
    shared = found.each(quality.union_all(found.by_order()))
    columns = [faults.SCENARIO, *rides.columns]
    assert content(shared, columns) == content(found.rows(), columns)
    clean = faults.scenarios(rides, {"clean": ()})
    assert content(clean.each(clean.by_order()[0]), columns) == content(clean.rows(), columns)


def test_the_rides_of_all_scenarios_are_shuffled_once(spark, monkeypatch):
    kept = []
    monkeypatch.setattr(Q, "keep", lambda df: kept.append(df) or df)
    Q.fault_impact(spark, "/root/testdata/sf0.001")
    assert len(kept) == 1
    plan = kept[0]._jdf.queryExecution().executedPlan().toString()
    # one for the rides and their boundary rows, dealt by order alone
    assert plan.count("Exchange hashpartitioning(") == 1 and "Exchange hashpartitioning(order_id" in plan
