"""Fault injection: exact seeded picks, each fault's effect, and the gates."""

from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerflow.operators import balances, faults, journal, posting, staging
from ledgerflow.plans.context import FULL
from ledgerflow.session import keep
from ledgerflow.sources import adapter

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def rides(spark):
    return adapter.adapter_rides(spark, SF)


def test_fault_count():
    assert faults.fault_count(60000, 0.005) == 300
    assert faults.fault_count(10, 0.005) == 1
    assert faults.fault_count(60300, 0.003) == 180


def test_picks_are_exact_and_deterministic(spark, rides):
    n = rides.count()
    a = faults.fault_sample(rides, 0.05, "7-x").collect()
    b = faults.fault_sample(rides.repartition(3), 0.05, "7-x").collect()
    assert len(a) == faults.fault_count(n, 0.05)
    assert sorted(a) == sorted(b)
    hashes = sorted(r.pick_hash for r in a)
    everything = sorted(r[0] for r in rides.select(faults.pick_hash("7-x")).collect())
    assert hashes == everything[:len(hashes)]


def test_small_boundary_forces_narrowing(spark, rides, monkeypatch):
    monkeypatch.setattr(faults, "BOUNDARY_ROWS", 3)
    a = faults.fault_sample(rides, 0.1, "9-y").collect()
    assert len(a) == faults.fault_count(rides.count(), 0.1)


def test_each_fault(spark, rides):
    n = rides.count()
    nulls = faults.inject_null(rides).where(F.col("amount").isNull()).count()
    base_nulls = rides.where(F.col("amount").isNull()).count()
    assert base_nulls < nulls <= base_nulls + faults.fault_count(n, 0.005)
    assert faults.inject_duplicate(rides).count() == n + faults.fault_count(n, 0.005)
    assert faults.inject_country(rides).where(F.col("country") == "Tartu").count() == \
        faults.fault_count(n, 0.002)
    out = faults.inject_outlier(rides).where(F.col("amount") > D("50.00")).count()
    assert out >= rides.where(F.col("amount") > D("50.00")).count()


def test_unknown_fault_is_an_error(rides):
    with pytest.raises(ValueError):
        faults.inject_faults(rides, ["null", "typo"])


def test_prevention_faults_are_quarantined(spark, rides):
    faulted = faults.inject_faults(rides)
    staged = staging.stage_rides(faulted, FULL)
    assert staged.where(F.col("amount").isNull()).count() == 0
    assert staged.groupBy("order_id").count().where("count > 1").count() == 0
    q = staging.quarantine_rides(faulted, FULL)
    assert q.where("rejection_reason = 'duplicate_order'").count() > 0


def content(df, columns):
    return sorted(map(str, df.select(*columns).collect()))


def test_scenarios_equal_their_chains_injected_alone(spark, rides, monkeypatch):
    monkeypatch.setattr(faults, "BOUNDARY_ROWS", 3)
    # one order with many rows of one ride: they share every hash, so only their content ranks them
    one = rides.limit(1)
    crowd = (one.crossJoin(spark.range(40).withColumnRenamed("id", "n"))
             .withColumn("amount", F.when(F.col("n") % 4 == 0, F.lit(None)).otherwise(F.col("n") % 5)
                         .cast(rides.schema["amount"].dataType)).drop("n"))
    table = rides.sample(0.1, seed=1).unionByName(crowd.select(*rides.columns))
    chains = {"clean": (), "all": ("null", "outlier", "duplicate"), "mixed": ("null", "country")}
    rates = {"null": 0.5, "outlier": 0.4, "duplicate": 0.6, "country": 0.3}
    got = faults.fault_scenarios(table, chains, rates=rates)
    assert got.columns == ["scenario", *rides.columns]
    for name, chain in chains.items():
        alone = faults.inject_faults(table, chain, rates=rates)
        assert content(got.where(F.col("scenario") == name), rides.columns) == content(alone, rides.columns), name


def test_scenarios_of_an_empty_table_and_bad_chains(spark, rides):
    chains = {"clean": (), "all": ("null", "outlier", "duplicate")}
    assert faults.fault_scenarios(rides.limit(0), chains).count() == 0
    with pytest.raises(ValueError):
        faults.fault_scenarios(rides, {"a": ("typo",)})
    with pytest.raises(ValueError):
        faults.fault_scenarios(rides, {"a": ("duplicate", "null")})


def test_tagged_books_are_staged_and_posted_apart(spark, rides):
    books = adapter.adapter_books(spark, SF)
    rows = faults.fault_scenarios(rides, {"clean": (), "country": ("country",)})
    tags = ("scenario",)
    staged = staging.stage_rides(rows, FULL, tags=tags)
    tb = balances.trial_balance(posting.general_ledger(journal.journal_entries(staged, tags), books.rules,
                                                       books.accounts, tags=tags), tags=tags)
    for name, table in (("clean", rides), ("country", faults.inject_country(rides))):
        alone = balances.trial_balance(posting.general_ledger(
            journal.journal_entries(staging.stage_rides(table, FULL)), books.rules, books.accounts))
        assert content(tb.where(F.col("scenario") == name), alone.columns) == content(alone, alone.columns)


def test_a_chain_equals_its_faults_one_by_one(spark, rides, monkeypatch):
    monkeypatch.setattr(faults, "BOUNDARY_ROWS", 3)
    table = rides.sample(0.1, seed=2)
    table = table.unionByName(table.limit(1).crossJoin(spark.range(30)).select(*rides.columns))
    rates = {"null": 0.3, "outlier": 0.4, "duplicate": 0.5, "country": 0.2}
    for chain in (("null", "outlier", "duplicate"), ("duplicate", "country", "null"), ("outlier",)):
        one_by_one = table
        for f in chain:
            one_by_one = faults.FAULTS[f](one_by_one, rates[f])
        got = faults.inject_faults(table, chain, rates=rates)
        assert content(got, rides.columns) == content(one_by_one, rides.columns), chain


def test_a_chain_writes_the_table_once(spark, rides, monkeypatch):
    kept = []
    monkeypatch.setattr(faults, "keep", lambda df: kept.append(df) or keep(df))
    faults.inject_faults(rides)
    assert len(kept) == 1
    assert {f"_head{i}" for i in range(3)} <= set(kept[0].columns)


def test_boundaries_beyond_the_written_digits(spark, rides, monkeypatch):
    # many rows share one hash: the boundary is the whole hash, the digits beside the rows only its head
    monkeypatch.setattr(faults, "BOUNDARY_ROWS", 3)
    crowd = rides.limit(1).crossJoin(spark.range(50)).select(*rides.columns)
    texts = {f"7-{f}": 25 for f in ("a", "b")}
    got = faults._boundaries(crowd, texts)
    assert got == {t: (crowd.select(faults.pick_hash(t)).first()[0], 25) for t in texts}
    heads = crowd.withColumns({f"_head{i}": F.substring(faults.pick_hash(t), 1, faults.HEAD)
                               for i, t in enumerate(texts)})
    assert faults._boundaries(heads, texts, {t: f"_head{i}" for i, t in enumerate(texts)}) == got
