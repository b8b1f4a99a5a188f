"""Numbering that is spread over tasks equals one sorted list, whatever the pieces."""

from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from ledgerflow import Period
from ledgerflow import schemas as S
from ledgerflow.operators import faults, staging
from ledgerflow.operators.ranking import running_sum
from ledgerflow.plans.context import FULL, Ledger
from ledgerflow.sources import adapter
from tests import fixtures


def _ids(df):
    return sorted((r.quarantine_id, r.reject_seq) for r in df.collect())


@pytest.fixture()
def many_pieces(spark):
    """Ranges of a few rows: every shuffle has 50 partitions that stay apart."""
    conf = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def hot_rides(spark):
    # one hot group: the same (null order, ride 7) with many distinct null-money rows,
    # most sharing a start time, plus exact copies
    base = datetime(2026, 1, 3, 8, 0)
    rows = []
    for i in range(60):
        st = base + timedelta(minutes=(i // 20) * 7)
        rows.append((None, 7, 1, st, st + timedelta(minutes=5), 5 + i, 1.0, None, 0.24, None, None,
                     "EUR", None, None, "Tallinn", "Estonia"))
    rows += rows[:5] + [rows[30]] * 300
    return spark.createDataFrame(rows, S.RIDES)


def expected_ids(rows):
    """Numbers by one sort of all rows a group."""
    groups = {}
    for r in rows:
        groups.setdefault((r.order_id, r.ride_id, r.rejection_reason), []).append(r.reject_seq)
    return {k: sorted(v) for k, v in groups.items()}


def test_numbers_are_gapless_in_hot_groups(spark, many_pieces, monkeypatch):
    monkeypatch.setattr(staging, "COPIES_A_BLOCK", 7)
    rides = hot_rides(spark).unionByName(fixtures.rides(spark))
    got = staging.quarantine_rides(rides, Period.month(2026, 1), with_seq=True).collect()
    for seqs in expected_ids(got).values():
        assert seqs == list(range(1, len(seqs) + 1))
    hot = sorted((r.reject_seq, r.start_time, r.duration_min) for r in got if r.ride_id == 7 and r.order_id is None)
    assert len(hot) == 365
    assert [x[1:] for x in hot] == sorted(x[1:] for x in hot)
    assert len({r.quarantine_id for r in got}) == len(got)


def test_pieces_do_not_change_ids(spark, many_pieces, monkeypatch):
    rides = faults.inject_faults(adapter.adapter_rides(spark, "/root/testdata/sf0.001"),
                                 rates={"null": 0.05, "outlier": 0.05, "duplicate": 0.05})
    spread = _ids(staging.quarantine_rides(rides, FULL, with_seq=True))
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    assert _ids(staging.quarantine_rides(rides, FULL, with_seq=True)) == spread


def test_running_sum_equals_a_loop(spark, many_pieces):
    rows = [(None if k % 3 == 0 else "g" * (k % 2), k * 37 % 101, k % 5) for k in range(101)]
    df = spark.createDataFrame(rows, "g string, o int, v int")
    got = {(r.g, r.o): r.s for r in running_sum(df, ["g"], [F.col("o").asc()], "v", "s").collect()}
    total = {}
    for g, o, v in sorted(rows, key=lambda r: (str(r[0]), r[1])):
        total[g] = total.get(g, 0) + v
        assert got[g, o] == total[g]
    alone = running_sum(df, [], [F.col("o").asc()], "v", "s").orderBy("o").collect()
    assert alone[-1].s == sum(r[2] for r in rows)


def test_faults_pick_among_equal_keys_without_collecting_them(spark, many_pieces):
    # all rows share one key, so one hash: 366 picks must come from content and copies alone
    rides = hot_rides(spark)
    marked = faults.mark_picks(rides, 0.5, "1-x")
    hits = marked.where("_hit").select(*rides.columns).collect()
    assert len(hits) == 365 // 2 and marked.count() == 365
    order = sorted((r.start_time, r.scooter_id, r.end_time, r.duration_min) for r in rides.collect())
    assert sorted((r.start_time, r.scooter_id, r.end_time, r.duration_min) for r in hits) == order[:365 // 2]


def test_crowded_and_other_orders_are_numbered_alike(spark, many_pieces, monkeypatch):
    def quarantined(scope):
        return sorted(map(str, staging.quarantine_rides(rides, Period.month(2026, 1), dedup_scope=scope,
                                                        with_seq=True).collect()))
    base = datetime(2026, 1, 3, 8, 0)
    # one order with many clean rows, some of them equal, starting in three months
    hot = [("h", i % 3, 1, base + timedelta(days=30 * (i % 4) - 31), base, i % 7, 1.0, Decimal("5.18"), 0.24, Decimal("1.24"),
            Decimal("6.42"), "EUR", None, None, "Tallinn", "Estonia") for i in range(60)]
    rides = hot_rides(spark).unionByName(fixtures.rides(spark)).unionByName(spark.createDataFrame(hot, S.RIDES))
    for scope in staging.DEDUP_SCOPES:
        together = quarantined(scope)
        with monkeypatch.context() as m:
            m.setattr(staging, "COPIES_A_BLOCK", 7)
            assert len(staging._crowded_buckets(rides, 7)) == 2
            assert quarantined(scope) == together, scope


def test_orders_that_are_not_crowded_meet_once(spark):
    q = staging.quarantine_rides(adapter.adapter_rides(spark, "/root/testdata/sf0.001"), FULL, with_seq=True)
    p = q._jdf.queryExecution().executedPlan().toString()
    assert p.count("lineitem.parquet") == 1 and p.count("Exchange hashpartitioning(order_id") == 1


def test_one_pass_stages_and_rejects_like_two(spark, many_pieces, monkeypatch):
    def both(period):
        rows = staging.staged_and_rejected(rides, period)
        staged = rows.where("rejection_reason IS NULL").drop("rejection_reason", "quarantine_id")
        ids = rows.where("rejection_reason IS NOT NULL").select("quarantine_id", "order_id", "rejection_reason")
        return sorted(map(str, staged.collect())), sorted(map(str, ids.collect()))

    base = datetime(2026, 1, 3, 8, 0)
    # orders with equal rows, null rides and rows before the period; the null order has clean rows, too
    more = [(o, None if i % 5 == 0 else i % 3, 1, base + timedelta(days=i % 4 * 30 - 31), base, i % 4, 1.0, Decimal("5.18"),
             0.24, Decimal("1.24"), Decimal("6.42"), "EUR", None, None, "Tallinn", "Estonia")
            for o in ("h", "k", None) for i in range(0 if o == "h" else 1, 40)]
    late = [("late", r, 1, base, base, 1, 1.0, Decimal("5.18"), 0.24, Decimal("1.24"), Decimal("6.42"), "EUR", None, None,
             "Tallinn", "Estonia") for r in (None, 2, 2, 1)]
    rides = hot_rides(spark).unionByName(fixtures.rides(spark)).unionByName(spark.createDataFrame(more + late, S.RIDES))
    for period in (Period.month(2026, 1), Period(datetime(2025, 1, 1).date(), datetime(2027, 1, 1).date())):
        staged = staging.stage_rides(rides, period)
        want = (sorted(map(str, staged.select("order_id", *[c for c in staged.columns if c != "order_id"]).collect())),
                sorted(map(str, staging.quarantine_rides(rides, period).select(
                    "quarantine_id", "order_id", "rejection_reason").collect())))
        assert want[0] and want[1] and both(period) == want
        with monkeypatch.context() as m:
            m.setattr(staging, "COPIES_A_BLOCK", 7)
            assert both(period) == want


def test_checked_layers_share_one_shuffle_of_the_rides(spark):
    rows = staging.staged_and_rejected(adapter.adapter_rides(spark, "/root/testdata/sf0.001"), FULL)
    p = rows._jdf.queryExecution().executedPlan().toString()
    assert p.count("lineitem.parquet") == 1 and p.count("Exchange hashpartitioning(") == 1 and p.count("Sort [") == 1
    lg = Ledger(spark, "/root/testdata/sf0.001", FULL, materialize=True)
    assert lg.staged.inputFiles() == lg.quarantine.inputFiles()
