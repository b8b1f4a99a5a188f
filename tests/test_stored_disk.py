"""Stored runs leave no shuffle files behind, and shuffle rides only where rows have to meet."""

import os
from datetime import date, datetime, timedelta
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerflow import Period
from ledgerflow import schemas as S
from ledgerflow.operators import staging
from ledgerflow.plans.pipeline import Warehouse, run_period
from ledgerflow.session import keep, settings
from ledgerflow.sources import sinks
from ledgerflow.sources.adapter import Books
from ledgerflow.sources.files import read_rides, ride_files
from tests import fixtures

TWO = Period(date(2026, 1, 1), date(2026, 2, 28))
TS = datetime(2026, 3, 1)
TABLES = ["stg_rides", "stg_rides_quarantine", "int_journal_entries", "fct_general_ledger", "fct_trial_balance"]


def shuffles(spark) -> int:
    """Shuffles whose files are still there."""
    return spark.sparkContext._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()


@pytest.fixture()
def books(spark, workdir):
    base = datetime(2026, 1, 20, 8, 0)
    # an order with many rows in two months, some of them equal, and one whose money is null now and then
    more = [(o, None if i % 5 == 0 else i % 3, 1, base + timedelta(days=i % 4 * 9), base, i % 4, 1.0,
             None if o == "n" and i % 2 else D("5.18"), 0.24, D("1.24"), D("6.42"), "EUR", "COUP-1", D("1.00"), "Tallinn", "Estonia")
            for o in ("h", "n") for i in range(30)]
    folder = os.path.join(workdir, "rides")
    spark.createDataFrame(fixtures.ride_rows() + more, S.RIDES).write.parquet(folder)
    plain = fixtures.books(spark)
    return Books(read_rides(spark, folder, "parquet"), plain.rules, plain.accounts, plain.countries,
                 ride_files(spark, folder, "parquet"))


def content(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("block", [staging.COPIES_A_BLOCK, 7])
def test_a_full_refresh_stores_what_both_operators_give(spark, workdir, books, monkeypatch, block):
    monkeypatch.setattr(staging, "COPIES_A_BLOCK", block)
    for source in (books.source, None):
        wh = Warehouse(spark, os.path.join(workdir, f"wh-{source is None}"))
        rides = Books(books.rides, books.rules, books.accounts, books.countries, source)
        res = run_period(spark, rides, TWO, wh, TS, gate="warn", full_refresh=True)
        for name, stamp, want in (("stg_rides", "loaded_at", staging.stage_rides(books.rides, TWO)),
                                  ("stg_rides_quarantine", "quarantined_at", staging.quarantine_rides(books.rides, TWO))):
            got = wh.read(name)
            assert got.columns == [*want.columns, stamp] and want.count() > 10
            assert content(got.drop(stamp)) == content(want)
            assert got.where(F.col(stamp) == F.lit(TS)).count() == want.count()
        checks = {(m, k, c): n for m, k, c, n in res.reports["staging"]}
        assert checks["stg_rides", "accepted_values", "country"] == 1 and checks["stg_rides", "not_null", "order_id"] == 1
        assert checks["stg_rides_quarantine", "not_null", "order_id"] == 1 and checks["stg_rides", "not_null", "amount"] == 0
        assert not [n for n in os.listdir(wh.root) if n.startswith("sorted-out")]


def test_a_stored_run_leaves_no_shuffle_files(spark, workdir, books):
    wh = Warehouse(spark, os.path.join(workdir, "wh"))
    before = shuffles(spark)
    run_period(spark, books, TWO, wh, TS, gate="warn", full_refresh=True)
    run_period(spark, books, Period.month(2026, 1), wh, TS, gate="warn")
    assert shuffles(spark) <= before


def test_kept_frames_leave_no_shuffle_files_and_settings_come_back(spark):
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    old, before = spark.conf.get(name), shuffles(spark)
    kept = keep(spark.range(1000).repartition(5).groupBy((F.col("id") % 7).alias("k")).count())
    assert kept.count() == 7 and spark.conf.get(name) == old
    assert shuffles(spark) <= before + 1  # that of the count above
    with pytest.raises(ValueError), settings(spark, {name: "true", "spark.sql.unknown.setting": "1"}):
        assert spark.conf.get(name) == "true"
        raise ValueError
    assert spark.conf.get(name) == old


def test_lines_of_stored_rides_are_written_without_a_shuffle(spark, workdir, books, monkeypatch):
    plans = []

    def write(self, df, by_month=False, real=sinks.PeriodTable._write):
        plans.append((os.path.basename(self.path), by_month, df._jdf.queryExecution().executedPlan().toString()))
        return real(self, df, by_month)

    monkeypatch.setattr(sinks.PeriodTable, "_write", write)
    run_period(spark, books, TWO, Warehouse(spark, os.path.join(workdir, "wh")), TS, gate="warn", full_refresh=True)
    lines = [p for p in plans if p[0] in ("int_journal_entries", "fct_general_ledger")]
    assert len(lines) == 2
    for _, by_month, plan in lines:
        assert by_month and "Exchange hashpartitioning" not in plan and "Exchange rebalance" not in plan and "Sort" not in plan


def test_rides_meet_once_by_order_and_are_dealt_once_by_month(spark, books):
    rows = staging.both_projections(sinks.rows_by_month(staging.sorted_out(books.rides, TWO), "start_time"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(") == 2 and plan.count("FileScan") == 1
    assert "hashpartitioning(order_id" in plan and "hashpartitioning(__month" in plan
