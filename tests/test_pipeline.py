"""Stored tables: period replacement, idempotence, backfill, and layer gates."""

import os
from datetime import date, datetime
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from ledgerflow import Period
from ledgerflow.operators import quality
from ledgerflow.plans.pipeline import Warehouse, backfill, run_period
from ledgerflow.sources.sinks import PeriodTable, append_new_columns, replace_by_key, replace_period
from tests import fixtures

JAN = Period.month(2026, 1)
FEB = Period.month(2026, 2)
TS = datetime(2026, 2, 1, 6, 0)
DROP = ["loaded_at", "quarantined_at"]


def snapshot(wh, name):
    df = wh.read(name)
    df = df.drop(*[c for c in DROP if c in df.columns])
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture()
def clean_books(spark):
    # the fixture without the rows that make gates fail on purpose
    rides = fixtures.rides(spark).where(
        ~F.coalesce(F.col("order_id").isin("o10", "o12"), F.lit(False)) & F.col("order_id").isNotNull())
    return fixtures.books(spark, rides)


def test_run_twice_equals_once(spark, workdir, clean_books):
    wh = Warehouse(spark, os.path.join(workdir, "wh"))
    run_period(spark, clean_books, JAN, wh, TS)
    first = {t: snapshot(wh, t) for t in ["stg_rides", "fct_general_ledger", "fct_trial_balance",
                                          "rpt_balance_sheet_summary"]}
    run_period(spark, clean_books, JAN, wh, TS)
    for t, rows in first.items():
        assert snapshot(wh, t) == rows, t


def test_months_accumulate_and_balance_sheet_is_cumulative(spark, workdir, clean_books):
    wh = Warehouse(spark, os.path.join(workdir, "wh"))
    backfill(spark, clean_books, Period(date(2026, 1, 1), date(2026, 2, 28)), wh, TS)
    iss = {r.period_end: r for r in wh.read("rpt_income_statement_summary").collect()}
    assert set(iss) == {date(2026, 1, 31), date(2026, 2, 28)}
    assert iss[date(2026, 2, 28)].total_revenue == D("5.18")
    bss = {r.report_date: r for r in wh.read("rpt_balance_sheet_summary").collect()}
    assert all(r.equation_balanced for r in bss.values())
    assert bss[date(2026, 2, 28)].total_assets > bss[date(2026, 1, 31)].total_assets


def test_backfill_equals_one_pass(spark, workdir, clean_books):
    two = Period(date(2026, 1, 1), date(2026, 2, 28))
    a = Warehouse(spark, os.path.join(workdir, "a"))
    b = Warehouse(spark, os.path.join(workdir, "b"))
    backfill(spark, clean_books, two, a, TS)
    run_period(spark, clean_books, two, b, TS, full_refresh=True)
    for t in ["stg_rides", "int_journal_entries", "fct_general_ledger", "fct_trial_balance"]:
        assert snapshot(a, t) == snapshot(b, t), t


def test_gate_stops_before_next_layer(spark, workdir):
    books = fixtures.books(spark)
    wh = Warehouse(spark, os.path.join(workdir, "wh"))
    with pytest.raises(quality.QualityError) as err:
        run_period(spark, books, JAN, wh, TS)
    failing = {(m, k, c) for m, k, c, _ in err.value.failing}
    assert ("stg_rides", "accepted_values", "country") in failing
    assert ("stg_rides", "not_null", "order_id") in failing
    assert not PeriodTable(spark, os.path.join(workdir, "wh", "int_journal_entries"), "ride_date",
                           workdir).exists()


def test_warn_mode_records_all_layers(spark, workdir):
    books = fixtures.books(spark)
    wh = Warehouse(spark, os.path.join(workdir, "wh"))
    res = run_period(spark, books, JAN, wh, TS, gate="warn")
    assert set(res.reports) == {"staging", "intermediate", "general_ledger", "trial_balance",
                                "reports"}
    failing = {(m, k) for m, k, _, _ in res.failing}
    assert ("int_journal_entries", "assert_journal_entries_balance") in failing
    assert ("fct_general_ledger", "assert_gl_total_balance") in failing
    assert ("rpt_balance_sheet_summary", "assert_balance_sheet_equation") in failing
    total = sum(len(rows) for rows in res.reports.values())
    assert total == 75


def test_replacement_keeps_null_dates_and_other_months(spark, workdir):
    t = PeriodTable(spark, os.path.join(workdir, "t"), "d", workdir)
    schema = "k string, d date, v int"
    t.overwrite(spark.createDataFrame([("a", date(2026, 1, 5), 1), ("b", date(2026, 2, 5), 1),
                                       ("c", None, 1)], schema))
    t.replace(spark.createDataFrame([("a2", date(2026, 1, 6), 2)], schema), JAN)
    got = sorted((r.k, r.v) for r in t.read().collect())
    assert got == [("a2", 2), ("b", 1), ("c", 1)]
    # a period with no fresh rows empties its months
    t.replace(spark.createDataFrame([], schema), FEB)
    assert sorted(r.k for r in t.read().collect()) == ["a2", "c"]


def test_mid_month_delete_bounds(spark, workdir):
    schema = "k string, d date, v int"
    rows = [("early", date(2026, 1, 3), 1), ("late", date(2026, 1, 20), 1)]
    mid = Period(date(2026, 1, 15), date(2026, 1, 31))
    exact = PeriodTable(spark, os.path.join(workdir, "exact"), "d", workdir)
    whole = PeriodTable(spark, os.path.join(workdir, "whole"), "d", workdir, whole_months=True)
    for t in (exact, whole):
        t.overwrite(spark.createDataFrame(rows, schema))
        t.replace(spark.createDataFrame([("late", date(2026, 1, 21), 2)], schema), mid)
    assert sorted(r.k for r in exact.read().collect()) == ["early", "late"]
    assert sorted(r.k for r in whole.read().collect()) == ["late"]


def test_replace_loses_no_row_and_no_column(spark, workdir):
    t = PeriodTable(spark, os.path.join(workdir, "t"), "d", workdir)
    t.overwrite(spark.createDataFrame([("a", date(2026, 1, 5), 1, "n"), ("f", date(2026, 2, 5), 1, "m")],
                                      "k string, d date, v int, note string"))
    t.replace(spark.createDataFrame([("a2", date(2026, 1, 6), 2), ("nul", None, 2), ("feb", date(2026, 2, 7), 2),
                                     ("mar", date(2026, 3, 7), 2)], "k string, d date, v int"), JAN)
    assert sorted((r.k, r.note) for r in t.read().select("k", "note").fillna("-").collect()) == [
        ("a2", "-"), ("f", "m"), ("feb", "-"), ("mar", "-"), ("nul", "-")]


def test_mid_month_run_keeps_earlier_days(spark, workdir, clean_books):
    wh = Warehouse(spark, os.path.join(workdir, "wh"))
    run_period(spark, clean_books, JAN, wh, TS)
    before = [sorted(map(str, wh.read(n).drop("loaded_at").collect())) for n in ("stg_rides", "fct_trial_balance")]
    run_period(spark, clean_books, Period(date(2026, 1, 15), date(2026, 1, 31)), wh, TS)
    after = [sorted(map(str, wh.read(n).drop("loaded_at").collect())) for n in ("stg_rides", "fct_trial_balance")]
    assert before == after


def test_long_period_replaces_monthly_snapshots(spark, workdir, clean_books):
    wh = Warehouse(spark, os.path.join(workdir, "wh"))
    backfill(spark, clean_books, Period(date(2026, 1, 1), date(2026, 2, 28)), wh, TS)
    run_period(spark, clean_books, Period(date(2026, 1, 1), date(2026, 2, 28)), wh, TS)
    ends = sorted(r.period_end for r in wh.read("rpt_income_statement_summary").collect())
    assert ends == [date(2026, 2, 28)]


def test_sink_transforms(spark):
    schema = "k string, d date, v int"
    old = spark.createDataFrame([("a", date(2026, 1, 5), 1), ("b", date(2026, 2, 5), 1),
                                 ("n", None, 1), (None, date(2026, 3, 1), 1)], schema)
    fresh = spark.createDataFrame([("a", date(2026, 1, 7), 2)], schema)
    assert sorted(r.k or "-" for r in replace_period(old, fresh, "d", JAN).collect()) == \
        ["-", "a", "b", "n"]
    by_key = replace_by_key(old, fresh.unionByName(
        spark.createDataFrame([(None, date(2026, 3, 2), 3)], schema)), ["k"]).collect()
    assert sorted((r.k or "-", r.v) for r in by_key) == [("-", 1), ("-", 3), ("a", 2), ("b", 1),
                                                          ("n", 1)]
    wide = fresh.withColumn("note", F.lit("x"))
    out = append_new_columns(old, wide)
    assert out.columns == ["k", "d", "v", "note"]
    assert out.where("note is null").count() == 4


def test_fault_evaluation_end_to_end(spark, workdir, clean_books):
    """Prevention faults are filtered and every gate passes; the country fault
    is detected by the staging gate and the run stops."""
    from ledgerflow.operators import faults
    from ledgerflow.sources.adapter import Books
    faulted = faults.inject_faults(clean_books.rides, rates={"null": 0.1, "outlier": 0.1,
                                                             "duplicate": 0.1})
    books = Books(faulted, clean_books.rules, clean_books.accounts, clean_books.countries)
    wh = Warehouse(spark, os.path.join(workdir, "prevent"))
    res = run_period(spark, books, JAN, wh, TS)
    assert res.failing == []
    reasons = {r.rejection_reason for r in wh.read("stg_rides_quarantine").collect()}
    assert reasons == {"null_financial_amount", "outlier_amount", "duplicate_order"}

    bad = Books(faults.inject_faults(clean_books.rides, ["country"], rates={"country": 0.5}),
                clean_books.rules, clean_books.accounts, clean_books.countries)
    with pytest.raises(quality.QualityError) as err:
        run_period(spark, bad, JAN, Warehouse(spark, os.path.join(workdir, "detect")), TS)
    assert ("stg_rides", "accepted_values", "country") in {(m, k, c) for m, k, c, _ in err.value.failing}


def test_mid_month_report_date_and_cumulative_month(spark, workdir, clean_books):
    """report_date is the exact end date, but balances cover its whole month."""
    from ledgerflow.operators import balances, journal as jmod, posting as pmod, staging, statements
    full = staging.stage_rides(clean_books.rides, JAN)
    gl = pmod.general_ledger(jmod.journal_entries(full), clean_books.rules, clean_books.accounts)
    tb = balances.trial_balance(gl)
    mid = Period(date(2026, 1, 1), date(2026, 1, 10))
    bs_mid = statements.balance_sheet_summary(statements.balance_sheet_detail(tb, mid)).collect()[0]
    bs_end = statements.balance_sheet_summary(statements.balance_sheet_detail(tb, JAN)).collect()[0]
    assert bs_mid.report_date == date(2026, 1, 10)
    assert bs_mid.total_assets == bs_end.total_assets


def test_empty_period_runs_and_reports_null_equity(spark, workdir, clean_books):
    wh = Warehouse(spark, os.path.join(workdir, "wh"))
    res = run_period(spark, clean_books, Period.month(2025, 6), wh, TS, gate="warn")
    assert wh.read("stg_rides").count() == 0
    bsd = wh.read("rpt_balance_sheet_detail").collect()
    assert [(r.section, r.balance) for r in bsd] == [("Equity", None)]
    assert ("rpt_balance_sheet_detail", "not_null", "balance") in \
        {(m, k, c) for m, k, c, _ in res.failing}
