"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads the driver's tables (through the adapter) and runs over
whole tables; periods only select what the operator itself selects.
Audit timestamps are left out of query results.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerflow import functions as LF
from ledgerflow import schemas as S
from ledgerflow.operators import (balances, billing, faults, journal, posting, quality, reconcile,
                                  staging, statements, trace)
from ledgerflow.periods import Period, bounds_columns
from ledgerflow.plans.context import (EARLY_DAYS, FULL, MONTH, PREVIEW_ROWS, TRACE_ACCOUNT, TRACE_COUNTRY,
                                      Ledger)
from ledgerflow.plans.pipeline import Warehouse, run_period
from ledgerflow.session import keep, shared_folder
from ledgerflow.sources import adapter, sinks
from ledgerflow.sources.orderstate import OrderState

Query = Callable[[SparkSession, str], DataFrame]

# Audit timestamp used when checks need the audit columns (never returned).
RUN_TS = datetime(2000, 1, 1)
# Boundary of the "old schema" rows in the added-column example.
SCHEMA_CHANGE_DATE = date(1998, 1, 1)
# Part of the month that the stored runs build again.
MID_MONTH = Period(date(1998, 3, 10), date(1998, 3, 20))


def _full(spark, sf_dir) -> Ledger:
    return Ledger(spark, sf_dir, FULL)


def _month(spark, sf_dir) -> Ledger:
    return Ledger(spark, sf_dir, MONTH)


def _to_month(spark, sf_dir) -> Ledger:
    """Everything up to the month's end: what a cumulative sheet of that date sums."""
    return Ledger(spark, sf_dir, Period(FULL.start, MONTH.end))


# -- sources and sinks ---------------------------------------------------------

def scan_rides(spark, sf_dir):
    return _full(spark, sf_dir).rides


def posting_rules(spark, sf_dir):
    return posting.posting_rules(_full(spark, sf_dir).books.rules)


def chart_of_accounts(spark, sf_dir):
    """The chart of accounts with how much each account received in the ledger."""
    lg = _full(spark, sf_dir)
    usage = lg.ledger.groupBy("account_code").agg(
        F.count(F.lit(1)).alias("posted_lines"),
        LF.sum_money(F.col("signed_amount")).alias("posted_amount"))
    chart = posting.chart_of_accounts(lg.books.accounts)
    return (chart.join(usage, "account_code", "left")
            .select("account_code", "account_name", "account_category", "normal_side",
                    F.coalesce("posted_lines", F.lit(0)).cast("bigint").alias("posted_lines"),
                    F.coalesce("posted_amount", F.lit(0)).cast(S.REPORT_MONEY).alias("posted_amount")))


def _month_rerun_journal(spark, sf_dir) -> DataFrame:
    """March 1998 re-run with the period-scoped dedup: the fresh rows to write."""
    lg = _full(spark, sf_dir)
    return journal.journal_entries(staging.stage_rides(lg.rides, MONTH, dedup_scope="period"))


def replace_period(spark, sf_dir):
    existing = _full(spark, sf_dir).journal
    return sinks.replace_period(existing, _month_rerun_journal(spark, sf_dir), "ride_date", MONTH)


def replace_by_key(spark, sf_dir):
    existing = _full(spark, sf_dir).journal
    return sinks.replace_by_key(existing, _month_rerun_journal(spark, sf_dir), ["journal_entry_id"])


def append_new_columns(spark, sf_dir):
    staged = _full(spark, sf_dir).staged
    cut = F.lit(SCHEMA_CHANGE_DATE)
    old = staged.where(F.col("ride_date") < cut).drop("coupon_code")
    new = staged.where(F.col("ride_date") >= cut)
    return sinks.append_new_columns(old, new)


def trace_account_to_ledger(spark, sf_dir):
    gl = _full(spark, sf_dir).ledger
    return trace.ordered(trace.drill_to_ledger(gl, TRACE_ACCOUNT, MONTH, TRACE_COUNTRY),
                         "order_id", "line_number")


def trace_order(spark, sf_dir):
    lg = _full(spark, sf_dir)
    lines = trace.drill_to_ledger(lg.ledger, TRACE_ACCOUNT, MONTH, TRACE_COUNTRY)
    return trace.ordered(trace.drill_to_source(lg.rides, lines), "order_id", "start_time", "ride_id")


# -- periods -------------------------------------------------------------------

def period_bounds(spark, sf_dir):
    """Period defaults as a monthly run on each ride date would derive them."""
    dates = _full(spark, sf_dir).rides.select(F.to_date("start_time").alias("run_date")).distinct()
    return dates.select("run_date", *bounds_columns(F.col("run_date")))


def backfill_months(spark, sf_dir):
    """Statement series a month-by-month backfill leaves behind, built in one pass.

    Each month's income statement covers that month; each balance sheet is
    cumulative up to the month. A month without lines has no income statement
    (null) and carries the balance sheet on. The per-month table has one row
    per month, so the running window over it is bounded by the number of months.
    """
    months = spark.range(1).select(F.explode(F.sequence(
        F.lit(FULL.start), F.lit(FULL.end), F.expr("INTERVAL 1 MONTH"))).alias("reporting_period"))
    tb = _full(spark, sf_dir).trial_balance
    cat, net = F.col("account_category"), F.col("net_balance")
    monthly = tb.groupBy("reporting_period").agg(
        LF.report_money(-F.sum(F.when(cat == "revenue", net).otherwise(0))).alias("total_revenue"),
        LF.sum_when(cat == "expense", net).alias("total_expenses"),
        LF.sum_when(cat == "asset", net).alias("_assets"),
        LF.report_money(-F.sum(F.when(cat == "liability", net).otherwise(0))).alias("_liabilities"),
        LF.report_money(-F.sum(F.when(cat.isin("revenue", "expense"), net).otherwise(0)))
        .alias("_equity"))
    w = Window.orderBy("reporting_period").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    a = LF.report_money(F.sum("_assets").over(w))
    li = LF.report_money(F.sum("_liabilities").over(w))
    e = LF.report_money(F.sum("_equity").over(w))
    out = months.join(monthly, "reporting_period", "left").select(
        F.col("reporting_period").alias("period_start"),
        F.last_day("reporting_period").alias("period_end"),
        "total_revenue", "total_expenses",
        LF.report_money(F.col("total_revenue") - F.col("total_expenses")).alias("net_income"),
        a.alias("total_assets"), li.alias("total_liabilities"), e.alias("total_equity"))
    return out.withColumn(
        "equation_balanced",
        F.abs(F.col("total_assets") - (F.col("total_liabilities") + F.col("total_equity")))
        < F.lit(S.BALANCE_TOLERANCE))


def stored_reruns(spark, sf_dir):
    """Trial balance read back from stored tables: a full build, then one month and part of it again.

    Re-running periods through the stored tables leaves what one build from
    scratch gives. The tables are written to the shared folder. Every layer is gated; the adapter's
    country without posting rules fails some checks on purpose, so the gates warn.
    """
    books = _full(spark, sf_dir).books
    wh = Warehouse(spark, _new_folder(spark, "stored"), shared_folder(spark))
    run_period(spark, books, FULL, wh, RUN_TS, gate="warn", full_refresh=True)
    for again in (MONTH, MID_MONTH):
        run_period(spark, books, again, wh, RUN_TS, gate="warn")
    return wh.read("fct_trial_balance")


def _new_folder(spark, name: str) -> str:
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored_key_replacement(spark, sf_dir):
    """Staged rides after a correction that moves orders to another month.

    The stored table holds the rides of EARLY_DAYS four weeks early, in the month before. The month's
    re-run from the corrected source brings their orders again: the old rows give way by key.
    """
    rides = _full(spark, sf_dir).rides
    moved = staging.in_period_by_start(EARLY_DAYS)
    booked_early = rides.withColumn("start_time", F.when(moved, F.col("start_time") - F.expr("INTERVAL 28 DAYS"))
                                    .otherwise(F.col("start_time")))
    table = sinks.PeriodTable(spark, _new_folder(spark, "staged"), "ride_date", keys=["order_id"])
    table.overwrite(staging.stage_rides(booked_early, FULL))
    table.replace(staging.stage_rides(rides, MONTH), MONTH)
    return table.read()


def stored_repeated_keys(spark, sf_dir):
    """Journal entries that occur in several stored months, by their number of copies.

    Each month deduplicated on its own leaves orders that several months hold; the stored table's
    key index finds their entries without opening the table.
    """
    staged = staging.stage_rides(_full(spark, sf_dir).rides, FULL, dedup_scope="month")
    table = sinks.PeriodTable(spark, _new_folder(spark, "journal"), "ride_date", keys=["journal_entry_id"])
    table.overwrite(journal.journal_entries(sinks.rows_by_month(staged, "ride_date")), by_month=True)
    repeated = table.duplicate_keys()
    return repeated.groupBy("copies").agg(F.count(F.lit(1)).alias("entries"))


def stored_closing_balances(spark, sf_dir):
    """Closing balances a month, carried on after a correction of past months.

    The trial balance is stored with the rides of EARLY_DAYS four weeks early, and balances are
    carried to its end. Then the two months are stored again as they should be: closings up to the
    month before stay, all later ones are carried on anew.
    """
    lg = _full(spark, sf_dir)
    moved = staging.in_period_by_start(EARLY_DAYS)
    booked_early = lg.rides.withColumn("start_time", F.when(moved, F.col("start_time") - F.expr("INTERVAL 28 DAYS"))
                                       .otherwise(F.col("start_time")))
    wh = Warehouse(spark, _new_folder(spark, "closing"), shared_folder(spark))
    stored, carried = wh.table("fct_trial_balance"), wh.closing_balances()

    def balance(rides):
        staged = staging.stage_rides(rides, FULL)
        return balances.trial_balance(posting.general_ledger(journal.journal_entries(staged), lg.books.rules,
                                                             lg.books.accounts))
    stored.overwrite(balance(booked_early))
    carried.refresh()
    again = Period(date(1998, 2, 1), MONTH.end)
    stored.replace(balance(lg.rides).where(again.contains_month(F.col("reporting_period"))), again)
    carried.refresh()
    return carried.table.read()


def stage_month_by_state(spark, sf_dir):
    """One month staged from its own rows and the first-seen state of orders, without the history."""
    books = _full(spark, sf_dir).books
    state = OrderState(spark, _new_folder(spark, "order-state"))
    state.refresh(books.source)
    own = books.rides.where(staging.in_period_by_start(MONTH))
    return state.first_seen_in(staging.stage_rides(own, MONTH), MONTH)


# -- projections and filters ---------------------------------------------------

def guard_not_null(spark, sf_dir):
    return staging.guard_not_null(_full(spark, sf_dir).rides)


def guard_outlier(spark, sf_dir):
    return staging.guard_outlier(staging.guard_not_null(_full(spark, sf_dir).rides))


def stg_rides(spark, sf_dir):
    return _full(spark, sf_dir).staged


def coupon_normalised(spark, sf_dir):
    r = _full(spark, sf_dir).rides
    return r.select("order_id", "ride_id",
                    F.col("coupon_used").alias("original_coupon_used"),
                    F.col("coupon_amount").alias("original_coupon_amount"),
                    LF.coupon_code(F.col("coupon_used")).alias("coupon_code"),
                    LF.coupon_amount_or_zero(F.col("coupon_used"), F.col("coupon_amount"))
                    .alias("coupon_amount"))


def journal_entries(spark, sf_dir):
    return _full(spark, sf_dir).journal


def journal_ids(spark, sf_dir):
    return _full(spark, sf_dir).journal.select("order_id", "line_type", "journal_entry_id")


def general_ledger(spark, sf_dir):
    return _full(spark, sf_dir).ledger


def general_ledger_month(spark, sf_dir):
    return _month(spark, sf_dir).ledger


def unposted_lines(spark, sf_dir):
    lg = _full(spark, sf_dir)
    return posting.unposted_lines(lg.journal, lg.books.rules, lg.books.accounts)


# -- quarantine ----------------------------------------------------------------

def dedup_orders(spark, sf_dir):
    return staging.dedup_orders(_full(spark, sf_dir).rides)


def quarantine(spark, sf_dir):
    return _full(spark, sf_dir).quarantine


def _faulted_rides(spark, sf_dir) -> DataFrame:
    return faults.inject_faults(_full(spark, sf_dir).rides)


def quarantine_ids(spark, sf_dir):
    q = staging.quarantine_rides(_faulted_rides(spark, sf_dir), FULL, with_seq=True)
    return q.select("quarantine_id", "order_id", "ride_id", "rejection_reason", "reject_seq")


def quarantine_summary(spark, sf_dir):
    return reconcile.quarantine_summary(_full(spark, sf_dir).quarantine)


def staging_reconciliation(spark, sf_dir):
    return reconcile.staging_reconciliation(_full(spark, sf_dir).rides, FULL)


# -- aggregates and statements -------------------------------------------------

def trial_balance(spark, sf_dir):
    return _full(spark, sf_dir).trial_balance


def trial_balance_month(spark, sf_dir):
    lg = _month(spark, sf_dir)
    return balances.trial_balance(lg.ledger, MONTH)


def trial_balance_check(spark, sf_dir):
    return balances.trial_balance_check(_full(spark, sf_dir).trial_balance)


def income_statement_detail(spark, sf_dir):
    return _full(spark, sf_dir).is_detail


def income_statement_summary(spark, sf_dir):
    return _full(spark, sf_dir).is_summary


def balance_sheet_detail(spark, sf_dir):
    return _to_month(spark, sf_dir).bs_detail


def balance_sheet_summary(spark, sf_dir):
    return _to_month(spark, sf_dir).bs_summary


def statement_lines_ordered(spark, sf_dir):
    lg = _full(spark, sf_dir)
    return statements.statement_lines(lg.is_detail, lg.bs_detail)


def preview_rides(spark, sf_dir):
    r = _full(spark, sf_dir).rides
    return r.orderBy("scooter_id", "start_time", "order_id", "ride_id").limit(PREVIEW_ROWS)


# -- reconciliation and billing ------------------------------------------------

def direct_income_statement(spark, sf_dir):
    lg = _full(spark, sf_dir)
    return reconcile.direct_income_statement(lg.rides, lg.books.rules, lg.books.accounts)


def direct_income_totals(spark, sf_dir):
    return reconcile.direct_totals(direct_income_statement(spark, sf_dir))


def pnl_reconciliation(spark, sf_dir):
    lg = _full(spark, sf_dir)
    direct = reconcile.direct_income_statement(lg.rides, lg.books.rules, lg.books.accounts)
    return reconcile.pnl_reconciliation(lg.trial_balance, direct)


def mapping_completeness(spark, sf_dir):
    """Posting rules expected for every (line type, country with rides) versus present."""
    lg = _full(spark, sf_dir)
    spine = F.inline(F.array(*[F.struct(F.lit(t).alias("line_type")) for t in S.LINE_TYPES]))
    expected = (lg.rides.select("country").where(F.col("country").isNotNull()).distinct()
                .select(spine, "country").withColumn("_e", F.lit(True)))
    actual = posting.posting_rules(lg.books.rules).select("line_type", "country") \
        .distinct().withColumn("_a", F.lit(True))
    j = expected.join(actual, ["line_type", "country"], "full")
    return (j.where(F.col("_e").isNull() | F.col("_a").isNull())
            .select("line_type", "country",
                    F.when(F.col("_a").isNull(), F.lit("missing")).otherwise(F.lit("unexpected"))
                    .alias("status")))


def range_lookup_city(spark, sf_dir):
    return billing.city_of_vehicle(_full(spark, sf_dir).rides, adapter.city_ranges(spark))


def price_rides(spark, sf_dir):
    return billing.price_rides(_full(spark, sf_dir).rides, adapter.adapter_vat_rates(spark))


def order_uuid(spark, sf_dir):
    return billing.order_uuid(_full(spark, sf_dir).rides)


def rides_per_day_check(spark, sf_dir):
    return billing.rides_per_day_check(_full(spark, sf_dir).rides)


def rides_per_country(spark, sf_dir):
    return billing.rides_per_country(_full(spark, sf_dir).rides)


def billing_validation(spark, sf_dir):
    lg = _full(spark, sf_dir)
    return billing.billing_validation(lg.rides, lg.books.rules)


# -- quality -------------------------------------------------------------------

def check_tables(lg: Ledger) -> dict[str, DataFrame]:
    ts = F.lit(RUN_TS)
    return {
        "stg_rides": lg.staged.withColumn("loaded_at", ts),
        "stg_rides_quarantine": lg.quarantine.withColumn("quarantined_at", ts),
        "stg_account_mapping": posting.posting_rules(lg.books.rules),
        "stg_chart_of_accounts": posting.chart_of_accounts(lg.books.accounts),
        "int_journal_entries": lg.journal.withColumn("loaded_at", ts),
        "fct_general_ledger": lg.ledger.withColumn("loaded_at", ts),
        "fct_trial_balance": lg.trial_balance,
        "rpt_income_statement_detail": lg.is_detail,
        "rpt_income_statement_summary": lg.is_summary,
        "rpt_balance_sheet_detail": lg.bs_detail,
        "rpt_balance_sheet_summary": lg.bs_summary,
    }


def _checked(spark, sf_dir) -> Ledger:
    # every layer is read by several check branches
    return Ledger(spark, sf_dir, FULL, materialize=True)


def _report(spark, sf_dir) -> DataFrame:
    lg = _checked(spark, sf_dir)
    return quality.check_report(check_tables(lg), lg.books.countries)


def dq_report(spark, sf_dir):
    return _report(spark, sf_dir)


def _checks_of(kind: str):
    def q(spark, sf_dir):
        lg = _checked(spark, sf_dir)
        tables = check_tables(lg)
        frames = []
        for model, df in tables.items():
            if kind == "not_null" and model in quality.NOT_NULL:
                frames.append(quality.not_null(df, model, quality.NOT_NULL[model]))
            if kind == "unique":
                frames += [quality.unique(df, model, c) for c in quality.UNIQUE.get(model, [])]
            lists = quality.accepted(lg.books.countries).get(model, [])
            if kind == "accepted_values" and lists:
                frames.append(quality.accepted_values_of(df, model, lists))
        return quality.union_all(frames)
    q.__name__ = f"dq_{kind}"
    return q


dq_not_null = _checks_of("not_null")
dq_unique = _checks_of("unique")
dq_accepted_values = _checks_of("accepted_values")


def dq_relationships(spark, sf_dir):
    lg = _full(spark, sf_dir)
    return quality.relationships(posting.posting_rules(lg.books.rules), "stg_account_mapping",
                                 "account_code", posting.chart_of_accounts(lg.books.accounts),
                                 "account_code")


def dq_journal_balance(spark, sf_dir):
    return quality.dq_journal_balance(_full(spark, sf_dir).journal)


def dq_gl_balance(spark, sf_dir):
    return quality.dq_gl_balance(_full(spark, sf_dir).ledger)


def dq_balance_sheet_equation(spark, sf_dir):
    return quality.dq_balance_sheet_equation(_full(spark, sf_dir).bs_summary)


# -- faults --------------------------------------------------------------------

def fault_sample(spark, sf_dir):
    return faults.fault_sample(_full(spark, sf_dir).rides, S.FAULT_RATES["null"],
                               f"{S.FAULT_SEED}-null")


def inject_null(spark, sf_dir):
    return faults.inject_null(_full(spark, sf_dir).rides)


def inject_outlier(spark, sf_dir):
    return faults.inject_outlier(_full(spark, sf_dir).rides)


def inject_duplicate(spark, sf_dir):
    return faults.inject_duplicate(_full(spark, sf_dir).rides)


def inject_country(spark, sf_dir):
    return faults.inject_country(_full(spark, sf_dir).rides)


IMPACT_CHAINS = {"clean": (), "prevented_faults": tuple(S.DEFAULT_FAULTS), "country_fault": ("country",)}


def fault_impact(spark, sf_dir):
    """Income statement and gate figures before and after fault injection.

    All scenarios go through one plan: the rides are written once with the heads of their hashes, meet once
    by order, and are staged and posted by (scenario, order); orders that no fault hits are staged once for all
    scenarios.
    """
    books = _full(spark, sf_dir).books
    found = faults.scenarios(books.rides, IMPACT_CHAINS)
    rides = found.rows()
    tags = (faults.SCENARIO,)
    staged = keep(quality.union_all([staging.stage_rides(part, FULL, tags=tags).select(*tags, *journal.RIDE_INPUTS)
                                     for part in found.by_order()]))
    gl = posting.general_ledger(journal.journal_entries(staged, tags), books.rules, books.accounts, tags=tags)
    cat, net = F.col("account_category"), F.col("net_balance")
    pnl = found.each(balances.trial_balance(gl, tags=tags)).groupBy(*tags).agg(
        LF.report_money(-F.sum(F.when(cat == "revenue", net).otherwise(0))).alias("total_revenue"),
        LF.sum_when(cat == "expense", net).alias("total_expenses"))
    source = rides.groupBy(*tags).agg(F.count(F.lit(1)).alias("source_rows"))
    accepted = F.col("country").isin(*books.countries)
    kept = (found.each(staged.groupBy(*tags, "country").agg(F.count(F.lit(1)).alias("n")))
            .groupBy(*tags, "country").agg(F.sum("n").alias("n"))
            .groupBy(*tags).agg(F.sum("n").alias("staged_rows"), F.count_if(~accepted).alias("country_check_failures")))
    names = spark.range(1).select(F.explode(F.array(*[F.lit(n) for n in IMPACT_CHAINS])).alias(faults.SCENARIO))
    out = names
    for part in (source, kept, pnl):  # one row a scenario each
        out = out.join(part, faults.SCENARIO, "left")
    return out.select(
        faults.SCENARIO, *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in ("source_rows", "staged_rows")],
        "total_revenue", "total_expenses",
        LF.report_money(F.col("total_revenue") - F.col("total_expenses")).alias("net_income"),
        F.coalesce("country_check_failures", F.lit(0)).cast("bigint").alias("country_check_failures"))


QUERIES: dict[str, Query] = {f.__name__: f for f in [
    scan_rides, posting_rules, chart_of_accounts, replace_period, replace_by_key,
    append_new_columns, trace_account_to_ledger, trace_order, period_bounds, backfill_months,
    guard_not_null, guard_outlier, stg_rides, coupon_normalised, journal_entries, journal_ids,
    general_ledger, general_ledger_month, unposted_lines, dedup_orders, quarantine, quarantine_ids,
    quarantine_summary, staging_reconciliation, trial_balance, trial_balance_month,
    trial_balance_check, income_statement_detail, income_statement_summary, balance_sheet_detail,
    balance_sheet_summary, statement_lines_ordered, preview_rides, direct_income_statement,
    direct_income_totals, stored_reruns, stored_key_replacement, stored_repeated_keys, stored_closing_balances,
    stage_month_by_state,
    pnl_reconciliation, mapping_completeness, range_lookup_city, price_rides, order_uuid,
    rides_per_day_check, rides_per_country, billing_validation, dq_report, dq_not_null, dq_unique,
    dq_accepted_values, dq_relationships, dq_journal_balance, dq_gl_balance,
    dq_balance_sheet_equation, fault_sample, inject_null, inject_outlier, inject_duplicate,
    inject_country, fault_impact,
]}


def queries() -> dict[str, Query]:
    return dict(QUERIES)
