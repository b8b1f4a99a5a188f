"""Reconciliations: staged + quarantined versus source, and ledger versus a
shortcut profit-and-loss computed straight from the billing rows.

Every operator here is one scan plus hash aggregates with map-side combine;
their outputs are per month or per country, so the final joins are between
tables of a few hundred rows.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow import functions as LF
from ledgerflow import schemas as S
from ledgerflow.operators import staging
from ledgerflow.operators.posting import bounded_broadcast
from ledgerflow.periods import Period

RECON_COUNTS = ["source_rows", "staged_rows", "null_rejects", "outlier_rejects",
                "duplicate_rejects"]


def staging_reconciliation(rides: DataFrame, period: Period,
                           threshold: Decimal = S.OUTLIER_THRESHOLD) -> DataFrame:
    """Per month of the period: source rows versus staged and quarantined rows.

    Staging deduplicates the whole source while the quarantine looks for
    duplicates inside the month only, so a later copy of an order in another
    month is in neither table; ``unaccounted_rows`` reports that gap.

    One classified scan gives all counts. Rejected rows collapse to a row a month and reason, clean
    ones to a row an order and month with their first start. An order is staged where its first
    start of all is, and keeps one row of a month where its first of the month is; both are minima
    over the order's few rows. Rows after the period decide nothing and are not read.
    """
    reason = F.col("rejection_reason")
    clean = reason.isNull()
    facts = (staging.classify(rides.where(staging.before_end(period)), threshold)
             .groupBy(F.trunc(F.to_date("start_time"), "month").alias("reporting_period"), "rejection_reason",
                      F.when(clean, F.col("order_id")).alias("order_id"),
                      staging.in_period_by_start(period).alias("inside"))
             .agg(F.count(F.lit(1)).alias("n"), F.min("start_time").alias("first")))
    of_order = Window.partitionBy("order_id", "rejection_reason")
    of_month = Window.partitionBy("order_id", "rejection_reason", "reporting_period")
    flagged = (facts.withColumn("wins_all", clean & (F.col("first") == F.min("first").over(of_order)))
               .withColumn("wins_month", clean & (F.col("first") == F.min("first").over(of_month)))
               .where("inside"))
    n, zero = F.col("n"), F.lit(0)
    counts = {"source_rows": n, "staged_rows": F.col("wins_all").cast("int"),
              "null_rejects": F.when(reason == S.NULL_REASON, n).otherwise(zero),
              "outlier_rejects": F.when(reason == S.OUTLIER_REASON, n).otherwise(zero),
              "duplicate_rejects": F.when(clean, n - F.col("wins_month").cast("int")).otherwise(zero)}
    out = flagged.groupBy("reporting_period").agg(*[F.sum(counts[c]).cast("bigint").alias(c) for c in RECON_COUNTS])
    gap = F.col("source_rows") - F.col("staged_rows") - F.col("null_rejects") \
        - F.col("outlier_rejects") - F.col("duplicate_rejects")
    return out.withColumn("unaccounted_rows", gap.cast("bigint"))


def quarantine_summary(quarantined: DataFrame) -> DataFrame:
    """Rejection volume per month and reason."""
    return (quarantined.groupBy(F.trunc("ride_date", "month").alias("reporting_period"),
                                "rejection_reason")
            .agg(F.count(F.lit(1)).alias("rejected_rows"),
                 F.count_distinct("order_id").alias("orders")))


def direct_income_statement(rides: DataFrame, rules: DataFrame, accounts: DataFrame) -> DataFrame:
    """Shortcut P&L straight from billing rows: no guardrails, no dedup, no ledger.

    Revenue is the net amount per country; expenses are coupon amounts of
    rows with a coupon. Accounts come from the posting rules of the revenue
    and coupon lines (left join: a country without a rule keeps a null code).
    """
    present = LF.is_present_coupon(F.col("coupon_used"))
    per_country = rides.groupBy("country").agg(
        LF.sum_money(F.col("amount")).alias("revenue"),
        LF.sum_money(F.when(present, F.col("coupon_amount"))).alias("expenses"),
        F.count_if(present).alias("coupon_rows"))
    lines = per_country.select(
        "country",
        F.inline(F.array(
            F.struct(F.lit(1).alias("sort_order"), F.lit("Revenue").alias("section"),
                     F.lit("revenue").alias("line_type"), F.col("revenue").alias("amount")),
            F.struct(F.lit(2).alias("sort_order"), F.lit("Expenses").alias("section"),
                     F.lit("coupon_expense").alias("line_type"), F.col("expenses").alias("amount")))),
        "coupon_rows")
    # A country without coupons has no expense line.
    lines = lines.where((F.col("section") == "Revenue") | (F.col("coupon_rows") > 0)).drop("coupon_rows")
    names = bounded_broadcast(accounts.select("account_code", "account_name"))
    acct = bounded_broadcast(rules.select("line_type", "country", "account_code")
                             .join(names, "account_code", "left"))
    return (lines.join(acct, ["line_type", "country"], "left")
            .select("sort_order", "section", "account_code", "account_name", "country", "amount"))


def direct_totals(direct: DataFrame) -> DataFrame:
    sec = F.col("section")
    rev = LF.sum_when(sec == "Revenue", F.col("amount"))
    exp = LF.sum_when(sec == "Expenses", F.col("amount"))
    return direct.agg(rev.alias("total_revenue"), exp.alias("total_expenses"),
                      LF.report_money(rev - exp).alias("net_income"))


def pnl_reconciliation(trial_balance: DataFrame, direct: DataFrame) -> DataFrame:
    """Ledger revenue and expenses per country against the shortcut's.

    Names and account codes differ between the two, so amounts are compared
    by country. Differences come from the guardrails (rejected and duplicate
    rows) and from countries the ledger cannot post.
    """
    cat = F.col("account_category")
    ledger = (trial_balance.where(cat.isin("revenue", "expense"))
              .groupBy("country")
              .agg(LF.report_money(-F.sum(F.when(cat == "revenue", F.col("net_balance"))
                                          .otherwise(0))).alias("ledger_revenue"),
                   LF.sum_when(cat == "expense", F.col("net_balance")).alias("ledger_expenses")))
    sec = F.col("section")
    short = (direct.groupBy("country")
             .agg(LF.sum_when(sec == "Revenue", F.col("amount")).alias("direct_revenue"),
                  LF.sum_when(sec == "Expenses", F.col("amount")).alias("direct_expenses")))
    zero = F.lit(Decimal("0.00")).cast(S.REPORT_MONEY)
    j = ledger.join(short, "country", "full")
    lr, le = F.coalesce("ledger_revenue", zero), F.coalesce("ledger_expenses", zero)
    dr, de = F.coalesce("direct_revenue", zero), F.coalesce("direct_expenses", zero)
    return j.select(
        "country", lr.alias("ledger_revenue"), dr.alias("direct_revenue"),
        LF.report_money(dr - lr).alias("revenue_difference"),
        le.alias("ledger_expenses"), de.alias("direct_expenses"),
        LF.report_money(de - le).alias("expense_difference"),
        LF.report_money((lr - le) - (dr - de)).alias("net_income_difference"))
