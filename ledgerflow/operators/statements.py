"""Financial statements built on the trial balance (never on the ledger).

The trial balance holds one row per month, account and country, so every
operator here works on a few thousand rows whatever the ride volume.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow import functions as LF
from ledgerflow import schemas as S
from ledgerflow.periods import Period

IS_COLUMNS = ["period_start", "period_end", "sort_order", "section", "account_code",
              "account_name", "country", "amount"]
BS_COLUMNS = ["report_date", "sort_order", "section", "account_code", "account_name",
              "country", "balance"]


def _section(df: DataFrame, category: str, flip: bool, value_name: str) -> DataFrame:
    total = F.sum("net_balance")
    return (df.where(F.col("account_category") == category)
            .groupBy("account_code", "account_name", "country")
            .agg(LF.report_money(-total if flip else total).alias(value_name)))


def income_statement_detail(tb: DataFrame, period: Period) -> DataFrame:
    """Revenue (sign flipped) and expense lines per account and country."""
    months = tb.where(period.contains_month(F.col("reporting_period")))
    sections = [("Revenue", 1, "revenue", True), ("Expenses", 2, "expense", False)]
    parts = [
        _section(months, cat, flip, "amount")
        .select(F.lit(period.start).alias("period_start"), F.lit(period.end).alias("period_end"),
                F.lit(order).alias("sort_order"), F.lit(name).alias("section"),
                "account_code", "account_name", "country", "amount")
        for name, order, cat, flip in sections
    ]
    return parts[0].unionByName(parts[1])


def income_statement_summary(detail: DataFrame, period: Period | None = None) -> DataFrame:
    if period is not None:
        detail = detail.where(period.contains(F.col("period_end")))
    sec = F.col("section")
    rev = LF.sum_when(sec == "Revenue", F.col("amount"))
    exp = LF.sum_when(sec == "Expenses", F.col("amount"))
    return (detail.groupBy("period_start", "period_end")
            .agg(rev.alias("total_revenue"), exp.alias("total_expenses"),
                 LF.report_money(rev - exp).alias("net_income")))


def balance_sheet_detail(tb: DataFrame, period: Period) -> DataFrame:
    """Cumulative balances as of the period end (every month up to its month).

    Assets as is, liabilities sign-flipped, and one retained-earnings row
    (revenue and expenses, sign-flipped) that exists even when there is no
    P&L activity, then with a null balance.
    """
    upto = tb.where(period.up_to_end_month(F.col("reporting_period")))
    report_date = F.lit(period.end).alias("report_date")
    assets = _section(upto, "asset", False, "balance")
    liabilities = _section(upto, "liability", True, "balance")
    retained = (upto.where(F.col("account_category").isin("revenue", "expense"))
                .agg(LF.report_money(F.sum(-F.col("net_balance"))).alias("balance"))
                .select(F.lit(S.RETAINED_EARNINGS_CODE).alias("account_code"),
                        F.lit(S.RETAINED_EARNINGS_NAME).alias("account_name"),
                        F.lit(S.RETAINED_EARNINGS_COUNTRY).alias("country"), "balance"))
    parts = [(assets, 1, "Assets"), (liabilities, 2, "Liabilities"), (retained, 3, "Equity")]
    out = None
    for df, order, name in parts:
        part = df.select(report_date, F.lit(order).alias("sort_order"), F.lit(name).alias("section"),
                         "account_code", "account_name", "country", "balance")
        out = part if out is None else out.unionByName(part)
    return out


def balance_sheet_summary(detail: DataFrame, period: Period | None = None) -> DataFrame:
    if period is not None:
        detail = detail.where(period.contains(F.col("report_date")))
    sec = F.col("section")
    a = LF.sum_when(sec == "Assets", F.col("balance"))
    liab = LF.sum_when(sec == "Liabilities", F.col("balance"))
    e = LF.sum_when(sec == "Equity", F.col("balance"))
    return (detail.groupBy("report_date")
            .agg(a.alias("total_assets"), liab.alias("total_liabilities"), e.alias("total_equity"),
                 LF.report_money(liab + e).alias("liabilities_plus_equity"),
                 (F.abs(a - (liab + e)) < F.lit(S.BALANCE_TOLERANCE)).alias("equation_balanced")))


def statement_lines(is_detail: DataFrame, bs_detail: DataFrame) -> DataFrame:
    """Both statements as one presentation list, ordered as printed."""
    inc = is_detail.select(F.lit("income_statement").alias("statement"),
                           F.col("period_end").alias("as_of"), "sort_order", "section",
                           "account_code", "account_name", "country", "amount")
    bal = bs_detail.select(F.lit("balance_sheet").alias("statement"),
                           F.col("report_date").alias("as_of"), "sort_order", "section",
                           "account_code", "account_name", "country",
                           F.col("balance").alias("amount"))
    return (inc.unionByName(bal)
            .orderBy(F.col("statement").desc(), "as_of", "sort_order", "account_code", "country"))
