"""Trial balance: the ledger aggregated per month, account and country.

A hash aggregate with partial (map-side) aggregation: each map task reduces
its lines to at most one row per group before the shuffle, so the exchange
carries (#months x #accounts x #countries) rows per task whatever the data
volume or skew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow import functions as LF
from ledgerflow import schemas as S
from ledgerflow.periods import Period

TB_KEYS = ["reporting_period", "account_code", "account_name", "account_category",
           "normal_side", "country"]


def trial_balance(ledger: DataFrame, period: Period | None = None, tags: tuple[str, ...] = ()) -> DataFrame:
    """Per (month, account, country): debits, credits, net and line count.

    With a period, only its months (bounds truncated to the month) are
    aggregated, as the incremental run does.
    """
    if period is not None:
        ledger = ledger.where(period.contains_month(F.col("reporting_period")))
    side = F.col("entry_side")
    return (ledger.groupBy(*tags, *TB_KEYS)
            .agg(LF.sum_when(side == "debit", F.col("line_amount")).alias("total_debit"),
                 LF.sum_when(side == "credit", F.col("line_amount")).alias("total_credit"),
                 LF.sum_money(F.col("signed_amount")).alias("net_balance"),
                 F.count(F.lit(1)).alias("entry_count")))


def trial_balance_check(tb: DataFrame) -> DataFrame:
    """Monthly debit = credit check over the trial balance."""
    agg = (tb.groupBy("reporting_period")
           .agg(LF.sum_money(F.col("total_debit")).alias("total_debit"),
                LF.sum_money(F.col("total_credit")).alias("total_credit")))
    return agg.withColumn(
        "balanced", F.abs(F.col("total_debit") - F.col("total_credit")) < F.lit(S.BALANCE_TOLERANCE))
