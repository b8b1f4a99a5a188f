"""Audit trail: from a report line to its ledger rows, and on to the source rides."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.periods import Period


def drill_to_ledger(ledger: DataFrame, account_code: str, period: Period,
                    country: str | None = None) -> DataFrame:
    """Ledger rows behind one account (and country) of a period's statement."""
    cond = (F.col("account_code") == account_code) & period.contains(F.col("ride_date"))
    if country is not None:
        cond = cond & (F.col("country") == country)
    return ledger.where(cond)


def drill_to_source(rides: DataFrame, orders: DataFrame) -> DataFrame:
    """Source rides (every copy, any period) of the given order ids.

    A semi join: the order list is deduplicated by the join itself and each
    source row appears at most once.
    """
    return rides.join(orders.select("order_id"), "order_id", "left_semi")


def ordered(df: DataFrame, *cols: str) -> DataFrame:
    """Presentation order; only for output, never for a stored table."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cols])
