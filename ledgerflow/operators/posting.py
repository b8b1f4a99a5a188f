"""Posting: journal lines resolved to accounts through rules and the chart.

Both reference tables are dimension-sized. They are broadcast only behind a
row-count check (``bounded_broadcast``); beyond the bound the joins are left
to the planner (sort-merge or, with AQE, a runtime broadcast when small).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow import functions as LF

# Largest reference table that is broadcast by hint.
MAX_BROADCAST_ROWS = 100_000

LEDGER_COLUMNS = ["journal_entry_id", "order_id", "ride_id", "scooter_id", "ride_date",
                  "reporting_period", "start_time", "city", "country", "currency", "line_type",
                  "line_number", "entry_side", "line_amount", "coupon_code", "account_code",
                  "account_name", "account_category", "normal_side", "signed_amount"]


def bounded_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast hint only for a side proven to hold at most ``max_rows`` rows.

    The check reads at most ``max_rows + 1`` rows, so it stays cheap even when
    the table turns out large; then no hint is given and the planner chooses.
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


def posting_rules(rules: DataFrame) -> DataFrame:
    return rules.select("line_type", "country", "account_code")


def chart_of_accounts(accounts: DataFrame) -> DataFrame:
    return accounts.select("account_code", "account_name", "account_category", "normal_side")


def general_ledger(journal: DataFrame, rules: DataFrame, accounts: DataFrame,
                   broadcast_check: bool = True, tags: tuple[str, ...] = ()) -> DataFrame:
    """Journal lines with account attributes, reporting month and signed amount.

    Inner joins: a line with no rule or no account is not posted (see
    ``unposted_lines`` for the visible counterpart).
    """
    r = posting_rules(rules)
    a = chart_of_accounts(accounts)
    if broadcast_check:
        r, a = bounded_broadcast(r), bounded_broadcast(a)
    gl = (journal.join(r, ["line_type", "country"], "inner")
          .join(a, "account_code", "inner")
          .withColumn("reporting_period", F.trunc("ride_date", "month"))
          .withColumn("signed_amount", LF.signed_amount(F.col("entry_side"), F.col("line_amount"))))
    return gl.select(*tags, *LEDGER_COLUMNS)


def unposted_lines(journal: DataFrame, rules: DataFrame, accounts: DataFrame) -> DataFrame:
    """Journal lines the ledger's inner joins drop, with the reason."""
    r = bounded_broadcast(posting_rules(rules))
    a = bounded_broadcast(chart_of_accounts(accounts).select("account_code"))
    no_rule = journal.join(r, ["line_type", "country"], "left_anti") \
        .withColumn("unposted_reason", F.lit("no_posting_rule"))
    no_account = (journal.join(r, ["line_type", "country"], "inner")
                  .join(a, "account_code", "left_anti")
                  .drop("account_code")
                  .withColumn("unposted_reason", F.lit("no_account")))
    return no_rule.unionByName(no_account)
