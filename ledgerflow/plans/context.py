"""Shared building blocks of the registered queries: books and fixed periods."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators import balances, journal, posting, staging, statements
from ledgerflow.periods import Period
from ledgerflow.session import keep
from ledgerflow.sources import adapter

# Query parameters: the whole date range of the driver tables, and one month.
FULL = Period(date(1995, 1, 1), date(2001, 12, 31))
MONTH = Period(date(1998, 3, 1), date(1998, 3, 31))
# Rides of these days are stored four weeks early before the correction.
EARLY_DAYS = Period(date(1998, 3, 1), date(1998, 3, 10))
TRACE_ACCOUNT = "4100"
TRACE_COUNTRY = "EUROPE"
PREVIEW_ROWS = 5


@dataclass
class Ledger:
    """One ledger build over a period: every layer as a lazy DataFrame."""

    spark: SparkSession
    sf_dir: str
    period: Period = FULL
    dedup_scope: str = "source"
    # Write the layers that took a shuffle when many branches of one query read them (see session.keep):
    # staged rides and quarantine are made in one pass, of both only the columns that journal and checks read.
    # Journal and ledger are not: each branch derives the columns it needs from the staged rides, row by row.
    materialize: bool = False

    @cached_property
    def books(self) -> adapter.Books:
        return adapter.adapter_books(self.spark, self.sf_dir)

    @property
    def rides(self) -> DataFrame:
        return self.books.rides

    @cached_property
    def _marked(self) -> DataFrame:
        if self.dedup_scope != "source":
            raise ValueError("staged rides and quarantine share a pass in the default scope only")
        marked = staging.staged_and_rejected(self.rides, self.period)
        return keep(marked.select("rejection_reason", "quarantine_id", *journal.RIDE_INPUTS))

    @cached_property
    def staged(self) -> DataFrame:
        if self.materialize:
            return self._marked.where(F.col("rejection_reason").isNull()).select(*journal.RIDE_INPUTS)
        return staging.stage_rides(self.rides, self.period, dedup_scope=self.dedup_scope)

    @cached_property
    def quarantine(self) -> DataFrame:
        if self.materialize:
            return self._marked.where(F.col("rejection_reason").isNotNull()).select(
                "quarantine_id", "order_id", "rejection_reason")
        return staging.quarantine_rides(self.rides, self.period)

    @cached_property
    def journal(self) -> DataFrame:
        return journal.journal_entries(self.staged)

    @cached_property
    def ledger(self) -> DataFrame:
        return posting.general_ledger(self.journal, self.books.rules, self.books.accounts)

    @cached_property
    def trial_balance(self) -> DataFrame:
        tb = balances.trial_balance(self.ledger)
        return keep(tb) if self.materialize else tb

    @cached_property
    def is_detail(self) -> DataFrame:
        return statements.income_statement_detail(self.trial_balance, self.period)

    @cached_property
    def is_summary(self) -> DataFrame:
        return statements.income_statement_summary(self.is_detail)

    @cached_property
    def bs_detail(self) -> DataFrame:
        return statements.balance_sheet_detail(self.trial_balance, self.period)

    @cached_property
    def bs_summary(self) -> DataFrame:
        return statements.balance_sheet_summary(self.bs_detail)
