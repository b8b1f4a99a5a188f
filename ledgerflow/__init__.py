"""ledgerflow: a double-entry ledger pipeline built from Spark DataFrame operators.

Billing rows are cleaned and deduplicated (rejected rows quarantined with a
reason), exploded into balanced journal lines, posted through account rules
and a chart of accounts, aggregated to a monthly trial balance and reported as
income statement and balance sheet. Periods can be reprocessed in place, every
figure can be traced back to its source row, and each layer is gated by data
quality checks.
"""

from ledgerflow.periods import Period  # noqa: F401

__all__ = ["Period"]
