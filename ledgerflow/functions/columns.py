"""Scalar column helpers of the ledger.

All of them are plain Catalyst expressions, so they stay inside whole-stage
codegen; none needs a Python worker.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerflow import schemas as S


def money(c: Column) -> Column:
    """Cast to the staged money type ``decimal(12,2)``."""
    return c.cast(S.MONEY)


def report_money(c: Column) -> Column:
    """Cast a money aggregate to ``decimal(18,2)`` (one width for every engine)."""
    return c.cast(S.REPORT_MONEY)


def sum_money(c: Column) -> Column:
    return report_money(F.sum(c))


def sum_when(cond: Column, value: Column) -> Column:
    """Conditional sum ``sum(case when cond then value else 0 end)``."""
    return report_money(F.sum(F.when(cond, value).otherwise(F.lit(0))))


def is_present_coupon(code: Column) -> Column:
    """A coupon counts when its code is non-null and not one of the blank markers."""
    return code.isNotNull() & ~code.isin(*S.COUPON_BLANKS)


def coupon_code(code: Column) -> Column:
    return F.when(is_present_coupon(code), code)


def coupon_amount_or_zero(code: Column, amount: Column) -> Column:
    """Coupon amount when a coupon is present (null amount counts as 0), else 0."""
    return F.coalesce(F.when(is_present_coupon(code), money(amount)),
                      F.lit(Decimal("0.00")).cast(S.MONEY))


def entry_side(line_type: Column) -> Column:
    return F.when(line_type.isin(*S.DEBIT_LINE_TYPES), F.lit("debit")).otherwise(F.lit("credit"))


def signed_amount(side: Column, amount: Column) -> Column:
    """Debit positive, credit negative, anything else null."""
    return F.when(side == "debit", amount).when(side == "credit", -amount)


def journal_entry_id(order_id: Column, line_type: Column) -> Column:
    """md5 of ``order_id|line_type``; a null order id gives a null id."""
    return F.md5(F.concat(order_id.cast("string"), F.lit("|"), line_type.cast("string")))


def quarantine_id(order_id: Column, ride_id: Column, reason: Column, seq: Column) -> Column:
    """md5 of ``order-ride-reason-seq`` with ``_null_`` standing for null parts."""
    return F.md5(F.concat(
        F.coalesce(order_id.cast("string"), F.lit("_null_")), F.lit("-"),
        F.coalesce(ride_id.cast("string"), F.lit("_null_")), F.lit("-"),
        reason, F.lit("-"), seq.cast("string")))


def md5_uuid(payload: Column) -> Column:
    """md5 of a text shown as a UUID (8-4-4-4-12 hex groups)."""
    h = F.md5(payload)
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.substring(h, 13, 4),
                       F.substring(h, 17, 4), F.substring(h, 21, 12))


def ride_hash_id(*parts: Column) -> Column:
    """Deterministic non-negative 63-bit id from the ride's identifying parts.

    The reference uses a different 64-bit hash, so values differ; what is kept
    is determinism and the non-negative bigint range.
    """
    text = F.concat_ws("|", *[p.cast("string") for p in parts])
    return F.xxhash64(text).bitwiseAND(F.lit((1 << 63) - 1))
