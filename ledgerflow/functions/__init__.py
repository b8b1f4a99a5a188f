"""Column expressions built only from built-in Spark functions (JVM side)."""

from ledgerflow.functions.columns import (  # noqa: F401
    coupon_amount_or_zero,
    coupon_code,
    entry_side,
    money,
    is_present_coupon,
    journal_entry_id,
    md5_uuid,
    quarantine_id,
    report_money,
    ride_hash_id,
    signed_amount,
    sum_money,
    sum_when,
)
