"""Journal explosion: every staged ride becomes up to four double-entry lines.

    DR receivable      = gross - coupon
    DR coupon_expense  = coupon
    CR revenue         = net amount
    CR vat_payable     = VAT

The four-line spine is a literal array exploded per row (``inline``), a
narrow operation with no exchange; lines whose amount is not positive are
never posted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow import functions as LF
from ledgerflow import schemas as S

JOURNAL_COLUMNS = ["journal_entry_id", "order_id", "ride_id", "scooter_id", "ride_date",
                   "start_time", "city", "country", "currency", "line_type", "line_number",
                   "entry_side", "line_amount", "coupon_code"]

# The columns of staged rides that the journal is made of.
RIDE_INPUTS = ["order_id", "ride_id", "scooter_id", "ride_date", "start_time", "city", "country", "currency",
               "coupon_code", "coupon_amount", "amount", "vat_amount", "sum_with_vat_amount"]


def _line_amounts() -> dict:
    return {
        "receivable": F.col("sum_with_vat_amount") - F.col("coupon_amount"),
        "coupon_expense": F.col("coupon_amount"),
        "revenue": F.col("amount"),
        "vat_payable": F.col("vat_amount"),
    }


def journal_lines(staged: DataFrame, tags: tuple[str, ...] = ()) -> DataFrame:
    amounts = _line_amounts()
    spine = F.array(*[
        F.struct(F.lit(t).alias("line_type"),
                 F.lit(i + 1).alias("line_number"),
                 LF.entry_side(F.lit(t)).alias("entry_side"),
                 amounts[t].cast(S.LINE_MONEY).alias("line_amount"))
        for i, t in enumerate(S.LINE_TYPES)
    ])
    lines = staged.select(*tags, "order_id", "ride_id", "scooter_id", "ride_date", "start_time", "city",
                          "country", "currency", "coupon_code", F.inline(spine))
    return (lines.where(F.col("line_amount") > 0)
            .withColumn("journal_entry_id", LF.journal_entry_id(F.col("order_id"), F.col("line_type")))
            .select(*tags, *JOURNAL_COLUMNS))


def journal_entries(staged: DataFrame, tags: tuple[str, ...] = ()) -> DataFrame:
    return journal_lines(staged, tags)
