"""Hand-sized billing rows, one per semantic rule (see FIXTURES.md §2)."""

from __future__ import annotations

from datetime import datetime, timedelta
from decimal import Decimal as D

from ledgerflow import schemas as S
from ledgerflow.sources.adapter import Books
from ledgerflow.sources.files import reference_account_mapping, reference_chart_of_accounts

BASE = dict(amount=D("5.18"), vat=D("1.24"), gross=D("6.42"), country="Estonia",
            coupon=None, coupon_amount=None, vat_rate=0.24)

# (ride_id, order_id, start, overrides)
CASES = [
    (1, "o1", "2026-01-05 10:00:00", {}),
    (2, "o2", "2026-01-05 11:00:00", dict(coupon="COUP-AB12CD", coupon_amount=D("3.00"))),
    (3, "o3", "2026-01-06 10:00:00", dict(amount=None, vat=None, gross=None)),
    (3, "o3", "2026-01-06 10:00:00", dict(amount=None, vat=None, gross=None)),
    (4, "o4", "2026-01-07 10:00:00", dict(amount=D("518.00"), vat=D("124.32"), gross=D("642.32"))),
    (5, "o5", "2026-01-08 10:00:00", dict(amount=D("50.00"), vat=D("10.50"), gross=D("60.50"),
                                          country="Latvia", vat_rate=0.21)),
    (6, "o1", "2026-01-05 10:30:00", {}),
    (7, "o6", "2026-01-09 10:00:00", dict(coupon="None", coupon_amount=D("3.00"))),
    (8, "o7", "2026-01-09 11:00:00", dict(coupon="", coupon_amount=D("3.00"))),
    (9, "o8", "2026-01-09 12:00:00", dict(coupon="COUP-ZZ99ZZ", coupon_amount=None)),
    (10, "o9", "2026-01-10 10:00:00", dict(amount=D("2.00"), vat=D("0.00"), gross=D("2.00"),
                                           country="Finland", vat_rate=0.255)),
    (11, "o10", "2026-01-11 10:00:00", dict(coupon="COUP-BIG001", coupon_amount=D("9.00"))),
    (12, "o11", "2026-01-11 11:00:00", dict(coupon="COUP-EQ0001", coupon_amount=D("6.42"))),
    (13, "o12", "2026-01-12 10:00:00", dict(country="Tartu")),
    (14, "o13", "2026-01-31 23:59:59", {}),
    (15, "o14", "2026-02-01 00:00:00", {}),
    (16, "o15", "2026-01-30 10:00:00", {}),
    (17, "o15", "2026-02-02 10:00:00", {}),
    (18, "o16", None, {}),
    (19, None, "2026-01-13 10:00:00", {}),
    (20, None, "2026-01-13 11:00:00", {}),
    (21, "o17", "2026-01-14 10:00:00", dict(amount=D("-2.00"), vat=D("-0.48"), gross=D("-2.48"))),
]

CITY = {"Estonia": "Tallinn", "Finland": "Helsinki", "Latvia": "Riga", "Tartu": "Tartu"}


def ride_rows():
    rows = []
    for ride_id, order_id, start, over in CASES:
        v = {**BASE, **over}
        st = datetime.fromisoformat(start) if start else None
        rows.append((order_id, ride_id, 1 + ride_id % 3, st,
                     (st + timedelta(minutes=19)) if st else datetime(2026, 1, 1),
                     19, 4.2, v["amount"], v["vat_rate"], v["vat"], v["gross"], "EUR",
                     v["coupon"], v["coupon_amount"], CITY[v["country"]], v["country"]))
    return rows


def rides(spark):
    return spark.createDataFrame(ride_rows(), S.RIDES)


def books(spark, rides_df=None):
    return Books(rides_df if rides_df is not None else rides(spark),
                 reference_account_mapping(spark), reference_chart_of_accounts(spark),
                 tuple(S.REFERENCE_COUNTRIES))
