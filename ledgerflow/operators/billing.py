"""Billing-side operators: re-pricing, id derivations, zone lookup and the
checks a billing extract is validated with before it enters the ledger.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow import functions as LF
from ledgerflow import schemas as S
from ledgerflow.operators.posting import bounded_broadcast


def price_rides(rides: DataFrame, vat_rates: DataFrame) -> DataFrame:
    """Price every ride from its duration with the tariff, VAT by country.

    net = 1.00 + minutes x 0.22; VAT = net x rate rounded half-up to cents;
    gross = net + VAT; a coupon may only be granted when net > 5.00. Decimal
    arithmetic throughout (the reference's binary floats differ by a cent in
    one tariff case). A country without a rate gets null VAT.
    """
    rates = bounded_broadcast(vat_rates.select("country", F.col("vat_rate").alias("tariff_vat_rate")))
    net = LF.money(F.lit(S.UNLOCK_FEE) + F.col("duration_min") * F.lit(S.PER_MINUTE_RATE))
    priced = rides.select("order_id", "ride_id", "country", "duration_min").join(rates, "country", "left")
    vat = LF.money(F.round(net * F.col("tariff_vat_rate"), 2))
    return priced.select(
        "order_id", "ride_id", "country", "duration_min",
        net.alias("list_amount"),
        F.col("tariff_vat_rate").cast(S.RATE).alias("list_vat_rate"),
        vat.alias("list_vat_amount"),
        LF.money(net + vat).alias("list_sum_with_vat_amount"),
        (net > F.lit(S.COUPON_MIN_ORDER_AMOUNT)).alias("coupon_eligible"))


def order_uuid(rides: DataFrame) -> DataFrame:
    """Order id as the billing system derives it: md5 of ``order|vehicle|start`` as a UUID."""
    payload = F.concat(F.lit("order|"), F.col("scooter_id").cast("string"), F.lit("|"),
                       F.date_format("start_time", "yyyy-MM-dd'T'HH:mm:ss"))
    return rides.select("order_id", "ride_id", "scooter_id", "start_time",
                        LF.md5_uuid(payload).alias("order_uuid"))


def range_lookup(df: DataFrame, id_col: str, zones: DataFrame) -> DataFrame:
    """Left join of ids onto ``[lo, hi]`` zones (non-overlapping ranges; others never match).

    Zones are grouped by the number of bits of their width. A zone of k bits
    spans at most two buckets of 2^k ids, so every group is an equi-join on the
    id's bucket with the range as a residual, whatever the widths: no nested
    loop and at most two rows a zone. There are at most 64 groups (few in
    practice), found by a distinct over the zone table.
    """
    idc = F.col(id_col).cast("bigint")
    carried = [c for c in zones.columns if c not in ("lo", "hi")]
    sized = zones.where(F.col("hi") >= F.col("lo")).withColumn(
        "_bits", F.length(F.bin(F.col("hi").cast("bigint") - F.col("lo").cast("bigint"))))
    groups = sorted(r[0] for r in sized.select("_bits").distinct().collect())
    out = df
    for k in groups:
        lo, hi = F.col("lo").cast("bigint"), F.col("hi").cast("bigint")
        ends = F.array_distinct(F.array(F.shiftright(lo, k), F.shiftright(hi, k)))
        z = sized.where(F.col("_bits") == k).select(
            F.explode(ends).alias(f"_bucket{k}"), lo.alias(f"_lo{k}"), hi.alias(f"_hi{k}"),
            *[F.col(c).alias(f"_{c}{k}") for c in carried])
        out = out.join(z, (F.shiftright(idc, k) == F.col(f"_bucket{k}"))
                       & (idc >= F.col(f"_lo{k}")) & (idc <= F.col(f"_hi{k}")), "left")
    found = [F.coalesce(*[F.col(f"_{c}{k}") for k in groups], F.lit(None).cast(zones.schema[c].dataType)).alias(c)
             for c in carried]
    return out.select(*[F.col(c) for c in df.columns], *found)


def city_of_vehicle(rides: DataFrame, zones: DataFrame) -> DataFrame:
    """Zone city and country of each ride's vehicle; ``zone_matched`` false is an error row."""
    looked = range_lookup(rides.select("order_id", "ride_id", "scooter_id"), "scooter_id", zones)
    return looked.withColumn("zone_matched", F.col("zone_city").isNotNull())


def rides_per_day_check(rides: DataFrame, lo: int = S.RIDES_PER_DAY_MIN,
                        hi: int = S.RIDES_PER_DAY_MAX) -> DataFrame:
    per_day = rides.groupBy("scooter_id", F.to_date("start_time").alias("ride_date")) \
        .agg(F.count(F.lit(1)).alias("n"))
    return per_day.agg(F.min("n").alias("rides_per_day_min"), F.max("n").alias("rides_per_day_max"),
                       F.bool_and(F.col("n").between(lo, hi)).alias("rides_per_day_in_range"),
                       F.count(F.lit(1)).alias("vehicle_days"))


def rides_per_country(rides: DataFrame) -> DataFrame:
    return rides.groupBy("country").agg(F.count(F.lit(1)).alias("rides"))


def billing_validation(rides: DataFrame, rules: DataFrame) -> DataFrame:
    """Checks of a billing extract in one row (decimal arithmetic, tolerances 0.02, and 0.01 for
    double entry)."""
    tol = F.lit(0.02).cast("decimal(3,2)")
    vat_diff = F.abs(F.col("vat_amount") - F.round(F.col("amount") * F.col("vat_rate"), 2))
    sum_diff = F.abs(F.col("sum_with_vat_amount") - (F.col("amount") + F.col("vat_amount")))
    coupon = LF.is_present_coupon(F.col("coupon_used"))
    coupon_zero = F.coalesce(F.col("coupon_amount"), F.lit(0))
    debit = F.col("sum_with_vat_amount") - coupon_zero + coupon_zero
    credit = F.col("amount") + F.col("vat_amount")
    stats = rides.agg(
        F.count(F.lit(1)).alias("rides_row_count"),
        LF.report_money(F.max(vat_diff)).alias("vat_calculation_max_diff"),
        LF.report_money(F.max(sum_diff)).alias("sum_with_vat_max_diff"),
        F.count_if(coupon).alias("coupon_count"),
        LF.report_money(F.min(F.when(coupon, F.col("amount")))).alias("coupon_min_order_amount"),
        F.coalesce(F.bool_and(F.when(coupon, F.col("amount") > F.lit(S.COUPON_MIN_ORDER_AMOUNT))),
                   F.lit(True)).alias("coupon_all_above_threshold"),
        F.coalesce(F.bool_and(F.when(coupon, F.col("coupon_amount") == F.lit(S.COUPON_DISCOUNT))),
                   F.lit(True)).alias("coupon_amount_all_3"),
        LF.report_money(F.abs(F.sum(debit) - F.sum(credit))).alias("double_entry_balance_diff"))
    # Both keys in one aggregate by (name, value) with map-side combine; a null counts as a value.
    keys = rides.select(F.inline(F.array(*[F.struct(F.lit(c).alias("key"), F.col(c).cast("string").alias("value"))
                                           for c in ("ride_id", "order_id")])))
    most = keys.groupBy("key", "value").agg(F.count(F.lit(1)).alias("n")).agg(
        *[F.max(F.when(F.col("key") == c, F.col("n"))).alias(c) for c in ("ride_id", "order_id")])
    mapping_rows = rules.agg(F.count(F.lit(1))).scalar()
    return (stats.withColumn("ride_id_unique", most.select(F.col("ride_id") == 1).scalar())
            .withColumn("order_id_unique", most.select(F.col("order_id") == 1).scalar())
            .withColumn("mapping_row_count", mapping_rows)
            .withColumn("vat_calculation_ok", F.col("vat_calculation_max_diff") < tol)
            .withColumn("sum_with_vat_ok", F.col("sum_with_vat_max_diff") < tol)
            .withColumn("double_entry_balanced", F.col("double_entry_balance_diff") < F.lit(0.01).cast("decimal(3,2)")))
