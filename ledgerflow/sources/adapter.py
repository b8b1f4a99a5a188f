"""Billing rows and reference tables derived from the driver's star-schema tables.

The driver's test data holds no rides, so one ride is derived per lineitem:
``lineitem ⋈ supplier ⋈ nation ⋈ region`` (all inner). Countries are region
names, cities are nation names. Derivations are chosen so the data exercise
every rule of the ledger: duplicate order ids across months, null amounts,
outliers above 50.00, coupons, blank coupon markers, zero VAT lines, and one
region (MIDDLE EAST) that has no posting rule.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow import schemas as S
from ledgerflow.sources.orderstate import RideFiles

# Adapter parameters (not reference values): chart, posted regions and the VAT
# rate table used when re-pricing rides by country.
ADAPTER_CHART_OF_ACCOUNTS = [
    ("1200", "Accounts Receivable", "asset", "debit"),
    ("2100", "VAT Payable", "liability", "credit"),
    ("3000", "Retained Earnings", "equity", "credit"),
    ("4100", "Ride Revenue", "revenue", "credit"),
    ("6200", "Marketing Expense - Coupons", "expense", "debit"),
]
ADAPTER_ACCOUNT_BY_LINE = [
    ("receivable", "1200"),
    ("coupon_expense", "6200"),
    ("revenue", "4100"),
    ("vat_payable", "2100"),
]
POSTED_REGIONS = ["AFRICA", "AMERICA", "ASIA", "EUROPE"]
ADAPTER_VAT_RATES = [
    ("AFRICA", "0.16"),
    ("AMERICA", "0.07"),
    ("ASIA", "0.10"),
    ("EUROPE", "0.21"),
    ("MIDDLE EAST", "0.05"),
]
# Vehicle id ranges for the range lookup on the adapter fleet (lo, hi, city, country):
# the reference's three ranges of 30 vehicles; ids above 90 have no zone.
ADAPTER_CITY_RANGES = S.REFERENCE_CITY_RANGES


@dataclass(frozen=True)
class Books:
    """Inputs of one ledger: billing rows, posting rules, chart, allowed countries."""

    rides: DataFrame
    rules: DataFrame
    accounts: DataFrame
    countries: tuple[str, ...]
    # The files behind ``rides``, where it reads files: lets stored runs keep a first-seen state.
    source: RideFiles | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def rides_from_tables(lineitem: DataFrame, supplier: DataFrame, nation: DataFrame,
                      region: DataFrame) -> DataFrame:
    l = lineitem.select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                        "l_extendedprice", "l_discount", "l_tax", "l_shipdate")
    s = supplier.select("s_suppkey", "s_nationkey")
    n = nation.select("n_nationkey", "n_name", "n_regionkey")
    r = region.select("r_regionkey", "r_name")
    # supplier, nation and region are dimension tables: Catalyst broadcasts them
    # when their measured size is under the broadcast threshold and otherwise
    # falls back to a shuffle join, so no unchecked hint is given here.
    j = (l.join(s, l.l_suppkey == s.s_suppkey)
         .join(n, F.col("s_nationkey") == F.col("n_nationkey"))
         .join(r, F.col("n_regionkey") == F.col("r_regionkey")))

    duration = F.col("l_quantity").cast("int")
    # Whole cents as decimal(12,0): the product with 0.01 stays within 18 digits,
    # so Spark keeps it in a long (no BigDecimal objects per row).
    cents = F.floor(F.col("l_extendedprice") / 20).cast("bigint").cast("decimal(12,0)")
    amount = F.when(F.col("l_partkey") % 97 == 0, F.lit(None)) \
        .otherwise(cents * F.lit(Decimal("0.01"))).cast(S.SOURCE_MONEY)
    vat_rate = F.col("l_tax").cast(S.RATE)
    vat_amount = (amount * vat_rate).cast(S.SOURCE_MONEY)
    gross = (amount + vat_amount).cast(S.SOURCE_MONEY)
    scooter = F.col("l_suppkey").cast("int")
    coupon_hit = (F.col("l_discount") >= 0.095) & (amount > F.lit(Decimal("5")))
    coupon_used = (F.when(coupon_hit, F.concat(F.lit("COUP-"), scooter.cast("string")))
                   .when(F.col("l_discount") < 0.005, F.lit("None"))
                   .when(F.col("l_discount") < 0.015, F.lit("")))
    coupon_amount = F.when(coupon_hit, F.lit(Decimal("3.00"))).cast(S.SOURCE_MONEY)
    start = F.col("l_shipdate").cast("timestamp_ntz")

    return j.select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                 F.col("l_linenumber").cast("string")).alias("order_id"),
        (F.col("l_partkey") * 100000 + F.col("l_suppkey")).cast("bigint").alias("ride_id"),
        scooter.alias("scooter_id"),
        start.alias("start_time"),
        (start + F.make_dt_interval(mins=duration)).alias("end_time"),
        duration.alias("duration_min"),
        F.round(F.col("l_quantity") * 0.23, 3).alias("distance_km"),
        amount.alias("amount"),
        vat_rate.alias("vat_rate"),
        vat_amount.alias("vat_amount"),
        gross.alias("sum_with_vat_amount"),
        F.lit("EUR").alias("currency"),
        coupon_used.alias("coupon_used"),
        coupon_amount.alias("coupon_amount"),
        F.col("n_name").alias("city"),
        F.col("r_name").alias("country"),
    )


def spread_splits(df: DataFrame) -> DataFrame:
    """Round-robin a scan that arrives in fewer splits than there are cores.

    A file with a single row group is read by one task, which would then run
    every narrow step before the first shuffle alone. A source that already
    has enough splits (any large input) is returned untouched: no shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def adapter_rides(spark: SparkSession, sf_dir: str, lineitem: DataFrame | None = None) -> DataFrame:
    lineitem = spread_splits(table(spark, sf_dir, "lineitem") if lineitem is None else lineitem)
    return rides_from_tables(lineitem, table(spark, sf_dir, "supplier"),
                             table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"))


def adapter_files(spark: SparkSession, sf_dir: str) -> RideFiles:
    return RideFiles(table(spark, sf_dir, "lineitem"),
                     lambda paths: adapter_rides(spark, sf_dir, spark.read.parquet(*paths)))


def adapter_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posting rules: every line type for each posted region of the region table."""
    regions = (table(spark, sf_dir, "region")
               .where(F.col("r_name").isin(*POSTED_REGIONS))
               .select(F.col("r_name").alias("country")))
    # The line-type spine is a literal array exploded per region row: a narrow
    # operation, no join.
    spine = F.inline(F.array(*[F.struct(F.lit(t).alias("line_type"), F.lit(a).alias("account_code"))
                               for t, a in ADAPTER_ACCOUNT_BY_LINE]))
    return regions.select("country", spine).select("line_type", "country", "account_code")


def adapter_accounts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ADAPTER_CHART_OF_ACCOUNTS, S.CHART_OF_ACCOUNTS)


def adapter_books(spark: SparkSession, sf_dir: str) -> Books:
    return Books(adapter_rides(spark, sf_dir), adapter_rules(spark, sf_dir),
                 adapter_accounts(spark), tuple(POSTED_REGIONS), adapter_files(spark, sf_dir))


def adapter_vat_rates(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(c, Decimal(r)) for c, r in ADAPTER_VAT_RATES],
                                 "country string, vat_rate decimal(5,4)")


def city_ranges(spark: SparkSession, ranges=ADAPTER_CITY_RANGES) -> DataFrame:
    return spark.createDataFrame(list(ranges), "lo int, hi int, zone_city string, zone_country string")
