"""Column types, input schemas and the fixed values of the ledger.

Every value under a "Fixed values" comment must stay equal to the reference
workload's, otherwise results differ.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

# Money and rate types.
SOURCE_MONEY = T.DecimalType(10, 2)   # money as it arrives in the billing rows
MONEY = T.DecimalType(12, 2)          # staged money
RATE = T.DecimalType(5, 4)            # staged VAT rate
LINE_MONEY = T.DecimalType(13, 2)     # journal line amount (gross - coupon widens by one digit)
REPORT_MONEY = T.DecimalType(18, 2)   # every money aggregate is cast to this width

# Billing rows, one per completed ride.
RIDES = T.StructType([
    T.StructField("order_id", T.StringType()),
    T.StructField("ride_id", T.LongType()),
    T.StructField("scooter_id", T.IntegerType()),
    T.StructField("start_time", T.TimestampNTZType()),
    T.StructField("end_time", T.TimestampNTZType()),
    T.StructField("duration_min", T.IntegerType()),
    T.StructField("distance_km", T.DoubleType()),
    T.StructField("amount", SOURCE_MONEY),
    T.StructField("vat_rate", T.DoubleType()),
    T.StructField("vat_amount", SOURCE_MONEY),
    T.StructField("sum_with_vat_amount", SOURCE_MONEY),
    T.StructField("currency", T.StringType()),
    T.StructField("coupon_used", T.StringType()),
    T.StructField("coupon_amount", SOURCE_MONEY),
    T.StructField("city", T.StringType()),
    T.StructField("country", T.StringType()),
])
RIDE_COLUMNS = [f.name for f in RIDES.fields]
MONEY_COLUMNS = ["amount", "vat_amount", "sum_with_vat_amount"]

ACCOUNT_MAPPING = T.StructType([
    T.StructField("line_type", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("account_code", T.StringType()),
])

CHART_OF_ACCOUNTS = T.StructType([
    T.StructField("account_code", T.StringType()),
    T.StructField("account_name", T.StringType()),
    T.StructField("account_category", T.StringType()),
    T.StructField("normal_side", T.StringType()),
])

# Journal line types in line-number order, and their sides.
LINE_TYPES = ["receivable", "coupon_expense", "revenue", "vat_payable"]
DEBIT_LINE_TYPES = ["receivable", "coupon_expense"]

# Rejection reasons in guardrail order (first failing one wins).
NULL_REASON = "null_financial_amount"
OUTLIER_REASON = "outlier_amount"
DUPLICATE_REASON = "duplicate_order"
REJECTION_REASONS = [NULL_REASON, OUTLIER_REASON, DUPLICATE_REASON]

# Thresholds.
OUTLIER_THRESHOLD = Decimal("50.00")     # amount above this is an outlier; 50.00 passes
BALANCE_TOLERANCE = Decimal("0.001")     # strict < for flags, strict > for failures
COUPON_MIN_ORDER_AMOUNT = Decimal("5.00")
COUPON_DISCOUNT = Decimal("3.00")
COUPON_BLANKS = ["", "None"]             # coupon codes that mean "no coupon"

# Accepted values of the column checks.
ACCOUNT_CATEGORIES = ["asset", "liability", "equity", "revenue", "expense"]
SIDES = ["debit", "credit"]
INCOME_SECTIONS = ["Revenue", "Expenses"]
BALANCE_SECTIONS = ["Assets", "Liabilities", "Equity"]

# The retained-earnings line of the balance sheet.
RETAINED_EARNINGS_CODE = "3000"
RETAINED_EARNINGS_NAME = "Retained Earnings"
RETAINED_EARNINGS_COUNTRY = "ALL"

# The reference's own posting rules and chart of accounts.
REFERENCE_COUNTRIES = ["Estonia", "Finland", "Latvia"]
REFERENCE_ACCOUNT_MAPPING = [
    ("receivable", "Estonia", "1200"),
    ("revenue", "Estonia", "4101"),
    ("vat_payable", "Estonia", "2101"),
    ("coupon_expense", "Estonia", "6200"),
    ("receivable", "Finland", "1200"),
    ("revenue", "Finland", "4102"),
    ("vat_payable", "Finland", "2102"),
    ("coupon_expense", "Finland", "6200"),
    ("receivable", "Latvia", "1200"),
    ("revenue", "Latvia", "4103"),
    ("vat_payable", "Latvia", "2103"),
    ("coupon_expense", "Latvia", "6200"),
]
REFERENCE_CHART_OF_ACCOUNTS = [
    ("1200", "Accounts Receivable", "asset", "debit"),
    ("2101", "VAT Payable - Estonia", "liability", "credit"),
    ("2102", "VAT Payable - Finland", "liability", "credit"),
    ("2103", "VAT Payable - Latvia", "liability", "credit"),
    ("3000", "Retained Earnings", "equity", "credit"),
    ("4101", "Ride Revenue - Estonia", "revenue", "credit"),
    ("4102", "Ride Revenue - Finland", "revenue", "credit"),
    ("4103", "Ride Revenue - Latvia", "revenue", "credit"),
    ("6200", "Marketing Expense - Coupons", "expense", "debit"),
]

# Billing tariff and VAT rates of the reference's rides.
UNLOCK_FEE = Decimal("1.00")
PER_MINUTE_RATE = Decimal("0.22")
REFERENCE_VAT_RATES = [("Estonia", "0.24"), ("Finland", "0.255"), ("Latvia", "0.21")]
RIDES_PER_DAY_MIN = 2
RIDES_PER_DAY_MAX = 6

# Vehicle id ranges of the reference fleet (lo, hi, city, country).
REFERENCE_CITY_RANGES = [
    (1, 30, "Tallinn", "Estonia"),
    (31, 60, "Helsinki", "Finland"),
    (61, 90, "Riga", "Latvia"),
]

# Fault injection defaults (rate per fault, seed).
FAULT_RATES = {"null": 0.005, "outlier": 0.003, "duplicate": 0.005, "country": 0.002}
FAULT_SEED = 123
FAULT_COUNTRY = "Tartu"
DEFAULT_FAULTS = ["null", "outlier", "duplicate"]
