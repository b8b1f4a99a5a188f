"""Staging: guardrails, order dedup, and the quarantine of rejected rows.

Guardrails run as a cascade and the first failing one names the rejection:
null money, then outlier amount, then duplicate order. Both outputs use the
same classification.

Scale notes
-----------
* Staging keeps the first row of every order with ``row_number() == 1`` in one
  scan and one exchange. Catalyst plans that as a WindowGroupLimit: a partial
  top-1 per order runs before the exchange, so even an order id that holds a
  third of all rows (or the null order id) ships at most one row per map task.
* The guards read money columns that the plan works out once (``money_worked_out_once``).
* A row on or after the period's end never precedes a row inside the period,
  so a period run reads the source up to the period's end only; the bound
  reaches the Parquet scan.
* The quarantine shuffles each row once, by order, and numbers rejects where
  they lie. Order ids with very many rows (found by the sizes of hash buckets)
  take the ways below instead, which spread one order over all tasks.
* There it needs only orders with several clean rows. Order sizes come
  from a narrow aggregate on the order key (map-side combine), and rows are
  picked by a null-safe semi join that AQE broadcasts while that key set is
  small, so the bulk of the rows is never shuffled.
* Duplicates are "every clean row except the winner of its order". They are
  found as a multiset difference keyed by the whole row (counts of +1 for each
  clean row, -1 for each winner), which is a hash aggregate with map-side
  combine: a group of exact copies collapses to one counted row before the
  shuffle, and distinct rows of a hot order spread over all reducers.
* Quarantine sequence numbers (needed for the surrogate id) are assigned to
  counted rows: a range-partitioned running sum of copies per (order, ride,
  reason) and an ``explode(sequence(..))`` restore one row per copy, so no
  group is listed in one task.
* ``staged_and_rejected`` makes both outputs in one shuffle and one sort, for plans that read both.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow import functions as LF
from ledgerflow import schemas as S
from ledgerflow.operators.ranking import running_sum
from ledgerflow.periods import Period

DEDUP_SCOPES = ("source", "period", "month")

# Order of rows inside an order id: start time, ride id (nulls last), then the
# remaining columns so that ties are broken the same way on every run.
_TIE_BREAK = ["scooter_id", "end_time", "duration_min", "distance_km", "amount", "vat_rate",
              "vat_amount", "sum_with_vat_amount", "currency", "coupon_used", "coupon_amount",
              "city", "country"]


def order_columns(first: tuple[str, ...] = ("start_time", "ride_id")) -> list[str]:
    return list(first) + [c for c in _TIE_BREAK if c not in first]


def ride_order(first: tuple[str, ...] = ("start_time", "ride_id")) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in order_columns(first)]


def ts_literal(d) -> Column:
    return F.expr(f"TIMESTAMP_NTZ '{d.isoformat()} 00:00:00'")


def in_period_by_start(period: Period, start_col: str = "start_time") -> Column:
    """``to_date(start_time)`` in the closed period, written as a timestamp range
    so the predicate reaches the Parquet scan; a null start time never matches."""
    c = F.col(start_col)
    return (c >= ts_literal(period.start)) & (c < ts_literal(period.end_exclusive))


def rejection_reason(threshold: Decimal = S.OUTLIER_THRESHOLD) -> Column:
    any_null = F.lit(False)
    for c in S.MONEY_COLUMNS:
        any_null = any_null | F.col(c).isNull()
    return (F.when(any_null, F.lit(S.NULL_REASON))
            .when(LF.money(F.col("amount")) > F.lit(threshold), F.lit(S.OUTLIER_REASON)))


def classify(rides: DataFrame, threshold: Decimal = S.OUTLIER_THRESHOLD) -> DataFrame:
    """Adds ``rejection_reason`` (null for rows that pass the first two guardrails)."""
    return rides.withColumn("rejection_reason", rejection_reason(threshold))


def money_worked_out_once(rides: DataFrame) -> DataFrame:
    """The same rows; filters on money columns stay above the projection that derives these columns.

    Catalyst moves a filter below the projection it reads and writes the derivation into each of its
    conditions, where casts from double to decimal cost more than the scan. It does not move one below
    the generator that makes its columns, here of one row a ride. Filters on other columns still move.
    """
    return rides.select(*[c for c in rides.columns if c not in S.MONEY_COLUMNS],
                        F.inline(F.array(F.struct(*S.MONEY_COLUMNS)))).select(*rides.columns)


def guard_not_null(rides: DataFrame) -> DataFrame:
    cond = F.lit(True)
    for c in S.MONEY_COLUMNS:
        cond = cond & F.col(c).isNotNull()
    return money_worked_out_once(rides).where(cond)


def guard_outlier(rides: DataFrame, threshold: Decimal = S.OUTLIER_THRESHOLD) -> DataFrame:
    return rides.where(LF.money(F.col("amount")) <= F.lit(threshold))


def _dedup_partition(scope: str) -> list[Column]:
    if scope == "month":
        return [F.col("order_id"), F.trunc(F.to_date("start_time"), "month")]
    return [F.col("order_id")]


def first_per_order(clean: DataFrame, scope: str = "source", tags: tuple[str, ...] = ()) -> DataFrame:
    """The first row of every order id (nulls form one order); rows of other ``tags`` are other books."""
    w = Window.partitionBy(*tags, *_dedup_partition(scope)).orderBy(*ride_order())
    return (clean.withColumn("_dedup_rn", F.row_number().over(w))
            .where(F.col("_dedup_rn") == 1)
            .drop("_dedup_rn"))


def rows_of_repeated_orders(clean: DataFrame, scope: str = "source") -> DataFrame:
    """Clean rows of orders with several clean rows: only these can hold duplicates.

    Order sizes are a narrow aggregate on the order key (map-side combine, so
    a hot order collapses before the shuffle); rows are then picked by a
    null-safe semi join, which AQE broadcasts when the key set is small.
    """
    keyed = clean.withColumn("_k0", F.col("order_id"))
    keys = ["_k0"]
    if scope == "month":
        keyed = keyed.withColumn("_k1", F.trunc(F.to_date("start_time"), "month"))
        keys.append("_k1")
    repeated = (keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > 1)
                .select(*[F.col(k).alias(f"_m{k}") for k in keys]))
    cond = None
    for k in keys:
        c = keyed[k].eqNullSafe(repeated[f"_m{k}"])
        cond = c if cond is None else cond & c
    return keyed.join(repeated, cond, "left_semi").drop(*keys)


def dedup_orders(rides: DataFrame, threshold: Decimal = S.OUTLIER_THRESHOLD) -> DataFrame:
    """Clean rows of the whole source with one row per order id."""
    return first_per_order(guard_outlier(guard_not_null(rides), threshold))


def _staged_columns() -> dict[str, Column]:
    return {
        **{c: F.col(c) for c in ("order_id", "ride_id", "scooter_id")},
        "start_time": F.col("start_time").cast("timestamp_ntz"),
        "end_time": F.col("end_time").cast("timestamp_ntz"),
        "ride_date": F.to_date("start_time"),
        **{c: F.col(c) for c in ("duration_min", "distance_km")},
        "amount": LF.money(F.col("amount")),
        "vat_rate": F.col("vat_rate").cast(S.RATE),
        "vat_amount": LF.money(F.col("vat_amount")),
        "sum_with_vat_amount": LF.money(F.col("sum_with_vat_amount")),
        "currency": F.col("currency"),
        "coupon_code": LF.coupon_code(F.col("coupon_used")),
        "coupon_amount": LF.coupon_amount_or_zero(F.col("coupon_used"), F.col("coupon_amount")),
        **{c: F.col(c) for c in ("city", "country")},
    }


def _named(columns: dict[str, Column]) -> list[Column]:
    return [c.alias(name) for name, c in columns.items()]


def staged_projection(df: DataFrame, tags: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*tags, *_named(_staged_columns()))


def _check_scope(scope: str) -> None:
    if scope not in DEDUP_SCOPES:
        raise ValueError(f"dedup_scope must be one of {DEDUP_SCOPES}, got {scope!r}")


def before_end(period: Period) -> Column:
    """Rows that can decide what a run over the period stages: all that start before its end.

    Rows of an order are ranked by start time with nulls last, so a later row
    or one without a start never precedes a row inside the period.
    """
    return F.col("start_time") < ts_literal(period.end_exclusive)


def orders_touching(rides: DataFrame, period: Period) -> DataFrame:
    """Source rows up to the period's end of every order that has a row in the period.

    A semi join on ``order_id`` with null-safe equality, so the null order id
    is one order as in the window. Used by stored (monthly) runs: the
    whole-source dedup then shuffles only the orders the period can keep.
    """
    # distinct first: a hot order id collapses map-side before the shuffle
    keys = (rides.where(in_period_by_start(period))
            .select(F.col("order_id").alias("_oid")).distinct())
    return rides.where(before_end(period)).join(
        keys, rides["order_id"].eqNullSafe(keys["_oid"]), "left_semi")


def stage_rides(rides: DataFrame, period: Period, threshold: Decimal = S.OUTLIER_THRESHOLD,
                dedup_scope: str = "source", tags: tuple[str, ...] = ()) -> DataFrame:
    """Clean, typed, deduplicated rides of the period.

    ``dedup_scope="source"`` (the reference's staging) deduplicates the whole
    source and then keeps the period, so a later copy in another period is
    dropped here; ``"period"`` restricts to the period first. ``tags`` are columns that tell several
    books in one table apart: the rows of each are staged as if they stood alone.
    """
    _check_scope(dedup_scope)
    reach = in_period_by_start(period) if dedup_scope == "period" else before_end(period)
    clean = guard_outlier(guard_not_null(rides.where(reach)), threshold)
    winners = first_per_order(clean, dedup_scope, tags)
    if dedup_scope != "period":
        winners = winners.where(in_period_by_start(period))
    return staged_projection(winners, tags)


def _counted_rejects(rides: DataFrame, threshold: Decimal, scope: str) -> DataFrame:
    """Rejected rows as distinct contents with a copy count."""
    classified = classify(rides, threshold).select(*S.RIDE_COLUMNS, "rejection_reason")
    guarded = (classified.where(F.col("rejection_reason").isNotNull())
               .groupBy(*S.RIDE_COLUMNS, "rejection_reason")
               .agg(F.count(F.lit(1)).alias("_copies")))
    clean = classified.where(F.col("rejection_reason").isNull()).select(*S.RIDE_COLUMNS)
    # Duplicates exist only in orders with several clean rows: every such row
    # counts +1 and every winner -1, aggregated by whole row, so what is left
    # of a row are its duplicate copies (exact copies collapse map-side).
    several = rows_of_repeated_orders(clean, scope)
    winners = first_per_order(several, scope)
    dups = (several.withColumn("_n", F.lit(1))
            .unionByName(winners.withColumn("_n", F.lit(-1)))
            .groupBy(*S.RIDE_COLUMNS)
            .agg(F.sum("_n").alias("_copies"))
            .where(F.col("_copies") > 0)
            .withColumn("rejection_reason", F.lit(S.DUPLICATE_REASON)))
    return guarded.unionByName(dups)


SEQ_KEYS = ["order_id", "ride_id", "rejection_reason"]
# Copies of one row that are listed together; more are dealt in blocks of this size.
COPIES_A_BLOCK = 100_000


def _number_copies(counted: DataFrame, block: int = COPIES_A_BLOCK) -> DataFrame:
    """One row per copy with its sequence inside (order, ride, reason) by start time.

    Exact copies arrive collapsed (``_copies``) and are numbered by a running sum of copies that is
    range-partitioned, so neither a group with many distinct rows, nor equal start times, nor a row
    with many copies meets in one task.
    """
    last = F.floor((F.col("_copies") - 1) / block)
    blocks = (counted.withColumn("_block", F.explode(F.sequence(F.lit(0).cast("bigint"), last)))
              .withColumn("_copies", F.least(F.lit(block).cast("bigint"), F.col("_copies") - F.col("_block") * block)))
    numbered = running_sum(blocks, SEQ_KEYS, [*ride_order(("start_time",)), F.col("_block").asc()], "_copies", "_upto")
    return (numbered.withColumn("reject_seq",
                                F.explode(F.sequence(F.col("_upto") - F.col("_copies") + 1, F.col("_upto"))))
            .withColumn("reject_seq", F.col("reject_seq").cast("int"))
            .drop("_upto", "_copies", "_block"))


# Order ids are told crowded or not by buckets of their hash.
ORDER_BUCKETS = 16_384


def _bucket() -> Column:
    return F.pmod(F.xxhash64("order_id"), F.lit(ORDER_BUCKETS)).cast("int")


def _crowded_buckets(rides: DataFrame, rows: int) -> list[int]:
    """Buckets that hold far more rows than others: every order id of more than ``rows`` rows beyond
    twice the mean lies in one. One narrow aggregate, at most ORDER_BUCKETS rows to the driver."""
    sizes = rides.groupBy(_bucket().alias("_b")).agg(F.count(F.lit(1)).alias("_n")).collect()
    limit = rows + 2 * sum(r["_n"] for r in sizes) / ORDER_BUCKETS
    return sorted(r["_b"] for r in sizes if r["_n"] > limit)


def crowded_buckets(rides: DataFrame) -> list[int]:
    """Buckets of the orders that are too large for one task to take in one piece."""
    return _crowded_buckets(rides, COPIES_A_BLOCK)


def in_buckets(buckets: list[int]) -> Column:
    return F.array_contains(F.lit(buckets), _bucket()) if buckets else F.lit(False)


def _numbered_rejects(rides: DataFrame, threshold: Decimal, scope: str, inside: Column) -> DataFrame:
    """Rejected rows with their sequence inside (order, ride, reason), for orders that are not crowded.

    Rows meet once, by order: clean rows after an order's first are duplicates, and what is left is
    numbered where it lies.
    """
    guard = F.col("_guard")
    classified = classify(rides, threshold).select(*S.RIDE_COLUMNS, F.col("rejection_reason").alias("_guard"))
    first = Window.partitionBy(*_dedup_partition(scope), guard).orderBy(*ride_order())
    rejects = (classified.withColumn("_rn", F.row_number().over(first))
               .where((guard.isNotNull() | (F.col("_rn") > 1)) & inside))
    numbers = Window.partitionBy("order_id", "ride_id", guard).orderBy(*ride_order(("start_time",)))
    return (rejects.withColumn("reject_seq", F.row_number().over(numbers))
            .select(*S.RIDE_COLUMNS, F.coalesce(guard, F.lit(S.DUPLICATE_REASON)).alias("rejection_reason"),
                    "reject_seq"))


def quarantine_rides(rides: DataFrame, period: Period, threshold: Decimal = S.OUTLIER_THRESHOLD,
                     dedup_scope: str = "period", with_seq: bool = False) -> DataFrame:
    """Rows of the period rejected by the guardrails, each once, with its reason.

    The reference filters the period before looking for duplicates
    (``dedup_scope="period"``), unlike staging.
    """
    _check_scope(dedup_scope)
    src = rides.where(in_period_by_start(period)) if dedup_scope == "period" else rides
    inside = F.lit(True) if dedup_scope == "period" else in_period_by_start(period)
    crowded = _crowded_buckets(src, COPIES_A_BLOCK)
    if crowded:
        spread = F.array_contains(F.lit(crowded), _bucket())
        counted = _counted_rejects(src.where(spread), threshold, dedup_scope).where(inside)
        numbered = _numbered_rejects(src.where(~spread), threshold, dedup_scope, inside).unionByName(
            _number_copies(counted, COPIES_A_BLOCK))
    else:
        numbered = _numbered_rejects(src, threshold, dedup_scope, inside)
    return rejected_projection(numbered, ("reject_seq",) if with_seq else ())


def _rejected_columns() -> dict[str, Column]:
    return {
        "quarantine_id": LF.quarantine_id(F.col("order_id"), F.col("ride_id"), F.col("rejection_reason"),
                                          F.col("reject_seq")),
        **{c: F.col(c) for c in ("order_id", "ride_id", "scooter_id")},
        "start_time": F.col("start_time").cast("timestamp_ntz"),
        "end_time": F.col("end_time").cast("timestamp_ntz"),
        "ride_date": F.to_date("start_time"),
        **{c: F.col(c) for c in ("duration_min", "distance_km")},
        **{f"original_{c}": F.col(c) for c in ("amount", "vat_rate", "vat_amount", "sum_with_vat_amount")},
        "currency": F.col("currency"),
        **{f"original_{c}": F.col(c) for c in ("coupon_used", "coupon_amount")},
        **{c: F.col(c) for c in ("city", "country", "rejection_reason")},
    }


def rejected_projection(numbered: DataFrame, more: tuple[str, ...] = ()) -> DataFrame:
    return numbered.select(*_named(_rejected_columns()), *more)


def both_projections(rows: DataFrame) -> DataFrame:
    """Rows of ``sorted_out`` with the columns of both outputs; those that a row's own output lacks are null."""
    staged, rejected = _staged_columns(), _rejected_columns()
    is_staged = F.col("rejection_reason").isNull()
    shared = {n: c for n, c in staged.items() if n in rejected}
    return rows.select(
        *_named(shared),
        *_named({n: F.when(is_staged, c) for n, c in staged.items() if n not in shared}),
        *_named({n: F.when(~is_staged, c) for n, c in rejected.items() if n not in shared}))


def _marked_rides(rides: DataFrame, period: Period, threshold: Decimal) -> DataFrame:
    """Staged and rejected rides of orders that are not crowded, in one shuffle and one sort.

    Rows are numbered inside (order, guard, ride); an order's first row is the first one of the ride
    that starts first, so the windows over whole orders need no other sort.
    """
    guard, inside, copy = F.col("_guard"), F.col("_inside"), F.col("_copy")
    rows = (classify(rides.where(before_end(period)), threshold)
            .select(*S.RIDE_COLUMNS, F.col("rejection_reason").alias("_guard"),
                    in_period_by_start(period).alias("_inside"))
            .repartition("order_id", "_guard"))
    of_ride = Window.partitionBy("order_id", "_guard", "_inside", "ride_id").orderBy(*ride_order(("start_time",)))
    of_order = Window.partitionBy("order_id", "_guard")
    # no null start time comes before the period's end; null ride ids are last
    head = F.struct("start_time", F.col("ride_id").isNull().alias("no_ride"), "ride_id")
    rows = rows.withColumn("_copy", F.row_number().over(of_ride)).select(
        "*", F.min(F.when(copy == 1, F.col("start_time"))).over(of_order).alias("_earliest"),
        F.min(F.when((copy == 1) & inside, head)).over(of_order).alias("_head"))
    # duplicates are those of the period, but an order that starts before it is not staged
    of_first_ride = guard.isNull() & F.col("ride_id").eqNullSafe(F.col("_head.ride_id"))
    first = of_first_ride & (copy == 1)
    rows = rows.where(inside & (~first | (F.col("_earliest") >= ts_literal(period.start))))
    return rows.select(
        *S.RIDE_COLUMNS,
        F.when(~first, F.coalesce(guard, F.lit(S.DUPLICATE_REASON))).alias("rejection_reason"),
        F.when(~first, copy - of_first_ride.cast("int")).alias("reject_seq"))


def sorted_out(rides: DataFrame, period: Period, threshold: Decimal = S.OUTLIER_THRESHOLD) -> DataFrame:
    """The rides that ``stage_rides`` and ``quarantine_rides`` (each by its default scope) take, in one frame.

    Rejected ones have a ``rejection_reason`` and their ``reject_seq``, staged ones neither. Crowded orders
    take their own ways.
    """
    crowded = _crowded_buckets(rides.where(before_end(period)), COPIES_A_BLOCK)
    if crowded:
        spread = F.array_contains(F.lit(crowded), _bucket())
        hot = rides.where(spread)
        clean = guard_outlier(guard_not_null(hot.where(before_end(period))), threshold)
        winners = first_per_order(clean).where(in_period_by_start(period)).select(
            *S.RIDE_COLUMNS, F.lit(None).cast("string").alias("rejection_reason"), F.lit(None).cast("int").alias("reject_seq"))
        counted = _counted_rejects(hot.where(in_period_by_start(period)), threshold, "period")
        return (_marked_rides(rides.where(~spread), period, threshold).unionByName(winners)
                .unionByName(_number_copies(counted, COPIES_A_BLOCK)))
    return _marked_rides(rides, period, threshold)


def staged_and_rejected(rides: DataFrame, period: Period, threshold: Decimal = S.OUTLIER_THRESHOLD) -> DataFrame:
    """Rows of ``stage_rides`` and of ``quarantine_rides`` (each by its default scope) in one frame.

    Staged rows have neither ``rejection_reason`` nor ``quarantine_id``; of rejected rows only these two
    and ``order_id`` are filled, which is what checks read.
    """
    reason = F.col("rejection_reason")
    typed = staged_projection(sorted_out(rides, period, threshold), tags=("rejection_reason", "reject_seq"))
    return typed.select(
        reason, F.when(reason.isNotNull(), LF.quarantine_id(F.col("order_id"), F.col("ride_id"), reason,
                                                            F.col("reject_seq"))).alias("quarantine_id"),
        "order_id", *[F.when(reason.isNull(), F.col(c)).alias(c) for c in typed.columns
                      if c not in ("order_id", "rejection_reason", "reject_seq")])
