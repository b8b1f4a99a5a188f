"""Running sums over an order, spread over the cluster.

A window with a running sum lists each of its partitions in one task. Here rows are range-partitioned
by (group, order) instead, so a large group lies in several pieces, each summed on its own; the totals
of the pieces before (one row a piece and group) are then added. The cut into pieces is stored in
the shared folder: both passes see the same pieces, and a lost executor cannot change them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.session import store

PIECE = "__piece"


def join_null_safe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join in which null equals null."""
    r = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys],
                     *[c for c in right.columns if c not in keys])
    cond = F.lit(True)
    for k in keys:
        cond = cond & left[k].eqNullSafe(r[f"_r_{k}"])
    return left.join(r, cond, how).drop(*[f"_r_{k}" for k in keys])


def running_sum(df: DataFrame, group: list[str], order: list[Column], value: str, out: str) -> DataFrame:
    """``df`` with ``out``: the sum of ``value`` over the row and all rows of its group before it.

    ``order`` has to tell the rows of a group apart. Nulls in the group's columns are equal.
    """
    pieces = store(df.repartitionByRange(*[F.col(g).asc_nulls_first() for g in group], *order)
                   .withColumn(PIECE, F.spark_partition_id()), "pieces")
    upto = (Window.partitionBy(*group, PIECE).orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = Window.partitionBy(*group).orderBy(PIECE).rowsBetween(Window.unboundedPreceding, -1)
    # Only a group's later pieces have something before them: at most one group a piece.
    offsets = (pieces.groupBy(*group, PIECE).agg(F.sum(value).alias("__sum"))
               .withColumn("__before", F.sum("__sum").over(before)).where(F.col("__before").isNotNull()).drop("__sum"))
    summed = join_null_safe(pieces.withColumn(out, F.sum(value).over(upto)), offsets, [*group, PIECE], "left")
    return summed.withColumn(out, F.col(out) + F.coalesce("__before", F.lit(0))).drop("__before", PIECE)
