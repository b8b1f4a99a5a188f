"""First-seen state of orders: what a period run must know of the rows before its period.

Staging keeps the first clean row of every order, over the whole source. For the rows of one period
that needs one fact of the rest: which orders have a clean row that starts earlier. The state stores
(order_id, first clean start) in buckets of the order's hash. A run reads source files that are new
since the last run, once, adds their orders as a batch, and looks its own orders up in the buckets
they fall in; the history itself is not read again.

The state knows each source file by path, length and modification time. If a file it has read is
gone or changed, it starts over from all files. Batches are merged into one when there are many.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators import staging
from ledgerflow.periods import Period
from ledgerflow.sources.versions import Files, Versions


@dataclass(frozen=True)
class RideFiles:
    """How billing rows come from files: ``read(paths)`` gives the rows of those files."""

    files: DataFrame
    read: Callable[[list[str]], DataFrame]

    def stamps(self, spark: SparkSession) -> dict[str, str]:
        """Length and modification time of every source file."""
        out = {}
        for name in self.files.inputFiles():
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(spark.sparkContext._jvm.java.net.URI(name))
            status = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(path)
            out[path.toString()] = f"{status.getLen()}-{status.getModificationTime()}"
        return out


class OrderState:
    BUCKETS = 16
    # Batches that a lookup may have to open before they are merged.
    MAX_BATCHES = 24
    SCHEMA = "order_id string, first_start timestamp_ntz, _bucket int"

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.files = Files(spark, self.path)
        self.versions = Versions(self.files)

    @classmethod
    def _bucket(cls):
        return F.pmod(F.xxhash64("order_id"), F.lit(cls.BUCKETS)).cast("int")

    def _batch(self, firsts: DataFrame) -> str:
        run = uuid.uuid4().hex
        # Not shuffled into buckets first: a task writes at most one file a bucket.
        (firsts.withColumn("_bucket", self._bucket())
         .write.option("compression", "zstd").partitionBy("_bucket").parquet(f"{self.path}/batches/{run}"))
        return run

    @staticmethod
    def first_starts(rides: DataFrame) -> DataFrame:
        """Each order's earliest clean start; a hot order collapses before the shuffle."""
        clean = staging.guard_outlier(staging.guard_not_null(rides)).where(F.col("start_time").isNotNull())
        return clean.groupBy("order_id").agg(F.min("start_time").alias("first_start"))

    def refresh(self, source: RideFiles) -> list[str]:
        """Take in the source files that the state has not read; returns them."""
        before = self.versions.load()
        now = source.stamps(self.spark)
        known = before["files"] if before else {}
        if any(now.get(f) != stamp for f, stamp in known.items()):
            known, batches = {}, []
        else:
            batches = list(before["batches"]) if before else []
        new = sorted(set(now) - set(known))
        if not new and before and known:
            return []
        if new:
            batches.append(self._batch(self.first_starts(source.read(new))))
        if len(batches) > self.MAX_BATCHES:
            merged = self._read(batches).groupBy("order_id").agg(F.min("first_start").alias("first_start"))
            batches = [self._batch(merged)]
        self.versions.commit({"files": now, "batches": batches}, before)
        return new

    def _read(self, batches: list[str]) -> DataFrame:
        if not batches:
            return self.spark.createDataFrame([], self.SCHEMA)
        frames = [self.spark.read.schema(self.SCHEMA).parquet(f"{self.path}/batches/{b}") for b in batches]
        out = frames[0]
        for f in frames[1:]:
            out = out.unionByName(f)
        return out

    def first_seen_in(self, winners: DataFrame, period: Period) -> DataFrame:
        """Rows whose order has no clean row before the period (null ids are one order)."""
        found = self.versions.load()
        buckets = sorted(r[0] for r in winners.select(self._bucket().alias("b")).distinct().collect())
        earlier = (self._read(found["batches"] if found else []).where(F.col("_bucket").isin(buckets))
                   .where(F.col("first_start") < staging.ts_literal(period.start))
                   .select(F.col("order_id").alias("_seen")))
        return winners.join(earlier, winners["order_id"].eqNullSafe(earlier["_seen"]), "left_anti")
