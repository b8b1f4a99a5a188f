"""Readers and writers for the ledger's inputs and persisted tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow import schemas as S
from ledgerflow.sources.orderstate import RideFiles

CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"


def _read_csv(spark: SparkSession, path: str | list[str], schema) -> DataFrame:
    # Declared types bound to the header's names, whatever their order, and FAILFAST: a
    # malformed number raises instead of silently becoming null, a missing column too.
    header = spark.read.option("header", True).csv(path).columns
    missing = [n for n in schema.fieldNames() if n not in header]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}")
    declared = T.StructType([schema[n] if n in schema.fieldNames() else T.StructField(n, T.StringType())
                             for n in header])
    # enforceSchema off: a file of the folder with another header raises.
    return (spark.read.schema(declared)
            .option("header", True)
            .option("enforceSchema", False)
            .option("mode", "FAILFAST")
            .option("timestampNTZFormat", CSV_TIMESTAMP_FORMAT)
            .csv(path).select(*schema.fieldNames()))


def read_rides(spark: SparkSession, path: str | list[str], fmt: str = "csv") -> DataFrame:
    """Billing rows with the declared schema (CSV or Parquet)."""
    if fmt == "csv":
        return _read_csv(spark, path, S.RIDES)
    df = spark.read.format(fmt).load(path)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in S.RIDES.fields])


def ride_files(spark: SparkSession, path: str, fmt: str = "csv") -> RideFiles:
    """The files of ``read_rides``, for runs that keep a first-seen state."""
    listed = spark.read.schema(S.RIDES).format(fmt).load(path)
    return RideFiles(listed, lambda paths: read_rides(spark, paths, fmt))


def read_account_mapping(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, S.ACCOUNT_MAPPING)


def read_chart_of_accounts(spark: SparkSession, path: str) -> DataFrame:
    return _read_csv(spark, path, S.CHART_OF_ACCOUNTS)


def reference_account_mapping(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(S.REFERENCE_ACCOUNT_MAPPING, S.ACCOUNT_MAPPING)


def reference_chart_of_accounts(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(S.REFERENCE_CHART_OF_ACCOUNTS, S.CHART_OF_ACCOUNTS)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """CSV export with ``yyyy-MM-dd HH:mm:ss`` timestamps and a header row."""
    (df.write.mode(mode)
     .option("header", True)
     .option("timestampNTZFormat", CSV_TIMESTAMP_FORMAT)
     .option("timestampFormat", CSV_TIMESTAMP_FORMAT)
     .csv(path))


def bulk_load(df: DataFrame, path: str, partition_by: list[str] | None = None,
              sort_within: list[str] | None = None) -> None:
    """Replace a stored table as a whole (drop, create, copy in one overwrite)."""
    if sort_within:
        df = df.sortWithinPartitions(*sort_within)
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
