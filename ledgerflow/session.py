"""Spark session settings used by tests, the bench and the pipeline runner."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every session of this package should carry. AQE re-plans joins and
# coalesces/splits shuffle partitions at runtime; timestamps are zone-free.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "static",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app_name: str = "ledgerflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(SESSION_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for cut lineage and intermediate tables.

    The cluster names it in ``spark.checkpoint.dir``; only when that is unset
    (tests, local runs) is ``fallback`` installed.
    """
    sc = spark.sparkContext
    current = sc.getConf().get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if current:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(current)
        return current
    if fallback is None:
        raise RuntimeError("spark.checkpoint.dir is not set and no fallback was given")
    os.makedirs(fallback, exist_ok=True)
    sc.setCheckpointDir(fallback)
    return fallback


def shared_folder(spark: SparkSession) -> str:
    """The shared folder, for what has to be stored; one process on its own makes one where none is named.

    A cluster's machines do not share a local folder, so a session on one has to name its folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return checkpoint_dir(spark, fallback=named)
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
    return checkpoint_dir(spark, fallback=tempfile.mkdtemp(prefix="ledgerflow-"))


# A query's shuffle files go when it ends, not when the driver happens to collect its garbage.
FREE_SHUFFLES = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the queries that are started inside; those that Spark does not know are left out."""
    before = {k: spark.conf.get(k) for k in values if spark.conf.isModifiable(k)}
    for k in before:
        spark.conf.set(k, values[k])
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def store(df, tag: str):
    """Write a frame to the shared folder under a name of its own and read it again."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    with settings(df.sparkSession, FREE_SHUFFLES):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def has_checkpoint_dir(spark: SparkSession) -> bool:
    sc = spark.sparkContext
    return bool(sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None))


def keep(df):
    """Cut the lineage of a DataFrame that several branches of one plan read.

    Written as Parquet to the shared folder the session names: compressed, where a
    checkpoint holds whole rows as they lie in memory, and each branch reads only the
    columns it needs. When the session names none, the frame is returned as is (recomputed
    per branch) rather than written to a machine-local folder.
    """
    return store(df, "kept") if has_checkpoint_dir(df.sparkSession) else df
