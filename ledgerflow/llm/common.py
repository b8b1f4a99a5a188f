"""Helpers shared by the text operators."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable
from typing import Any

import numpy as np
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Odd multiplier of the polynomial hashes over word hashes (arithmetic is modulo 2**64).
BASE = 0x9E3779B97F4A7C15


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share, as ``spark.checkpoint.dir`` names it.

    Where the session names none (tests, a laptop) one is made and named for the session.
    """
    sc = spark.sparkContext
    folder = sc.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="llm-shared-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stash(df: DataFrame, tag: str) -> DataFrame:
    """Write a table to the shared folder and read it again: cuts the lineage, survives executors."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/{tag}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


# A key with at least HOT_ROWS rows may be hot; the HOT_KEYS largest are spread. A key with more than
# a thousandth of all rows is always one of them.
HOT_ROWS = 1000
HOT_KEYS = 1000


def hot_keys(counted: DataFrame, keys: list[str], rows: str) -> DataFrame:
    """The largest keys of ``counted`` (one row a key) and ``parts``, the number of ways to spread each.

    At most ``HOT_KEYS`` rows, so it may be broadcast.
    """
    return (counted.filter(F.col(rows) >= HOT_ROWS).orderBy(F.desc(rows), *keys).limit(HOT_KEYS)
            .select(*keys, F.ceil(F.col(rows) / HOT_ROWS).alias("parts")))


def spread_join(rows: DataFrame, table: DataFrame, hot: DataFrame, keys: list[str], by: Column,
                how: str = "inner") -> DataFrame:
    """Equi-join of ``rows`` with ``table`` (one row a key), the hot keys' rows dealt by ``by`` to several tasks.

    A hot key's row of ``table`` is repeated once a part; rows with a null key, which match nothing,
    are dealt too.
    """
    hot = F.broadcast(hot)
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()
    part = (F.when(no_key, F.xxhash64(by)).when(F.col("parts").isNotNull(), F.pmod(F.xxhash64(by), F.col("parts")))
            .otherwise(F.lit(0)))
    dealt = rows.join(hot, keys, "left").withColumn("__part", part).drop("parts")
    parts = F.sequence(F.lit(0).cast("long"), F.coalesce(F.col("parts"), F.lit(1)) - 1)
    repeated = table.join(hot, keys, "left").withColumn("__part", F.explode(parts)).drop("parts")
    return dealt.join(repeated, [*keys, "__part"], how).drop("__part")


def worker_state(name: str, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task: a word memory, a table or a tokenizer.

    It keeps one at a time, so that a worker that serves several operators stays small.
    """
    kept = vars(sys).setdefault("_llm_worker_state", {})
    if name not in kept:
        kept.clear()
        kept[name] = make()
    return kept[name]


class WordHashes(dict):
    """64-bit hash of each word (bytes), remembered up to ``limit`` words."""

    def __init__(self, limit: int = 400_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def word_hashes() -> WordHashes:
    return worker_state("word_hashes", WordHashes)


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Polynomial hash of every ``n`` consecutive entries, built by doubling spans."""
    if len(h) < n:
        return np.empty(0, np.uint64)
    out, size, span, width = None, 0, h, 1
    while True:
        if n & width:
            if out is None:
                out, size = span, width
            else:
                m = len(h) - size - width + 1
                out = out[:m] * np.uint64(pow(BASE, width, 1 << 64)) + span[size:size + m]
                size += width
        if size == n:
            return out[:len(h) - n + 1]
        m = len(span) - width
        span = span[:m] * np.uint64(pow(BASE, width, 1 << 64)) + span[width:width + m]
        width *= 2


def mixed(h: np.ndarray, seed: int = 0) -> np.ndarray:
    """Avalanche step, so that polynomial hashes order like random numbers."""
    h = (h + np.uint64((seed * 0x632BE59BD9B4E019 + BASE) % (1 << 64)))
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    """Smallest entry of every ``width`` consecutive ones."""
    if len(h) < width:
        return h[:0]
    span, size = h, 1
    while size * 2 <= width:
        span = np.minimum(span[:len(span) - size], span[size:])
        size *= 2
    m = len(h) - width + 1
    return np.minimum(span[:m], span[width - size:width - size + m])
