"""Cross-site boilerplate lines by the number of distinct sites that carry them.

DataFrame functions only. Every line hash gets a HyperLogLog sketch of its
sites, merged by aggregation; lines whose estimate is near the threshold get an
exact distinct count, so the decision equals that of exact counts. Lines on at
least ``min_sites`` sites are removed wherever they occur, without exception.

Identical texts are one document on several sites, not boilerplate of several
documents: a line also has to stand in ``min_sites`` different texts, counted
in the same way.

Defined cases: null text stays null; lines are compared without the blanks
around them, blank lines are never removed; a null site counts as no site; rows
that repeat an id are treated each by its own text; an empty table gives an
empty table; the input's columns are kept, ``n_lines`` and ``n_removed`` of the
input give way to the result's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import hot_keys, spread_join, stash

MIN_SITES = 10
# The sketches have 2**LOG_K registers: a standard error of 1.6 %. Estimates within NEAR of the
# threshold (15 standard errors) are counted exactly.
LOG_K = 12
NEAR = 0.25


def _lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def _key(line: Column) -> Column:
    """128 bits that stand for a line without the blanks around it."""
    plain = F.trim(line)
    return F.struct(F.xxhash64(plain).alias("a"), F.xxhash64(F.lit(20177), plain).alias("b"))


def likely_lines(docs: DataFrame, text_col: str = "text", site_col: str = "source",
                 min_sites: int = MIN_SITES) -> DataFrame:
    """(key, sites, texts, n): lines that by their sketches may be on ``min_sites`` sites and in as many
    different texts, and how often they occur."""
    sketch = lambda c: F.hll_sketch_estimate(F.hll_sketch_agg(c, LOG_K))
    sketched = _sites(docs, text_col, site_col).groupBy("key").agg(
        sketch("site").alias("sites"), sketch("whole").alias("texts"), F.count(F.lit(1)).alias("n"))
    return stash(sketched.filter(F.least("sites", "texts") >= min_sites * (1 - NEAR)), "likely-lines")


def _sites(docs: DataFrame, text_col: str, site_col: str) -> DataFrame:
    """(site, whole, key) of every line that is not blank; ``whole`` stands for the text it is in."""
    return (docs.select(F.col(site_col).cast("string").alias("site"), F.xxhash64(text_col).alias("whole"),
                        F.explode(_lines(F.col(text_col))).alias("line"))
            .filter("trim(line) <> ''").select("site", "whole", _key(F.col("line")).alias("key")))


def common_lines(docs: DataFrame, likely: DataFrame, text_col: str = "text", site_col: str = "source",
                 min_sites: int = MIN_SITES) -> DataFrame:
    """(key, sites): those of the ``likely`` lines that reach both counts."""
    sure = F.least("sites", "texts") > min_sites * (1 + NEAR)
    near = _sites(docs, text_col, site_col).join(likely.filter(~sure).select("key"), "key", "left_semi")

    def exact(what: str) -> DataFrame:
        return (near.filter(F.col(what).isNotNull()).select("key", what).distinct().groupBy("key")
                .agg(F.count(F.lit(1)).alias(f"{what}s")).filter(F.col(f"{what}s") >= min_sites))

    counted = exact("site").join(exact("whole").select("key"), "key", "left_semi")
    return likely.filter(sure).select("key", "sites").unionByName(counted.select("key", "sites"))


def remove_common_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                        site_col: str = "source", min_sites: int = MIN_SITES) -> DataFrame:
    """The columns of ``docs``, ``text`` without common lines, then ``n_lines`` and ``n_removed``."""
    likely = likely_lines(docs, text_col, site_col, min_sites)
    common = common_lines(docs, likely, text_col, site_col, min_sites).select("key")
    carried = (docs.select(F.col(id_col).alias("__id"), F.explode(_lines(F.col(text_col))).alias("line"))
               .filter("trim(line) <> ''").select("__id", _key(F.col("line")).alias("key")))
    # One line may be a third of all lines.
    by_doc = (spread_join(carried, common, hot_keys(likely, ["key"], "n"), ["key"], F.col("__id")).groupBy("__id")
              .agg(F.collect_set("key").alias("__common")))
    columns = [c for c in docs.columns if c not in ("n_lines", "n_removed")]
    joined = docs.select(*columns).join(by_doc, F.col(id_col).eqNullSafe(F.col("__id")), "left")
    text = F.col(text_col)
    is_common = lambda line: F.array_contains(F.col("__common"), _key(line))
    kept = F.filter(_lines(text), lambda line: ~is_common(line))
    applies = F.col("__common").isNotNull()
    out = joined.withColumn("__lines", F.when(applies, kept))
    return out.select(
        *[F.when(applies, F.array_join("__lines", "\n")).otherwise(text).alias(c) if c == text_col else F.col(c)
          for c in columns],
        F.when(text.isNull(), 0).otherwise(F.size(_lines(text))).cast("long").alias("n_lines"),
        F.when(applies, F.size(_lines(text)) - F.size("__lines")).otherwise(0).cast("long").alias("n_removed"))
