"""A corpus from raw documents to packed sequences: five stages of the operators in ledgerflow.llm.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet to the
shared folder and read again as the next stage's documents. All but the last keep the columns of
documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.llm import decontaminate, langid, linededup, neardup, packing
from ledgerflow.llm.common import read_table, stash


def apart(docs: DataFrame, added: tuple[str, ...]) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` with private names for columns that an operator adds too, and the name of each column there."""
    names = {c: f"__own_{c}" if c in added else c for c in docs.columns}
    return docs.withColumnsRenamed(names), names


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a recognisable language; ``lang`` becomes the predicted one.

    Rejected are texts without letters and texts that share no n-gram with any profile.
    """
    own, names = apart(docs, ("lang_pred", "score"))
    found = langid.identify_language(own)
    kept = found.filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") > 0))
    return kept.select(*[F.col("lang_pred").alias("lang") if c == "lang" else F.col(n).alias(c) for c, n in names.items()])


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without cross-site boilerplate lines; ``n_chars`` follows the text."""
    own, names = apart(docs, ("n_lines", "n_removed"))
    cleaned = linededup.remove_common_lines(own)
    return cleaned.select(*[F.length("text").cast("long").alias("n_chars") if c == "n_chars" else F.col(n).alias(c)
                            for c, n in names.items()])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return neardup.keep_one_each(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.remove_leaks(docs, read_table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in a packed sequence."""
    return packing.pack_documents(docs)


STAGES = [("language_id", language_id), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("benchmark_decontamination", benchmark_decontamination), ("best_fit_packing", best_fit_packing)]

# Language identification, Bayesian pruning and packing have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stash(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
