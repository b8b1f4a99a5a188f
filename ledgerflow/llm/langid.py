"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent letter n-grams in rank
order. A document is compared by the out-of-place distance: for each of its own
most frequent n-grams, how far its rank is from the profile's, or the profile
size where the profile lacks it. The nearest profile names the language.

Defined cases: null text or text without letters is ``und`` with score 0; texts
of any length are counted whole; equal counts rank by n-gram, equal distances
by language name; rows are independent, so repeated rows give repeated results;
with no labelled row there is no profile and every document is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import worker_state

UNDETERMINED = "und"
PROFILE_SIZE = 300
MAX_ORDER = 3
# Bound of the labelled sample the profiles are learned from, per language.
MAX_TRAINING_DOCS = 4000


def _letters() -> np.ndarray:
    return worker_state("letters", lambda: np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000))


def grams(text: str) -> np.ndarray:
    """Every letter n-gram (n up to 3) of a text as a number of 21 bits a character.

    Letters are lower-cased; every run of other characters is one space.
    """
    raw = text.lower().encode("utf-32-le", "replace")
    c = np.frombuffer(raw, np.uint32).astype(np.int64)
    is_letter = _letters()[c]
    c = np.where(is_letter, c, 32)
    keep = is_letter.copy()
    keep[1:] |= is_letter[:-1]  # the first character after a letter stands for its whole run
    c = np.concatenate(([32], c[keep], [32])) if len(c) else np.array([32, 32])
    pairs = (c[:-1] << 21) | c[1:]
    triples = (pairs[:-1] << 21) | c[2:]
    return np.concatenate([c[c != 32], pairs, triples])


def top_grams(text: str, size: int) -> np.ndarray:
    """The most frequent n-grams of a text, most frequent first."""
    g = np.sort(grams(text))
    first = np.flatnonzero(np.concatenate(([True], g[1:] != g[:-1])))
    count = np.diff(np.append(first, len(g)))
    order = np.argsort(-count, kind="stable")[:size]  # values are sorted: ties stay in order
    return g[first[order]]


def fit_profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                 size: int = PROFILE_SIZE, max_docs: int = MAX_TRAINING_DOCS) -> DataFrame:
    """(lang, gram, rank): profiles learned from at most about ``max_docs`` labelled rows a language.

    The sample is a hash share of each language's rows. Only one count per language reaches the
    driver.
    """
    labelled = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"),
                           F.col(lang_col).alias("lang")).filter("lang is not null and text is not null")
    counts = labelled.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()
    share = F.lit(0.0)
    for row in sorted(counts, key=lambda r: r["lang"]):
        share = F.when(F.col("lang") == row["lang"], F.lit(min(1.0, max_docs / row["n"]))).otherwise(share)
    sample = labelled.filter(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < share * 1_000_000)

    def count_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            by_lang: dict[str, list[str]] = {}
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(text)
            for lang, texts in by_lang.items():
                values, n = np.unique(np.concatenate([grams(t) for t in texts]), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(values)), pa.array(values), pa.array(n)], ["lang", "gram", "n"])

    counted = (sample.select("text", "lang").mapInArrow(count_grams, "lang string, gram long, n long")
               .groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    best_first = Window.partitionBy("lang").orderBy(F.desc("n"), F.asc("gram"))
    return (counted.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= size)
            .select("lang", "gram", (F.col("rank") - 1).alias("rank")))


def predict_language(docs: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     size: int = PROFILE_SIZE) -> DataFrame:
    """All columns of ``docs`` with ``lang_pred`` and ``score`` (1: at no distance, 0: nothing shared).

    The profiles reach every task as one table of at most ``size`` rows a language.
    """
    rows = profiles.collect()
    langs = sorted({r["lang"] for r in rows})
    known = np.array(sorted({r["gram"] for r in rows}), np.int64)
    ranks = np.full((len(known), len(langs)), -1, np.int32)
    for r in rows:
        ranks[np.searchsorted(known, r["gram"]), langs.index(r["lang"])] = r["rank"]

    def nearest(text: str | None) -> tuple[str, float]:
        if not text or not langs:
            return UNDETERMINED, 0.0
        own = top_grams(text, size)
        if own[-1] == own[0] == (32 << 21 | 32):  # padding only: no letter
            return UNDETERMINED, 0.0
        at = np.minimum(np.searchsorted(known, own), len(known) - 1)
        theirs = np.where((known[at] == own)[:, None], ranks[at], -1)
        place = np.arange(len(own), dtype=np.int32)[:, None]
        distance = np.where(theirs >= 0, np.minimum(np.abs(theirs - place), size), size).sum(axis=0)
        best = int(distance.argmin())
        return langs[best], 1.0 - float(distance[best]) / (size * len(own))

    clash = {"lang_pred", "score", "__text"}
    kept = [c for c in docs.columns if c not in clash]
    frame = docs.select(*[F.col(c) for c in kept], F.col(text_col).alias("__text"))
    out_schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in frame.schema.fields[:-1]]
                           + ["lang_pred string", "score double"])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [nearest(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                batch.columns[:-1] + [pa.array([x[0] for x in found], pa.string()),
                                      pa.array([x[1] for x in found], pa.float64())],
                kept + ["lang_pred", "score"])

    return frame.mapInArrow(predict, out_schema)


def identify_language(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      lang_col: str = "lang") -> DataFrame:
    """Learn from the rows of ``docs`` that are not held out, then predict every row."""
    held_out = F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(True))
    profiles = fit_profiles(docs.filter(~held_out), id_col, text_col, lang_col)
    return predict_language(docs, profiles, id_col, text_col)


def held_out_column(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 4 == 2, F.lit(False))
