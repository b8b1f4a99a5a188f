"""Audit of a chain of filters: what each step removes, in every order of the filters.

Every row is reduced to five bits, one a filter, and counted by (part, bits): at most 32 rows a part
leave that aggregate, whatever the size of the table. A part's counts are reshaped to a 2x2x2x2x2
tensor with one axis a filter (0 passes, 1 fails), and each figure of each step of each order is one
contraction that selects pass, fail or all along every axis.

"Identical to a row with a smaller id" needs no join of rows: the rows that pass are those of the
smallest id of each text, found by a rank that Spark limits before the shuffle, so that a text held
by a third of all rows ships one row a task.

Defined cases: null text is the empty text (and identical to it); null source is the part of the empty
string; rows that repeat an id each count, and none of them is a copy of another; a row without an
id is no one's copy; several labels of one id count if any of them is 1, an id without a label has
neither; texts of any length are read whole, texts are compared by 256-bit hash; an empty table gives
no rows; columns that are not named here are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow.llm.common import stash

FILTERS = "ABCDE"
MIN_WORDS = 200
# Percent: least share of distinct words, greatest share of capitals.
MIN_DISTINCT = 50
MAX_CAPITALS = 2
SYMBOLS = "[#$%&*|]"
BLANKS = "[ \\t\\n\\x0B\\f\\r]+"
PASS, FAIL, ALL = (1, 0), (0, 1), (1, 1)
MEASURES = ("docs", "good", "toxic")
PARTS_A_CONTRACTION = 64
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


def text_bits(text: Column, words: Column) -> Column:
    """Bits of the filters that a text alone decides: A is 1, B 2, C 4, D 8 where it fails."""
    bit = lambda failed, value: F.when(failed, F.lit(value)).otherwise(F.lit(0))
    n = F.size(words)
    capitals = F.length(text) - F.length(F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", ""))
    return (bit(n < MIN_WORDS, 1) + bit(100 * F.size(F.array_distinct(words)) < MIN_DISTINCT * n, 2)
            + bit(100 * capitals > MAX_CAPITALS * F.length(text), 4) + bit(text.rlike(SYMBOLS), 8))


def document_counts(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    part_col: str = "source") -> DataFrame:
    """(key, id, part, bits, n, good, toxic): equal rows counted together, texts replaced by their hash."""
    rows = (docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
            .withColumn("words", F.array_remove(F.split("text", BLANKS), ""))
            .select(F.sha2("text", 256).alias("key"), "id", "part", text_bits(F.col("text"), F.col("words")).alias("bits"))
            .groupBy("key", "id", "part", "bits").agg(F.count(F.lit(1)).alias("n")))
    one = lambda c: F.max((F.coalesce(F.col(c), F.lit(0)) == 1).cast("int"))
    marks = (labels.filter(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id"))
             .agg(one("quality").alias("good"), one("toxic").alias("toxic")))
    # rows without an id match no label and would meet in one task
    named = rows.filter("id is not null").join(marks, "id", "left")
    nameless = rows.filter("id is null").withColumns({c: F.lit(None).cast("int") for c in ("good", "toxic")})
    counts = named.unionByName(nameless).select("key", "id", "part", "bits", "n",
                                                *[F.coalesce(c, F.lit(0)).alias(c) for c in ("good", "toxic")])
    return stash(counts, "filter-bits")


def contingency(counts: DataFrame) -> DataFrame:
    """(part, cells): per part (bits, docs, good, toxic) with bit 16 where the text is a copy."""
    by_id = Window.partitionBy("key", F.col("id").isNull()).orderBy("id")
    first = counts.withColumn("__rank", F.rank().over(by_id)).filter("__rank = 1").drop("__rank")

    def tally(rows: DataFrame, sign: int, bit: int) -> DataFrame:
        return rows.groupBy("part", (F.col("bits") + bit).alias("bits")).agg(*[
            (sign * F.sum(F.col("n") * weight)).alias(name)
            for name, weight in zip(MEASURES, (F.lit(1), F.col("good"), F.col("toxic")))])

    # copies: all rows, less those that pass
    cells = (tally(counts, 1, 16).unionByName(tally(first, -1, 16)).unionByName(tally(first, 1, 0))
             .groupBy("part", "bits").agg(*[F.sum(m).alias(m) for m in MEASURES]))
    return cells.groupBy("part").agg(F.collect_list(F.struct("bits", *MEASURES)).alias("cells"))


def selectors() -> tuple[list[tuple[str, int]], dict[str, list[np.ndarray]]]:
    """Steps as (order, step), and for each kind of selection one (steps, 2) matrix an axis."""
    steps = [("".join(p), k + 1) for p in permutations(FILTERS) for k in range(len(FILTERS))]
    picks: dict[str, list[np.ndarray]] = {}
    for kind, before, here, after in (("kept", PASS, PASS, ALL), ("removed", PASS, FAIL, ALL),
                                      ("failing", ALL, FAIL, ALL), ("unique", PASS, FAIL, PASS)):
        picks[kind] = [np.array([before if order.index(f) < k - 1 else here if order.index(f) == k - 1 else after
                                 for order, k in steps], np.int64) for f in FILTERS]
    return steps, picks


def contract(counts: np.ndarray, axes: list[np.ndarray]) -> np.ndarray:
    """(parts, measures, steps) of a (parts, measures, 2, 2, 2, 2, 2) tensor."""
    # one axis at a time: the axis of steps stays last, the axes not yet contracted before it
    out = np.einsum("pmabcde,sa->pmbcdes", counts, axes[0])
    for letters, axis in zip(("bcde", "cde", "de", "e"), axes[1:]):
        out = np.einsum(f"pm{letters}s,s{letters[0]}->pm{letters[1:]}s", out, axis)
    return out


def interaction_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      part_col: str = "source") -> DataFrame:
    """(part, filter_order, step, and the FIGURES) for every part, order and step."""
    cells = contingency(document_counts(docs, labels, id_col, text_col, part_col))
    steps, picks = selectors()
    orders, numbers = [s[0] for s in steps], [s[1] for s in steps]
    letter = np.array([FILTERS.index(order[k - 1]) for order, k in steps])
    names = ["part", "filter_order", "step", *FIGURES]

    def audit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, PARTS_A_CONTRACTION):
                batch = whole.slice(k, PARTS_A_CONTRACTION)
                tensor = np.zeros((batch.num_rows, len(MEASURES), 32), np.int64)
                for row, found in enumerate(batch.column(1).to_pylist()):
                    for cell in found:
                        tensor[row, :, cell["bits"]] = [cell[m] for m in MEASURES]
                # bit 1 is A: reshaped, the last axis is the lowest bit
                tensor = tensor.reshape(-1, len(MEASURES), 2, 2, 2, 2, 2).transpose(0, 1, 6, 5, 4, 3, 2)
                kept, removed, failing, unique = (contract(tensor, picks[x]) for x in ("kept", "removed", "failing", "unique"))
                shapley = np.stack([removed[:, 0][:, letter == f].sum(axis=1) for f in range(len(FILTERS))], axis=1)
                figures = [kept[:, 0], removed[:, 0], failing[:, 0] - removed[:, 0], unique[:, 0], removed[:, 1],
                           removed[:, 2], shapley[:, letter]]
                parts = batch.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p in parts for _ in steps], pa.string()), pa.array(orders * len(parts)),
                     pa.array(numbers * len(parts), pa.int32())]
                    + [pa.array(np.ascontiguousarray(x).ravel(), pa.int64()) for x in figures], names)

    return cells.mapInArrow(audit, "part string, filter_order string, step int, "
                            + ", ".join(f"{f} long" for f in FIGURES))
