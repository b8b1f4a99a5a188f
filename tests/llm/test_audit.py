"""The filter audit against filters run one after another over every row."""

from itertools import permutations

from pyspark.sql import functions as F

from ledgerflow.llm import audit, queries
from ledgerflow.llm.common import read_table

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, source string, part string, step int, key string"
LABELS = "doc_id long, quality int, toxic int, n int"


def words(text):
    out = [""]
    for c in text:
        if c in " \t\n\x0b\x0c\r":
            out.append("")
        else:
            out[-1] += c
    return [w for w in out if w]


def brute(docs, labels):
    rows, first, marks = [], {}, {}
    for d, text, _ in docs:
        if d is not None:
            first[text or ""] = min(first.get(text or "", d), d)
    for d, quality, toxic in labels:
        good, bad = marks.get(d, (False, False))
        marks[d] = (good or quality == 1, bad or toxic == 1)
    for d, text, source in docs:
        t = text or ""
        w = words(t)
        fails = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w),
                 "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), "D": any(c in "#$%&*|" for c in t),
                 "E": d is not None and first[t] < d}
        rows.append((source or "", fails, *(marks.get(d, (False, False)) if d is not None else (False, False))))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for k, f in enumerate(order):
                gone = [r for r in left if r[1][f]]
                left = [r for r in left if not r[1][f]]
                shapley[f] += len(gone)
                failing = [r for r in own if r[1][f]]
                out[part, "".join(order), k + 1] = [
                    len(left), len(gone), len(failing) - len(gone), sum(sum(r[1].values()) == 1 for r in failing),
                    sum(r[2] for r in gone), sum(r[3] for r in gone), f]
        for key, figures in out.items():
            if key[0] == part:
                figures[-1] = shapley[figures[-1]]
    return out


def as_dict(result):
    rows = result.collect()
    found = {(r["part"], r["filter_order"], r["step"]): [r[f] for f in audit.FIGURES] for r in rows}
    assert len(found) == len(rows)
    return found


def test_query_matches_filters_run_in_turn(spark):
    docs = read_table(spark, SF, "documents").select("doc_id", "text", "source").collect()
    labels = read_table(spark, SF, "labels").select("doc_id", "quality", "toxic").collect()
    got = as_dict(queries.op12_filter_audit(spark, SF))
    assert got == brute([tuple(r) for r in docs], [tuple(r) for r in labels])
    assert all(any(v[k] for v in got.values()) for k in range(len(audit.FIGURES)))


def test_edges(spark):
    many = " ".join(f"w{k}" for k in range(300))
    docs = [(1, None, None), (2, "", ""), (3, "", "a"), (None, "", "a"), (None, "x", "a"), (4, "x", "a"), (9, "x", "a"),
            (9, "x", "a"), (9, "y |", "b"), (10, many, "b"), (11, many, "b"), (12, many + " $", "b"), (13, "AB c", "b"),
            (14, "w " * 50_000, "c"), (15, "\u00a0a\u2003b é", "c"), (16, "\x1ca\x0b\x0cb", "c"), (5, "x", None)]
    labels = [(4, 1, 0), (4, 0, 1), (9, None, 1), (10, 1, None), (None, 1, 1), (99, 1, 1), (14, 1, 0), (14, 1, 0)]
    got = as_dict(audit.interaction_audit(
        spark.createDataFrame([(d, t, s, "p", 1, "k") for d, t, s in docs], DOCS),
        spark.createDataFrame([(*r, 0) for r in labels], LABELS)))
    assert got == brute(docs, labels)


def test_empty_tables(spark):
    docs, labels = spark.createDataFrame([], DOCS), spark.createDataFrame([], LABELS)
    assert audit.interaction_audit(docs, labels).collect() == []
    some = spark.createDataFrame([(1, "x", "s", "p", 1, "k")], DOCS)
    assert len(as_dict(audit.interaction_audit(some, labels))) == 600


def test_a_large_group_of_copies_passes_once(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("copy").alias("text"), F.lit("s").alias("source"))
    got = as_dict(audit.interaction_audit(docs, spark.createDataFrame([], LABELS)))
    assert got["s", "EABCD", 1][:2] == [1, 4999]
