"""The manifest against a tree built in one loop: hashes, proofs, tampering, edge cases."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerflow.llm import manifest, queries
from ledgerflow.llm.common import read_table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, leaf string, tree string, root int"


def h(s: str) -> str:
    return hashlib.sha256(s.encode("utf-8")).hexdigest()


def leaf(row, text) -> str:
    values = [row["doc_id"], row["source"], row["lang"], row["n_chars"], text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][k:k + 8])) for k in range(0, len(out[-1]), 8)])
    return out


def siblings(levels, k):
    steps = []
    for nodes in levels[:-1]:
        run = k // 8 * 8
        steps.append(("".join(nodes[run:k]), "".join(nodes[k + 1:run + 8])))
        k //= 8
    return steps


def brute(rows):
    """Sorted result rows of the contract's query, with one tree walked row by row."""
    trees = {}
    for r in rows:
        trees.setdefault(r["lang"], []).append(r)
    order = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for lang in order:
        own = sorted(((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])), k)
                     for k, r in enumerate(trees[lang]))
        built[lang] = ([trees[lang][k] for _, k in own], levels_of([x[2] for x, _ in own]))
    top = levels_of([built[lang][1][-1][0] for lang in order])
    out = []
    for at, lang in enumerate(order):
        rows_, levels = built[lang]
        for k, r in enumerate(rows_):
            steps = siblings(levels, k) + siblings(top, at)
            tampered = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            low = r["text"] and "".join(c.lower() if "A" <= c <= "Z" else c for c in r["text"])
            node = leaf(r, low if tampered else r["text"])
            for before, after in steps:
                node = h(before + node + after)
            out.append((r["doc_id"], leaf(r, r["text"]), levels[-1][0], top[-1][0], h("".join(a + b for a, b in steps)),
                        node, node == top[-1][0]))
    return sorted(out, key=str)


def found(docs):
    tampered = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 0, F.lit(False))
    rows = manifest.tamper_audit(docs, tampered).select(
        "doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("proof")).alias("p"), "folded_root", "verified")
    return sorted([tuple(r) for r in rows.collect()], key=str)


def make(spark, rows):
    return spark.createDataFrame([(i, t, lang, s, n, "x", "y", 7) for i, t, lang, s, n in rows], SCHEMA)


def test_query_matches_the_tree_built_in_one_loop(spark):
    rows = [r.asDict() for r in read_table(spark, SF, "documents").collect()]
    got = sorted([tuple(r) for r in queries.op11_merkle_manifest(spark, SF).collect()], key=str)
    assert got == brute(rows)
    assert 0 < sum(r[-1] for r in got) < len(got)


def test_edges(spark):
    rows = [(1, None, None, None, None), (None, "Null Id", "en", "s", 1), (3, "", "", "s", 0), (3, "", "", "s", 0),
            (3, "Other Text", "", "s", 9), (12, "É Ä ABC \U0001F600", "é", "s", 3), (15, "A" * 200_000, "zz", "", -5),
            *[(7, "same row", "en", "s", 8)] * 20, *[(100 + k, f"Doc {k}", "en", "s", k) for k in range(70)]]
    docs = make(spark, rows)
    assert found(docs) == brute([r.asDict() for r in docs.collect()])


def test_one_row_and_no_row(spark):
    one = make(spark, [(5, "Only", "en", "s", 4)])
    assert found(one) == brute([r.asDict() for r in one.collect()])
    assert found(one)[0][1:4] == (found(one)[0][1],) * 3
    empty = manifest.tamper_audit(make(spark, []), F.lit(True))
    assert empty.collect() == [] and "proof" in empty.columns


@pytest.mark.parametrize("size", [1, 2, 8, 9, 63, 65, 513, 4096, 4097])
def test_octopus_fetches_just_what_cannot_be_derived(size):
    rnd = random.Random(size)
    leaves = [h(str(k)) for k in range(size)]
    levels = levels_of(leaves)
    sizes = manifest.level_sizes(size)
    assert [len(x) for x in levels] == sizes
    for _ in range(5):
        lo = rnd.randrange(size)
        hi = min(size, lo + rnd.randrange(1, 200))
        missing = manifest.missing_nodes(np.arange(lo, hi), sizes)
        fetched = {(level, int(k)): levels[level][k] for level, ks in enumerate(missing) for k in ks}
        befores, afters, firsts, root = manifest.expanded(lo, leaves[lo:hi], sizes, fetched)
        assert root == levels[-1][0]
        for k in range(lo, hi):
            mine = [(befores[i][(k >> 3 * i) - firsts[i]], afters[i][(k >> 3 * i) - firsts[i]]) for i in range(len(firsts))]
            assert mine == siblings(levels, k)
        # minimal: without any one of them some proof cannot be made
        for gone in fetched:
            with pytest.raises(KeyError):
                manifest.expanded(lo, leaves[lo:hi], sizes, {k: v for k, v in fetched.items() if k != gone})


def test_leaf_partitions_anywhere_in_the_tree_give_the_same_roots(spark, monkeypatch):
    # partitions of five leaves, two levels a round: many partitions and several rounds of merging
    docs = make(spark, [(k, f"text {k}", "en" if k % 3 else "de", "s", k) for k in range(700)])
    expected = brute([r.asDict() for r in docs.collect()])
    monkeypatch.setattr(manifest, "CHUNK", 5)
    monkeypatch.setattr(manifest, "STEP", 2)
    assert found(docs) == expected
