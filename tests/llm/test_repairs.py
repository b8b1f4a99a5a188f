"""Rows that share an id, short benchmark items, many matches in one text."""

import hashlib
import time

import numpy as np
import pyarrow as pa

from pyspark.sql import functions as F

from ledgerflow.llm import decontaminate, fmindex, neardup, packing, pii, substring

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def docs_of(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", 0) for d, t in rows], DOCS)


def brute_removal(rows, window=50):
    """Sorted (doc_id, n_words, n_removed, kept digest) by one table of all windows."""
    first = {}
    for d, t in rows:
        w = t.split()
        for k in range(len(w) - window + 1):
            key = tuple(w[k:k + window])
            first[key] = min(first.get(key, d), d)
    out = []
    for d, t in rows:
        w = t.split()
        gone = {j for k in range(len(w) - window + 1) if first[tuple(w[k:k + window])] < d for j in range(k, k + window)}
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def test_rows_that_share_an_id_are_judged_by_their_own_text(spark):
    a, b = (" ".join(f"{x}{k}" for k in range(60)) for x in "ab")
    c = " ".join(f"c{k}" for k in range(200))
    rows = [(0, b), (1, a), (1, b), (5, a), (7, c), (7, a + " " + c), (9, c), (9, c), (9, "x " + c)]
    got = sorted(tuple(r) for r in substring.removal_digest(docs_of(spark, rows)).collect())
    assert got == brute_removal(rows)
    assert (1, 60, 0, hashlib.sha256(a.encode()).hexdigest()) in got


def test_hot_grams_with_shared_ids(spark, monkeypatch):
    monkeypatch.setattr(substring, "HOT_ENTRIES", 3)
    passage = " ".join(f"p{k}" for k in range(55))
    rows = [(k % 7, f"l{k} " * (k % 5) + passage + f" r{k}" * (k % 4)) for k in range(30)]
    assert sorted(tuple(r) for r in substring.removal_digest(docs_of(spark, rows)).collect()) == brute_removal(rows)


def leaks(spark, texts, items):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs_of(spark, list(enumerate(texts))), bench).collect()}


def test_items_of_one_to_three_words_are_found_whole(spark):
    items = ["what is photosynthesis", "Define osmosis", "Entropy?", "", "Name 3 rivers", "...", None]
    texts = ["They asked: what is photosynthesis, then left.", "Define osmosis", "define  osmosis!", "Define an osmosis",
             "osmosis define", "all about entropy here", "what is photosynthesiss", "Name 3 rivers", "Name 4 rivers", "", None]
    assert leaks(spark, texts, items) == {(0, 0), (1, 1), (2, 1), (5, 2), (7, 4)}


def test_many_matches_in_one_text_take_seconds(spark):
    many = 100_000
    text = "é " + " ".join(f"u{k}@example.org" for k in range(many)) + " call +1 (555) 010-9999"
    docs = docs_of(spark, [(1, text), (2, "none"), (3, "a@b.cc")])
    began = time.time()
    found = {r["doc_id"]: r for r in pii.span_digest(pii.find_personal_data(docs)).collect()}
    assert time.time() - began < 60
    assert found[1]["n_email"] == many and found[1]["n_phone"] == 1 and found[2]["spans"] == ""
    assert found[3]["spans"] == "email:0:6"
    spans, at = [], 2
    for k in range(many):
        size = len(f"u{k}@example.org")
        spans.append(f"email:{at}:{at + size}")
        at += size + 1
    assert found[1]["spans"].startswith(",".join(spans))


def test_the_pipeline_keeps_columns_that_its_operators_add_too(spark):
    import corpus_pipeline
    names = ("score", "lang_pred", "n_lines", "n_removed", "kept", "component_id", "coverage", "leaf")
    texts = {1: "the house is old and the garden is green\nsecond line", 2: "le jardin est vert et la maison est vieille"}
    docs = spark.createDataFrame([(d, t, "en" if d == 1 else "fr", "s", 0, *[float(d * k) for k in range(8)])
                                  for d, t in texts.items()], DOCS + "".join(f", {n} double" for n in names))
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, "/root/testdata/sf0.001")
        rows = {r["doc_id"]: r for r in docs.collect()}
        assert list(docs.columns[5:]) == list(names), name
        assert all([rows[d][n] for n in names] == [float(d * k) for k in range(8)] for d in texts), name


def test_the_token_memory_forgets_without_changing_ids():
    import public_tokenizers
    path = public_tokenizers.path(packing.VOCABULARY)
    small, large = packing.TokenMemory(path, limit=20), packing.TokenMemory(path)
    texts = [" ".join(f"Wort{k % n}st, é{k}" for k in range(200)).encode() for n in (3, 7, 50)]
    assert small.of(texts) == large.of(texts) == small.of(texts)
    assert len(small) + len(small.older) <= 22


def brute_components(rows):
    """{doc_id: smallest id reachable} by comparing all sets; rows of one id are one document."""
    sets = []
    for d, t in rows:
        w = (t or "").lower().split()
        n = min(5, len(w))
        sets.append({tuple(w[k:k + n]) for k in range(len(w) - n + 1)} if w else set())
    label = {d: d for d, _ in rows}
    changed = True
    while changed:
        changed = False
        for i, (a, _) in enumerate(rows):
            for j, (b, _) in enumerate(rows[:i]):
                common = len(sets[i] & sets[j])
                if label[a] != label[b] and sets[i] and 100 * common >= 75 * len(sets[i] | sets[j]):
                    low, high = sorted((label[a], label[b]))
                    label = {d: low if x == high else x for d, x in label.items()}
                    changed = True
    return label


def test_near_duplicates_of_rows_that_share_an_id(spark):
    a, b, c = (" ".join(f"{x}{k}" for k in range(60)) for x in "abc")
    rows = [(1, a), (1, b), (2, a + " x"), (3, b + " y"), (4, c), (4, c), (5, "z " + c), (6, b), (9, ""), (9, None),
            (7, "one two"), (8, "one two"), (8, "three")]
    got = neardup.near_duplicates(docs_of(spark, rows)).collect()
    expected = brute_components(rows)
    assert len(got) == len(rows)
    assert {r["doc_id"]: r["component_id"] for r in got} == expected
    assert expected[2] == expected[3] == expected[6] == 1 and expected[8] == 7
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)


def test_packing_searches_on_while_better_groupings_come_up(monkeypatch):
    rng = np.random.default_rng(3)
    lengths = sorted(np.clip(np.exp(rng.normal(5.5, 1.0, 800)), 1, 2047).astype(int).tolist(), reverse=True)
    made, cross = [], packing.crossover
    monkeypatch.setattr(packing, "crossover", lambda *a: made.append(cross(*a)) or made[-1])
    packing.evolve([1100] * 50, 2048, 0, [])  # fifty bins cannot become fewer, nor reach the sum's bound
    assert len(made) == packing.STALE_GENERATIONS and packing.POPULATION >= 10
    best = packing.evolve(lengths, 2048, 0, [])
    assert sorted(i for b in best.bins for i in b) == list(range(800))


def test_substring_batches_are_read_in_steps():
    batch = pa.RecordBatch.from_arrays([pa.array(range(600))], ["n"])
    parts = list(substring._steps(iter([batch])))
    assert [p.num_rows for p in parts] == [256, 256, 88]
    assert [n for p in parts for n in p.column(0).to_pylist()] == list(range(600))


def test_one_long_query_does_not_widen_the_others(monkeypatch):
    rng = np.random.default_rng(5)
    docs = [rng.integers(1, 4, n) for n in (60, 7, 900, 55, 1, 64)]
    index = fmindex.FMIndex(docs, 5, 4)
    together = index._streamed(docs)
    monkeypatch.setattr(fmindex, "SEARCH_CELLS", 130)
    assert list(fmindex.alike([len(d) for d in docs], 130)) == [[4, 1], [3, 0], [5], [2]]
    for one, other in zip(index.matching_statistics(docs), together):
        assert (one[0] == other[0]).all() and (one[1] == other[1]).all()
