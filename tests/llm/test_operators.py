"""Operators on small fixtures against brute force, round trips and defined edge cases."""

import hashlib
import re
import zlib
from array import array

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerflow.llm import (ann, common, decontaminate, fmindex, htmltext, langid, licenses, linededup, neardup, oracle,
                            packing, pii, queries, substring)
from ledgerflow.llm.common import gram_hashes, read_table, sliding_min

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, spans string"


def docs_of(spark, texts, langs=None, sources=None):
    rows = [(i, t, (langs or ["en"] * len(texts))[i], (sources or ["s"] * len(texts))[i], len(t or ""), 0.5, "x")
            for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in read_table(spark, SF, "documents").select("doc_id", "text").collect()}


EDGES = [None, "", "   ", "one", "one", "a b c d e f", "x " * 30_000, "\n\n", "ß é 漢字 \U0001F600"]


def test_gram_hashes_and_sliding_min_match_loops():
    h = np.random.default_rng(0).integers(0, 1 << 63, 40, dtype=np.uint64)
    for n in (1, 2, 3, 7, 10, 40):
        g = gram_hashes(h, n)
        assert len(g) == 41 - n
        assert len(set(g.tolist())) == len(g)
        at = min(5, 40 - n)
        assert gram_hashes(h[at:at + n], n)[0] == g[at]
        assert sliding_min(h, n).tolist() == [min(h[k:k + n].tolist()) for k in range(41 - n)]
    assert len(gram_hashes(h, 41)) == 0


# -- op1 ---------------------------------------------------------------------------

def check_packing(rows, expected):
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert set(by_doc) == set(expected)
    for d, ids in expected.items():
        pieces = sorted(by_doc[d], key=lambda r: r["piece"])
        assert [p["start"] for p in pieces] == list(range(0, len(ids), 2048))
        for p in pieces:
            part = ids[p["start"]:p["start"] + 2048]
            assert p["length"] == len(part)
            assert p["ids_crc32"] == zlib.crc32(array("I", part).tobytes())
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(map(len, expected.values()))
    assert len(sequences) <= -(-total // 2048) * 1.01 + 2


def test_packing_matches_the_tokenizer(spark, texts):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {d: t.encode(x or "", add_special_tokens=False).ids + [0] for d, x in texts.items()}
    check_packing(queries.op1_best_fit_packing(spark, SF).collect(), expected)


def test_packing_edges_and_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    hard = EDGES + ["İ. ΣΑΣ <|endoftext|> <|ENDOFTEXT|> Don't can't! ３４ café. ﬁ ½"]
    docs = docs_of(spark, hard)
    expected = {i: t.encode(x or "", add_special_tokens=False).ids + [0] for i, x in enumerate(hard)}
    places = packing.pack_documents(docs)
    check_packing(places.collect(), expected)
    whole = packing.sequences(docs, places).collect()
    assert sum(len(r["ids"]) // 4 for r in whole) == sum(map(len, expected.values()))
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_crossover_keeps_every_item_once():
    rng = np.random.default_rng(1)
    lengths = rng.integers(1, 900, 300).tolist()
    start = []
    for k in range(2):
        b = packing.Bins(lengths, 1000)
        b.best_fit(rng.permutation(300).tolist())
        start.append(b)
    child = packing.crossover(start[0], start[1], 0.3, rng)
    assert sorted(i for items in child.bins for i in items) == list(range(300))
    assert all(sum(lengths[i] for i in items) + room == 1000 for items, room in zip(child.bins, child.room))


# -- op2 ---------------------------------------------------------------------------

def test_language_held_out_accuracy(spark):
    rows = queries.op2_language_id(spark, "/root/testdata/sf0.01").join(
        read_table(spark, "/root/testdata/sf0.01", "documents").select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if r["held_out"]]
    assert len(rows) == 1000 and all(0 <= r["score"] <= 1 for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) > 0.97


def test_language_edges(spark):
    docs = docs_of(spark, EDGES + ["12 34 !!"], ["en", None] * 5)
    out = {r["doc_id"]: r["lang_pred"] for r in langid.identify_language(docs).collect()}
    assert out[0] == out[1] == out[2] == out[9] == "und" and len(out) == 10
    empty = langid.identify_language(docs.limit(0))
    assert empty.count() == 0
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r["lang_pred"] for r in langid.identify_language(unlabelled).collect()} == {"und"}


# -- op3 ---------------------------------------------------------------------------

def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_spans(text):
    digits = lambda m: re.sub("[^0-9]", "", m.group())
    out = [(m.start(), 0, "email", m.end()) for m in
           re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text)
            if all(int(p) <= 255 for p in m.group().split("."))]
    out += [(m.start(), 2, "card", m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text)
            if 14 <= len(digits(m)) <= 19 and luhn(digits(m))]
    out += [(m.start(), 3, "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
            if 10 <= len(digits(m)) <= 15]
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in sorted(out))


def test_personal_data_matches_brute_force(spark, texts):
    hard = EDGES + ["a@b.c_d@e.f é \U0001F600 x@y.zz 1.2.3.4.5.6.7.8 256.1.1.1 0010.1.1.001", "4111 1111 1111 1111 +1 (555) 123-4567.",
                    "1" * 20_000, "a." * 20_000 + "@", "q@" + "a." * 20_000 + "b", "+1" + " " * 5000, "1.2" * 3000, "5-" * 9000 + "5"]
    found = pii.span_digest(pii.find_personal_data(docs_of(spark, hard))).collect()
    assert len(found) == len(hard)
    for r in found:
        assert r["base_sha256"] == hashlib.sha256(base_spans(hard[r["doc_id"]] or "").encode()).hexdigest()
    for r in queries.op3_personal_data(spark, SF).collect():
        assert r["base_sha256"] == hashlib.sha256(base_spans(texts[r["doc_id"]] or "").encode()).hexdigest()


def test_personal_data_checksums_context_and_redaction(spark):
    docs = docs_of(spark, ["pay to IBAN GB82 WEST 1234 5698 7654 32 now", "GB82 WEST 1234 5698 7654 33",
                           "my ssn 123-45-6789", "part 123-45-6789", "mail a@b.cc or 1.2.3.4"])
    found = pii.find_personal_data(docs)
    spans = {r["doc_id"]: r["spans"] for r in pii.span_digest(found).collect()}
    assert "iban:12:39" in spans[0] and "iban" not in spans[1]
    assert "ssn:7:18" in spans[2] and "ssn" not in spans[3]
    assert {r["doc_id"]: r["text"] for r in pii.redact(found).collect()}[4] == "mail <email> or <ip>"


# -- op4 ---------------------------------------------------------------------------

def windows_removed(rows, size=50):
    seen, out = {}, {}
    for i, text in sorted(rows.items()):
        words = (text or "").encode().split()
        gone = set()
        for k in range(len(words) - size + 1):
            body = tuple(words[k:k + size])
            if seen.setdefault(body, i) < i:
                gone.update(range(k, k + size))
        kept = [w for k, w in enumerate(words) if k not in gone]
        out[i] = (len(words), len(gone), hashlib.sha256(b" ".join(kept)).hexdigest())
    return out


def substring_rows():
    rng = np.random.default_rng(3)
    word = lambda n: [f"w{k}" for k in rng.integers(0, 500, n)]
    shared, base = word(80), word(300)
    rows = [" ".join(word(30) + shared + word(25)) for _ in range(12)]
    rows += [" ".join(base), " ".join(base), " ".join(base[:150] + ["changed"] + base[150:])]
    return rows + EDGES + ["x " * 120, " ".join(shared[:49]), " ".join(shared[:50])]


@pytest.mark.parametrize("hot", [1500, 2])
def test_substring_matches_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(substring, "HOT_ENTRIES", hot)
    rows = substring_rows()
    expected = windows_removed(dict(enumerate(rows)))
    got = substring.remove_repeated_windows(docs_of(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == expected
    assert substring.removal_digest(docs_of(spark, rows).limit(0)).count() == 0


def test_substring_equal_hot_windows_go_to_a_shard_once(spark, monkeypatch):
    monkeypatch.setattr(substring, "HOT_ENTRIES", 2)
    given, search = [], substring.search_shards

    def counted(texts, shards, window):
        given.append((texts.count(), texts.select("words").distinct().count()))
        return search(texts, shards, window)

    monkeypatch.setattr(substring, "search_shards", counted)
    rows = substring_rows()
    expected = windows_removed(dict(enumerate(rows)))
    got = substring.remove_repeated_windows(docs_of(spark, rows)).collect()
    assert {r["doc_id"]: (r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got} == expected
    assert len(given) == 2 and given[1][0] == given[1][1] > 0


def test_fm_index_counts_like_a_scan():
    rng = np.random.default_rng(5)
    docs = [rng.integers(1, 4, n).astype(np.int64) for n in (30, 12, 5, 40)]
    depth = 6
    index = fmindex.FMIndex(docs, depth, 5)
    least = index.class_minimum(np.arange(len(docs)))
    for q, (lengths, classes) in zip(docs, index.matching_statistics(docs)):
        for at in range(len(q)):
            assert lengths[at] == min(depth, len(q) - at)
            if lengths[at] == depth:
                body = q[at:at + depth].tolist()
                first = min(d for d, x in enumerate(docs) for k in range(len(x)) if x[k:k + depth].tolist() == body)
                assert least[classes[at]] == first


# -- op5 ---------------------------------------------------------------------------

def test_neighbours_recall_and_edges(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL_ROWS", 60)
    rows = queries.op5_nearest_neighbours(spark, SF).collect()
    vectors = {r["vec_id"]: np.array(r["embedding"], float) for r in read_table(spark, SF, "embeddings").collect()}
    ids = np.array(sorted(vectors))
    units = np.array([vectors[i] / np.linalg.norm(vectors[i]) for i in ids])
    hits = total = 0
    for q in ids[ids % 50 == 0]:
        s = units @ units[ids == q][0]
        s[ids == q] = -2
        best = set(ids[np.lexsort((ids, -s))[:5]].tolist())
        mine = sorted((r for r in rows if r["query_id"] == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in mine] == [1, 2, 3, 4, 5]
        hits, total = hits + len(best & {r["vec_id"] for r in mine}), total + 5
    assert hits / total >= 0.9
    data = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [0.0, 0.0]), (3, None), (4, [float("nan"), 1.0]), (5, [2.0, 0.0]),
            (6, [0.0, 1.0]), (7, [None, 1.0])]
    odd = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    found = ann.nearest_neighbours(odd, odd.filter("vec_id in (0, 2, 3)")).orderBy("rank").collect()
    assert [(r["query_id"], r["vec_id"]) for r in found] == [(0, 1), (0, 5), (0, 6)]
    assert ann.nearest_neighbours(odd.limit(0), odd).count() == 0


# -- op6, op9: the SQL compares whole results; edges here -----------------------------

def test_license_edges_and_inheritance(spark):
    rows = [("a/LICENSE", "Released under the MIT License."), ("a/b/x.py", "code"), ("a/b/LICENSE.txt", "Licensed under CC BY-NC 4.0."),
            ("a/b/c/y.py", None), ("z.py", ""), (None, "This work is licensed under the GNU General Public License, version 3."),
            ("a/q.py", "Licensed under the Apache License, Version 2.0.\ncode")]
    files = spark.createDataFrame([(i, p, t, "s") for i, (p, t) in enumerate(rows)], "doc_id long, path string, text string, license string")
    got = {r["doc_id"]: (r["license"], r["via"]) for r in licenses.scan_licenses(files).collect()}
    assert got == {0: ("mit", "header"), 1: ("cc-by-nc-4.0", "inherited"), 2: ("cc-by-nc-4.0", "header"),
                   3: ("cc-by-nc-4.0", "inherited"), 4: (None, "none"), 5: ("gpl-3.0", "header"), 6: ("apache-2.0", "header")}
    assert licenses.scan_licenses(files.limit(0)).count() == 0


def test_spread_join_equals_a_join(spark, monkeypatch):
    monkeypatch.setattr(common, "HOT_ROWS", 10)
    rows = spark.createDataFrame([(i, None if i % 7 == 0 else i % 3 if i % 2 else 0) for i in range(200)],
                                 "id long, k long")
    table = spark.createDataFrame([(0, "a"), (1, "b"), (9, "z")], "k long, v string")
    hot = common.hot_keys(rows.filter("k is not null").groupBy("k").agg(F.count("*").alias("n")), ["k"], "n")
    assert hot.agg(F.max("parts")).first()[0] > 5
    for how in ("inner", "left"):
        got = common.spread_join(rows, table, hot, ["k"], F.col("id"), how).select("id", "k", "v")
        want = rows.join(table, "k", how).select("id", "k", "v")
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))


def test_line_dedup_counts_sites_and_different_texts(spark):
    rows = [f"own line {i}\nthe footer \nsecond own line {i}" for i in range(12)] + ["the footer"] + EDGES
    rows += ["one text\non many sites"] * 30 + [f"few {i}\nnine sites" for i in range(40)]
    sources = [f"s{i}" for i in range(12)] + ["s0"] + [None] * len(EDGES) + [f"s{i}" for i in range(30)]
    sources += [f"s{i % 9}" for i in range(40)]
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in
           linededup.remove_common_lines(docs_of(spark, rows, None, sources)).collect()}
    assert got[3] == ("own line 3\nsecond own line 3", 1)
    assert got[12] == ("", 1)
    assert all(got[k] == (rows[k], 0) for k in range(13, len(rows)))


# -- op7 ---------------------------------------------------------------------------

def test_leaks_plain_reparameterised_and_inconsistent(spark):
    item = "Tom buys 12 apples for 3 dollars each and then gives 12 apples to a friend who lives next door"
    changed = "so Tom buys 40 apples for 7 dollars each and then gives 40 apples to a friend who lives next door today"
    broken = "so Tom buys 40 apples for 7 dollars each and then gives 41 apples to a friend who lives next door today"
    docs = docs_of(spark, [f"before it {item} after", changed, broken, "nothing of the kind at all"] + EDGES)
    bench = spark.createDataFrame([(7, item), (8, None), (9, ""), (10, "two words")], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["reparameterised"] for r in decontaminate.find_leaks(docs, bench).collect()}
    assert got == {(0, 7): False, (1, 7): True}
    kept = {r["doc_id"] for r in decontaminate.remove_leaks(docs, bench).collect()}
    assert kept == set(range(2, 4 + len(EDGES)))
    assert decontaminate.find_leaks(docs, bench.limit(0)).count() == 0


def leaks_of(spark, texts, items):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    return {(r["doc_id"], r["item_id"]) for r in decontaminate.find_leaks(docs_of(spark, texts), bench).collect()}


def test_leaks_survive_a_broken_copy(spark):
    long = [f"word{chr(97 + k // 26)}{chr(97 + k % 26)}" for k in range(40)]
    items = [long[:15], long, long[:9]]
    rows = []
    for n, item in enumerate(items):
        for k in range(1, len(item)):
            for broken in (item[:k] + ["odd"] + item[k:], item[:k] + item[k + 1:]):
                rows.append((n, " ".join(["before", "it"] + broken + ["after"])))
    rows += [(1, " ".join(long[:20])), (1, " ".join(long[20:]))]
    got = leaks_of(spark, [t for _, t in rows], [" ".join(x) for x in items])
    assert {(d, n) for d, (n, _) in enumerate(rows)} <= got
    assert leaks_of(spark, ["x " + " ".join(long[:8]) + " y", " ".join(long[k] for k in range(0, 40, 2))],
                    [" ".join(long)]) == set()


def test_leaks_short_and_numeric_items(spark):
    items = ["What is the capital of France?", "What is 17 + 25 ?", "Calculate the square root of 81 now please Sir"]
    rows = ["Quiz\nWhat is the capital of France?", "so What is the capital of France?", "answer: What is 17 + 25 ?",
            "what is 18 + 25 ?", "Quiz Calculate the square root of 81 now please Sir", "what is the capital gain"]
    assert leaks_of(spark, rows, items) == {(0, 0), (1, 0), (2, 1), (4, 2)}


def test_leaks_with_other_names_and_longer_values(spark):
    items = ["Alice has 3 apples. Bob has 4 apples. How many do they have?",
             "The old train to Paris leaves with 12 guests and comes back from Paris without 12 guests"]
    rows = ["Carol has 5 apples. Dave has 6 apples. How many do they have?",
            "Carol has 5 apples. Dave has 5 apples. How many do they have?",
            "The old train to New York leaves with twenty five guests and comes back from New York without twenty five guests",
            "The old train to Rome leaves with 12 guests and comes back from Oslo without 13 guests"]
    assert leaks_of(spark, rows, items) == {(0, 0), (1, 0), (2, 1)}


def test_leaks_hold_every_contained_item(spark, texts):
    items = {r["item_id"]: r["text"] for r in read_table(spark, SF, "benchmark").collect()}
    expected = {(d, i) for d, t in texts.items() for i, b in items.items() if t and b in t}
    got = {(r["doc_id"], r["item_id"]) for r in queries.op7_decontamination(spark, SF).collect()}
    assert got == expected


# -- op8 ---------------------------------------------------------------------------

def test_sketch_differences_count_values(spark):
    rng = np.random.default_rng(5)
    x, y = (rng.integers(0, 16, neardup.SKETCH).astype(np.uint8) for _ in range(2))
    y[::3] = x[::3]
    row = spark.createDataFrame([(neardup.bit_planes(x).tolist(), neardup.bit_planes(y).tolist())],
                                "x array<long>, y array<long>")
    assert row.select(neardup.sketch_differences("x", "y")).first()[0] == int((x != y).sum())


def test_near_duplicates_edges(spark):
    base = [f"w{k}" for k in range(200)]
    rows = [" ".join(base), " ".join(base).upper(), " ".join(base[:100] + ["new"] + base[100:]), " ".join(base[:100])] + EDGES
    got = {r["doc_id"]: r for r in neardup.near_duplicates(docs_of(spark, rows)).collect()}
    assert [got[i]["component_id"] for i in range(4)] == [0, 0, 0, 3]
    assert got[4]["n_shingles"] == got[5]["n_shingles"] == 0 and got[5]["kept"]
    assert got[7]["component_id"] == got[8]["component_id"] == 7 and got[7]["n_shingles"] == 1
    kept = neardup.keep_one_each(docs_of(spark, rows))
    assert kept.columns == DOCS.replace(" string", "").replace(" long", "").replace(" double", "").split(", ")
    assert kept.count() == sum(r["kept"] for r in got.values())


# -- op10 --------------------------------------------------------------------------

def test_html_text(spark):
    page = ("<html><head><title>t</title></head><body><nav><a>menu</a></nav><article><h1>Head &amp; co</h1><p><b>One\n two<br>"
            "<p>Three</p><div class='comments'><p>reader</p></div></article><footer>foot</footer>")
    assert htmltext.main_text(page) == "Head & co\nOne two\nThree"
    plain = "<body><ul><li><a>x</a></li></ul><p>" + "long text " * 20 + "</p><p>" + "more text " * 20 + "</p></body>"
    assert htmltext.main_text(plain).count("text") == 40
    rows = [(0, "u", None), (1, "u", ""), (2, None, page), (2, None, page), (3, "u", "<p"), (4, "u", "<div" * 2000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string")
    got = htmltext.extract_text(df).collect()
    assert [r["n_chars"] for r in got] == [0, 0, len(htmltext.main_text(page)), len(htmltext.main_text(page)), 0, got[5]["n_chars"]]


# -- the queries against SQL, and the pipeline ---------------------------------------

@pytest.mark.parametrize("name", sorted(oracle.ORACLE_SQL))
def test_query_matches_sql(spark, name):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    df = queries.QUERIES[name](spark, SF)
    rel = con.sql(oracle.ORACLE_SQL[name])
    assert sorted(df.columns) == sorted(rel.columns)
    order = rel.columns
    assert sorted(map(str, (tuple(r[c] for c in order) for r in df.collect()))) == sorted(map(str, rel.fetchall()))


def test_pipeline_equals_its_stages(spark, texts):
    docs = read_table(spark, SF, "documents")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"], name
    left = {r["doc_id"] for r in docs.select("doc_id").collect()}
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r["doc_id"] for r in out} == left
    assert 0 < len(left) < len(texts)
