"""Removal of word windows that also start in an earlier document, by FM-indexes.

Every window of 50 words is routed by the smallest hash of its ten-word grams, a function of
its content: equal windows always meet. Neighbouring windows with the same smallest gram form
one segment. Segments of equal content are pre-aggregated to one entry with its smallest document;
entries whose gram occurs in one document only are done. The words of one instance of each other
entry go to shards, each of which builds an FM-index and streams its segments over it: backward
search over the wavelet matrix gives the matching statistics, and where 50 words match, the
smallest document among the matches. An instance loses the windows whose smallest document is
smaller than its own.

A gram with more than ``HOT_ENTRIES`` different segments would outgrow a shard. The windows of
its segments are re-routed one by one by their whole content, into shards of bounded size, and
searched there in the same way.

Defined cases: null texts have no words; documents shorter than a window lose nothing; texts
of any length are read whole; rows that share an id are one document with regard to order, and
none removes words of the other, each is judged by its own text; a null id neither removes nor loses words; an empty
table gives an empty table; extra columns are kept out.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import gram_hashes, hot_keys, mixed, sliding_min, spread_join, stash, word_hashes
from ledgerflow.llm.fmindex import FMIndex

WINDOW = 50
GRAM = 10
# Words that a shard's index holds, and entries of one gram that may share a shard.
SHARD_WORDS = 200_000
HOT_ENTRIES = 1500
# Documents whose words a task holds at a time.
DOCS_A_STEP = 256


def cut_segments(words: list[bytes], window: int = WINDOW, gram: int = GRAM):
    """(start, windows, route, content key) of each segment of a document."""
    n = len(words) - window + 1
    if n < 1:
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty
    h = word_hashes().of(words)
    smallest = sliding_min(mixed(gram_hashes(h, gram)), window - gram + 1)
    start = np.flatnonzero(np.concatenate(([True], smallest[1:] != smallest[:-1])))
    count = np.diff(np.append(start, n))
    # Prefix sums of a polynomial hash give each segment's key in one step (multiplication is odd).
    powers = np.full(len(h) + 1, np.uint64(0xD6E8FEB86659FD93))
    powers[0] = 1
    powers = np.cumprod(powers)
    prefix = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mixed(h, 3) * powers[:-1])))
    end = start + count + window - 1
    inverse = np.full(len(h) + 1, np.uint64(pow(0xD6E8FEB86659FD93, -1, 1 << 64)))
    inverse[0] = 1
    key = mixed((prefix[end] - prefix[start]) * np.cumprod(inverse)[start] + count.astype(np.uint64), 4)
    return start, count, smallest[start].view(np.int64), key.view(np.int64)


def _words(texts) -> list[list[bytes]]:
    return [t.split() if t else [] for t in texts.cast(pa.binary()).to_pylist()]


def _steps(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches in slices of a few documents: words as Python objects take many times their text's memory."""
    for batch in batches:
        for k in range(0, batch.num_rows, DOCS_A_STEP):
            yield batch.slice(k, DOCS_A_STEP)


def segments(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, start, windows, route, content) of every segment of whole documents."""
    names = ["doc_id", "text_key", "start", "windows", "route", "content"]

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _steps(batches):
            ids, keys, parts = [], [], []
            for doc, words, key in zip(batch.column(0).to_pylist(), _words(batch.column(1)), batch.column(2).to_pylist()):
                part = cut_segments(words, window)
                if len(part[0]):
                    ids.append(np.full(len(part[0]), doc))
                    keys.append(np.full(len(part[0]), key))
                    parts.append(part)
            if parts:
                columns = [np.concatenate(c) for c in zip(*parts)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(ids)), pa.array(np.concatenate(keys)), pa.array(columns[0].astype(np.int32)),
                     pa.array(columns[1].astype(np.int32)), pa.array(columns[2]), pa.array(columns[3])], names)

    return docs.filter("doc_id is not null and text is not null").select("doc_id", "text", "text_key").mapInArrow(
        scan, "doc_id long, text_key long, start int, windows int, route long, content long")


def segment_texts(docs: DataFrame, wanted: DataFrame, window: int) -> DataFrame:
    """Words of the wanted segments (doc_id, text_key, parts: route, content, start, windows, single).

    ``single``: each window on its own, routed and keyed by its whole content.
    """
    names = ["single", "route", "content", "at", "doc_id", "words"]
    types = [pa.bool_(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.binary()]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _steps(batches):
            rows = []
            for doc, words, parts in zip(batch.column(0).to_pylist(), _words(batch.column(1)),
                                         batch.column(2).to_pylist()):
                for p in parts:
                    s, n = p["start"], p["windows"]
                    piece = words[s:s + n + window - 1]
                    if p["single"]:
                        whole = mixed(gram_hashes(word_hashes().of(piece), window), 5).view(np.int64).tolist()
                        rows += [(True, whole[k], p["content"], k, doc, b" ".join(piece[k:k + window]))
                                 for k in range(n)]
                    else:
                        rows.append((False, p["route"], p["content"], 0, doc, b" ".join(piece)))
                    if len(rows) >= 4096:
                        yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows), types)), names)
                        rows = []
            if rows:
                yield pa.RecordBatch.from_arrays(list(map(pa.array, zip(*rows), types)), names)

    return docs.join(wanted, ["doc_id", "text_key"]).select("doc_id", "text", "parts").mapInArrow(
        read, "single boolean, route long, content long, at int, doc_id long, words binary")


def search_shards(texts: DataFrame, shards: int, window: int) -> DataFrame:
    """(route, content, at, runs): per segment the runs of windows with one smallest document."""
    def search(rows: pd.DataFrame) -> pd.DataFrame:
        number: dict[bytes, int] = {}
        documents = []
        for text in rows["words"]:
            documents.append(np.array([number.setdefault(w, len(number) + 1) for w in text.split()], np.int64))
        index = FMIndex(documents, window, len(number) + 1)
        smallest = index.class_minimum(rows["doc_id"].to_numpy())
        runs = []
        for length, cls in index.matching_statistics(documents):
            full = np.flatnonzero(length >= window)
            m = smallest[cls[full]]
            cut = np.flatnonzero(np.concatenate(([True], (m[1:] != m[:-1]) | (np.diff(full) != 1))))
            ends = np.append(cut[1:], len(full)) - 1
            runs.append([{"from": int(full[a]), "to": int(full[b]) + 1, "doc": int(m[a])} for a, b in zip(cut, ends)])
        return pd.DataFrame({"route": rows["route"], "content": rows["content"], "at": rows["at"], "runs": runs})

    return (texts.withColumn("shard", F.pmod(F.xxhash64("route"), F.lit(shards)))
            .groupBy("shard").applyInPandas(
                search, "route long, content long, at int, runs array<struct<from:int,to:int,doc:long>>"))


def repeated_intervals(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, text_key, spans): word intervals [from, to) of each text that an earlier document repeats.

    ``docs`` has doc_id, text and text_key: a row is known by its id and key.
    """
    found = stash(segments(docs, window), "substring-segments")
    entries = stash(found.groupBy("route", "content").agg(
        F.min(F.struct("doc_id", "text_key", "start", "windows")).alias("first"), F.max("doc_id").alias("last")), "substring-entries")
    routes = (entries.groupBy("route").agg(F.min("first.doc_id").alias("lo"), F.max("last").alias("hi"),
                                           F.count(F.lit(1)).alias("n")).filter("lo < hi").select("route", "n"))
    wanted = stash(entries.join(routes, "route").select("route", "content", "first.*", "n"), "substring-wanted")
    hot = F.col("n") > HOT_ENTRIES
    sizes = wanted.agg(F.sum(F.when(~hot, F.col("windows") + window - 1)).alias("cold"),
                       F.max(hot).alias("hot")).first()
    # The whole texts are shuffled once, for the segments and the single windows together.
    part = F.struct("route", "content", "start", "windows", hot.alias("single"))
    asked = wanted.groupBy("doc_id", "text_key").agg(F.collect_list(part).alias("parts"))
    texts = segment_texts(docs, asked, window)
    if sizes["hot"]:
        texts = stash(texts, "substring-texts")
    runs = search_shards(texts.filter("not single"), max(1, math.ceil((sizes["cold"] or 0) / SHARD_WORDS)), window)

    def searched_windows(texts: DataFrame) -> DataFrame:
        """Of equal windows one goes to a shard, with their smallest document."""
        key = ["route", "second"]
        one = stash(texts.groupBy(*key).agg(F.min(F.struct("doc_id", "words")).alias("one"), F.count(F.lit(1)).alias("n"))
                    .select(*key, "one.*", "n"), "substring-distinct")
        # ``content`` is the second half of the key here.
        runs = search_shards(one.select("route", F.col("second").alias("content"), F.lit(0).alias("at"), "doc_id", "words"),
                             max(1, math.ceil(one.count() * window / SHARD_WORDS)), window)
        runs = runs.select("route", F.col("content").alias("second"), "runs")
        places = texts.select(*key, "content", "at")
        return spread_join(places, runs, hot_keys(one, key, "n"), key, F.struct("content", "at")).select(
            "route", "content", "at", "runs")

    if sizes["hot"]:
        runs = runs.unionByName(searched_windows(texts.filter("single").withColumn("second", F.xxhash64("words"))))
    runs = stash(runs.select("content", "at", "runs"), "substring-runs")
    lost = F.filter("runs", lambda r: r["doc"] < F.col("doc_id"))
    spans = F.transform(lost, lambda r: F.struct((F.col("start") + F.col("at") + r["from"]).alias("from"),
                                                 (F.col("start") + F.col("at") + r["to"] + (window - 1)).alias("to")))
    return (found.select("doc_id", "text_key", "start", "content").join(runs, "content")
            .select("doc_id", "text_key", spans.alias("spans")).filter(F.size("spans") > 0)
            .groupBy("doc_id", "text_key").agg(F.flatten(F.collect_list("spans")).alias("spans")))


def remove_repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                            window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept, kept_sha256) of every document; ``kept`` is the text that stays."""
    return _removed(docs, id_col, text_col, window, True)


def removal_digest(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256): as ``remove_repeated_windows``, without the texts."""
    return _removed(docs, id_col, text_col, window, False)


def _removed(docs: DataFrame, id_col: str, text_col: str, window: int, with_text: bool) -> DataFrame:
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # Where ids repeat, a row is known by its id and a hash of its text, else by its id alone.
    unique = docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty()
    docs = docs.withColumn("text_key", F.lit(0).cast("long") if unique else F.xxhash64("text"))
    spans = repeated_intervals(docs, window).withColumnsRenamed({"doc_id": "hit", "text_key": "hit_key"})
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept"] * with_text

    def drop(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _steps(batches):
            totals, gone, digests, kept = [], [], [], []
            for words, hits in zip(_words(batch.column(1)), batch.column(2).to_pylist()):
                n = len(words)
                if hits:
                    edge = np.zeros(n + 1, np.int64)
                    np.add.at(edge, [min(h["from"], n) for h in hits], 1)
                    np.add.at(edge, [min(h["to"], n) for h in hits], -1)
                    words = [words[k] for k in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
                body = b" ".join(words)
                totals.append(n)
                gone.append(n - len(words))
                digests.append(hashlib.sha256(body).hexdigest())
                if with_text:
                    kept.append(body.decode("utf-8", "replace"))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(totals, pa.int64()), pa.array(gone, pa.int64()), pa.array(digests, pa.string())]
                + [pa.array(kept, pa.string())] * with_text, names)

    joined = docs.join(spans, (docs["doc_id"] == spans["hit"]) & (docs["text_key"] == spans["hit_key"]), "left").select("doc_id", "text", "spans")
    return joined.mapInArrow(drop, "doc_id long, n_words long, n_removed long, kept_sha256 string"
                             + ", kept string" * with_text)
