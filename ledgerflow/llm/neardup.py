"""Near-duplicate documents: MinHash bands propose, sequential Bayesian tests prune, full sets decide.

A document is its set of distinct five-word shingles. Equal sets form a class first; a class is
represented by its smallest id. Bands of MinHash values bring representatives together. Within a
bucket every member is compared with the bucket's smallest id only (a star, not all pairs). While
much is left apart, the buckets get further stars around other members; what they still leave in
different components is compared pair by pair, so that no link between different texts is lost. Each proposed pair goes through batches of signature values: across components, a sketch of
four-bit values is tested in the join itself; after every batch a pair
is dropped if the posterior probability of a similarity at or over the threshold falls under
``MISS``. Survivors are verified exactly on the full sets, and links are merged into components.

With ``BANDS`` bands of ``ROWS`` values a pair at similarity 0.75 is proposed with probability
1 - (1 - 0.75**5)**40 = 0.99998.

Defined cases: A-Z count as lower case, other letters as they are; fewer than five words are one
shingle; null texts and texts without words have an empty set and no links; texts of any length
are hashed whole; rows that share an id are one document: each of their texts has its own set, and what
links one links all; a null id is linked with nothing and
kept; repeated rows give repeated results; an empty table gives an empty table; input columns
named like the results give way.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import gram_hashes, hot_keys, mixed, spread_join, stash, word_hashes

SHINGLE = 5
THRESHOLD = 75  # per cent
BANDS, ROWS = 40, 5
BATCH = 40
MISS = 1e-6
# Stars are repeated while all pairs across components would be more than so many a row.
PAIRS_A_ROW = 4
# ... and a star's pairs bring at least this share of links.
USEFUL = 0.1
# Values of the sketch that pairs across components are tested with, four bits each.
SKETCH = 1280
_FAMILY = 20240611


def shingle_set(text: bytes | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's five-word shingles."""
    words = text.lower().split() if text else []
    if not words:
        return np.empty(0, np.uint64)
    n = min(SHINGLE, len(words))
    return np.unique(mixed(gram_hashes(word_hashes().of(words), n), n))


def _family(k: int = BANDS * ROWS, seed: int = _FAMILY) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    return (rng.integers(0, 1 << 32, k, dtype=np.uint32) | np.uint32(1)), rng.integers(0, 1 << 32, k, dtype=np.uint32)


def minhash(shingles: np.ndarray, family: tuple[np.ndarray, np.ndarray], block: int = 1024) -> np.ndarray:
    """MinHash signature: the smallest value of each hash function, over the set in blocks."""
    a, b = family
    # Each function multiplies the upper and lower halves' mix; the product's bits are folded once.
    x = (shingles ^ (shingles >> np.uint64(32))).astype(np.uint32)
    out = np.full(len(a), 0xFFFFFFFF, np.uint32)
    for k in range(0, len(x), block):
        v = (x[k:k + block, None] ^ b) * a
        np.minimum(out, (v ^ (v >> np.uint32(15))).min(axis=0), out=out)
    return out


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, n_shingles, k1, k2, sig, bands): set size, 128-bit set key, a byte a value, band keys."""
    names = ["doc_id", "text_key", "n_shingles", "k1", "k2", "sig", "bands"]

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = _family()
        band_no = np.arange(BANDS, dtype=np.uint64)
        for batch in batches:
            sizes, k1, k2, sigs, bands = [], [], [], [], []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                s = shingle_set(text)
                sizes.append(len(s))
                if not len(s):
                    k1.append(None), k2.append(None), sigs.append(None), bands.append(None)
                    continue
                k1.append(int(mixed(s, 1).sum().view(np.int64)))
                k2.append(int(np.bitwise_xor.reduce(mixed(s, 2)).view(np.int64)))
                m = minhash(s, family)
                sigs.append((mixed(m.astype(np.uint64)) & np.uint64(255)).astype(np.uint8).tobytes())
                rows = m.reshape(BANDS, ROWS).astype(np.uint64)
                key = band_no
                for j in range(ROWS):
                    key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + rows[:, j])
                bands.append(key.view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(k1, pa.int64()), pa.array(k2, pa.int64()),
                 pa.array(sigs, pa.binary()),
                 pa.array(bands, pa.list_(pa.int64()))], names)

    return docs.select("doc_id", "text", "text_key").mapInArrow(
        sign, "doc_id long, text_key long, n_shingles long, k1 long, k2 long, sig binary, bands array<long>")


def fewest_matches(threshold: float, miss: float, total: int, batch: int) -> list[tuple[int, int]]:
    """(values compared, matches needed) after each batch, for the posterior to stay at ``miss`` or over.

    Uniform prior over the similarity; byte values agree by chance once in 256.
    """
    grid = np.linspace(0.0005, 0.9995, 1000)
    agree = grid + (1 - grid) / 256
    out = []
    for n in range(batch, total + 1, batch):
        for m in range(n + 1):
            like = m * np.log(agree) + (n - m) * np.log(1 - agree)
            post = np.exp(like - like.max())
            if post[grid >= threshold].sum() >= miss * post.sum():
                out.append((n, m))
                break
    return out


def most_differences(threshold: float, miss: float, total: int, values: int) -> int:
    """Differences among so many folded values at which the posterior still stays at ``miss`` or over."""
    grid = np.linspace(0.0005, 0.9995, 1000)
    agree = grid + (1 - grid) / values
    for d in range(total, 0, -1):
        like = (total - d) * np.log(agree) + d * np.log(1 - agree)
        post = np.exp(like - like.max())
        if post[grid >= threshold].sum() >= miss * post.sum():
            return d
    return 0


def sketch_differences(x: str, y: str) -> Column:
    """How many of the four-bit values of two sketches differ.

    Sixty-four values stand in four longs, one for each bit: a value differs where any bit does.
    """
    total = F.lit(0)
    for i in range(0, SKETCH // 16, 4):
        planes = [F.get(F.col(x), F.lit(i + j)).bitwiseXOR(F.get(F.col(y), F.lit(i + j))) for j in range(4)]
        total = total + F.bit_count(planes[0].bitwiseOR(planes[1]).bitwiseOR(planes[2]).bitwiseOR(planes[3]))
    return total


def bayesian_survivors(pairs: DataFrame, signed: DataFrame) -> DataFrame:
    """Pairs (a, b) whose signatures leave the threshold possible, and whose set sizes do."""
    k = BANDS * ROWS
    needed = fewest_matches(THRESHOLD / 100, MISS, k, BATCH)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(-1, k) for c in (2, 3))
            alive = np.arange(batch.num_rows)
            matches = np.zeros(batch.num_rows, np.int64)
            done = 0
            for n, least in needed:
                matches[alive] += (x[alive, done:n] == y[alive, done:n]).sum(axis=1)
                alive = alive[matches[alive] >= least]
                done = n
            yield batch.select(["a", "b"]).take(pa.array(alive))

    sig = signed.select("doc_id", "n_shingles", "sig")
    both = (pairs.join(sig.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("na"), F.col("sig").alias("sa")), "a")
            .join(sig.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("nb"), F.col("sig").alias("sb")), "b")
            .filter(100 * F.least("na", "nb") >= THRESHOLD * F.greatest("na", "nb")))
    return both.select("a", "b", "sa", "sb").mapInArrow(test, "a long, b long")


def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Pairs (a, b) whose full shingle sets reach the threshold."""
    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, last, last_set = [], None, None
            a_ids = batch.column(0).to_pylist()
            a_texts, b_texts = (batch.column(c).cast(pa.binary()) for c in (2, 3))
            for i, a in enumerate(a_ids):
                if a != last:
                    last, last_set = a, shingle_set(a_texts[i].as_py())
                s = shingle_set(b_texts[i].as_py())
                common = len(np.intersect1d(last_set, s, assume_unique=True))
                keep.append(100 * common >= THRESHOLD * (len(last_set) + len(s) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    both = (pairs.join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb")), "b")
            .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta")), "a"))
    return both.select("a", "b", "ta", "tb").mapInArrow(verify, "a long, b long")


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Four-bit values as longs: for every 64 values, the long of their bits 0, then 1, 2 and 3."""
    planes = [np.packbits((values.reshape(-1, 64) >> j) & 1, axis=1).view(np.int64) for j in range(4)]
    return np.hstack(planes).reshape(-1)


def open_traits(texts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, bits) and (doc_id, alone) of some documents.

    ``bits``: ``SKETCH`` further MinHash values, four bits each, as bit planes. ``alone``: how many
    shingles no other of these documents has.
    """
    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        family = _family(SKETCH, _FAMILY + 1)
        for batch in batches:
            out = []
            for text in batch.column(1).cast(pa.binary()).to_pylist():
                v = (mixed(minhash(shingle_set(text), family, 256).astype(np.uint64)) & np.uint64(15)).astype(np.uint8)
                out.append(bit_planes(v))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.list_(pa.int64()))], ["doc_id", "bits"])

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                s = shingle_set(text).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(s), doc)), pa.array(s)], ["doc_id", "shingle"])

    alone = (texts.mapInArrow(shingles, "doc_id long, shingle long")
             .groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("doc_id")).filter("n = 1")
             .groupBy("doc_id").agg(F.count(F.lit(1)).alias("alone")))
    return texts.mapInArrow(sketch, "doc_id long, bits array<long>"), alone


def components(edges: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable over undirected edges (a, b), for every id in an edge.

    Labels take the neighbours' smallest label, then that label's own label, until nothing changes;
    each round is written to the shared folder.
    """
    edges = stash(edges.distinct(), "near-edges")
    both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stash(both.groupBy(F.col("a").alias("id")).agg(F.least(F.col("id"), F.min("b")).alias("label")),
                   "near-labels")
    while True:
        near = (both.join(labels.select(F.col("id").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near")))
        step = labels.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "near").alias("mid"))
        jump = labels.select(F.col("id").alias("mid"), F.col("label").alias("jump"))
        new = stash(step.join(jump, "mid").select("id", "old", F.least("mid", "jump").alias("label")), "near-labels")
        if new.filter("old <> label").isEmpty():
            return new.select("id", F.col("label").alias("component"))
        labels = new.select("id", "label")


def same_id_links(usable: DataFrame, classes: DataFrame) -> DataFrame:
    """(a, b): classes that hold a text of one id, each with the id's smallest class."""
    key = F.struct("k1", "k2")
    several = (usable.groupBy("doc_id").agg(F.min(key).alias("lo"), F.max(key).alias("hi")).filter("lo <> hi")
               .select("doc_id", F.col("lo.k1").alias("l1"), F.col("lo.k2").alias("l2")))
    rows = usable.select("doc_id", "k1", "k2").distinct()
    ids = rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    pairs = spread_join(rows, several, hot_keys(ids, ["doc_id"], "n"), ["doc_id"], F.col("k1")).filter(
        "k1 <> l1 or k2 <> l2").select("k1", "k2", "l1", "l2").distinct()
    pairs = stash(pairs, "near-same-id")
    named = spread_join(pairs, classes.select("k1", "k2", F.col("node").alias("b")), hot_keys(
        pairs.groupBy("k1", "k2").agg(F.count(F.lit(1)).alias("n")), ["k1", "k2"], "n"), ["k1", "k2"], F.col("l1"))
    lowest = classes.select(F.col("k1").alias("l1"), F.col("k2").alias("l2"), F.col("node").alias("a"))
    named = spread_join(named, lowest, hot_keys(
        pairs.groupBy("l1", "l2").agg(F.count(F.lit(1)).alias("n")), ["l1", "l2"], "n"), ["l1", "l2"], F.col("b"))
    return named.select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every row of ``docs``."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # Where ids repeat, a row is known by its id and a hash of its text, else by its id alone.
    unique = docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").isEmpty()
    docs = docs.withColumn("text_key", F.lit(0).cast("long") if unique else F.xxhash64("text"))
    signed = stash(signatures(docs), "near-signatures")
    usable = signed.filter("doc_id is not null and n_shingles > 0")
    # A class goes by the smallest of its ids, or by a number where several classes may share that.
    node = F.col("first.doc_id") if unique else F.monotonically_increasing_id()
    classes = stash(usable.groupBy("k1", "k2").agg(F.min(F.struct("doc_id", "text_key")).alias("first"),
                                                   F.count(F.lit(1)).alias("n"))
                    .select("k1", "k2", node.alias("node"), F.col("first.doc_id").alias("rep"),
                            F.col("first.text_key").alias("rep_key"), "n"), "near-classes")
    is_rep = (F.col("doc_id") == F.col("rep")) & (F.col("text_key") == F.col("rep_key"))
    reps = stash(usable.drop("k1", "k2").join(classes.select("node", "rep", "rep_key"), is_rep).dropDuplicates(["node"])
                 .select(F.col("node").alias("doc_id"), "n_shingles", "sig", "bands"), "near-reps")
    bucketed = reps.select("doc_id", F.explode("bands").alias("key"))
    shared = (bucketed.groupBy("key").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
              .filter(F.col("first") < F.col("last")).select("key", "first"))
    members = stash(bucketed.join(shared, "key"), "near-members")
    star = stash(members.filter(F.col("first") < F.col("doc_id"))
                 .select(F.col("first").alias("a"), F.col("doc_id").alias("b")).distinct(), "near-star")
    involved = members.select("doc_id").distinct()
    named = (involved.select(F.col("doc_id").alias("node"), F.col("doc_id").alias("rep"), F.lit(0).alias("rep_key"))
             if unique else classes.join(involved, F.col("node") == F.col("doc_id"), "left_semi"))
    texts = stash(docs.join(named.select("node", "rep", "rep_key"), is_rep).dropDuplicates(["node"])
                  .select(F.col("node").alias("doc_id"), "text"), "near-texts")
    links = stash(verified(bayesian_survivors(star, reps), texts), "near-links")
    if not unique:
        links = links.unionByName(stash(same_id_links(usable, classes), "near-links"))
    tested = star
    sizes = reps.select("doc_id", "n_shingles")
    for turn in count(1):
        # Members of one bucket that are still in different components, but for the first stars' centres.
        joined = components(links)
        labelled = members.join(joined, F.col("doc_id") == F.col("id"), "left").select(
            "key", "doc_id", "first", F.coalesce("component", "doc_id").alias("component"))
        apart = (labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                 .filter("lo < hi").select("key"))
        open_rows = stash(labelled.filter(F.col("first") < F.col("doc_id")).join(apart, "key", "left_semi")
                          .select("key", "doc_id", "component").join(sizes, "doc_id"), "near-open")
        by_component = open_rows.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
        load = (by_component.groupBy("key").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("n2"))
                .agg(F.sum("n").alias("rows"), F.sum((F.col("n") * F.col("n") - F.col("n2")) / 2).alias("pairs")).first())
        if not load["rows"] or load["pairs"] <= PAIRS_A_ROW * load["rows"]:
            break
        # Too many pairs for now: another star in each bucket, around a member chosen by hash.
        centre = open_rows.groupBy("key").agg(F.min_by(
            F.struct("doc_id", "component"), F.xxhash64(F.lit(turn), "key", "doc_id")).alias("c"))
        again = (open_rows.join(centre, "key").filter(F.col("component") != F.col("c.component"))
                 .select(F.least("doc_id", "c.doc_id").alias("a"), F.greatest("doc_id", "c.doc_id").alias("b"))
                 .distinct().join(tested, ["a", "b"], "left_anti"))
        again = stash(again, "near-star")
        new = stash(verified(bayesian_survivors(again, reps), texts), "near-links")
        tested = tested.unionByName(again)
        gained = new.count()
        links = links.unionByName(new)
        if gained < USEFUL * again.count():
            joined = components(links)
            break
    open_texts = texts.join(open_rows.select("doc_id").distinct(), "doc_id", "left_semi").select("doc_id", "text")
    bits, alone = open_traits(open_texts)
    # A pair shares nothing of what one document has alone: that bounds its similarity.
    open_rows = (open_rows.drop("component").join(joined, F.col("doc_id") == F.col("id"), "left")
                 .join(alone, "doc_id", "left")
                 .withColumn("common", F.col("n_shingles") - F.coalesce("alone", F.lit(0)))
                 .filter(100 * F.col("common") >= THRESHOLD * F.col("n_shingles"))
                 .select("key", "doc_id", "n_shingles", "common", F.coalesce("component", "doc_id").alias("component"))
                 .join(bits, "doc_id").join(reps.select("doc_id", "bands"), "doc_id"))
    open_rows = stash(open_rows, "near-open")
    x, y = open_rows.alias("x"), open_rows.alias("y")
    # The join tests the bound, that this is the pair's first common bucket, and the sketch.
    most = F.least("x.common", "y.common")
    possible = ((F.col("x.doc_id") < F.col("y.doc_id")) & (F.col("x.component") != F.col("y.component"))
                & (100 * most >= THRESHOLD * (F.col("x.n_shingles") + F.col("y.n_shingles") - most))
                & (F.get(F.array_intersect("x.bands", "y.bands"), F.lit(0)) == F.col("x.key"))
                & (sketch_differences("x.bits", "y.bits") <= most_differences(THRESHOLD / 100, MISS, SKETCH, 16)))
    across = (x.join(y, (F.col("x.key") == F.col("y.key")) & possible)
              .select(F.col("x.doc_id").alias("a"), F.col("y.doc_id").alias("b"))
              .join(tested, ["a", "b"], "left_anti"))
    more = stash(verified(across, texts), "near-links")
    final = joined if more.isEmpty() else components(links.unionByName(more))
    found = classes.join(final, F.col("node") == F.col("id"), "left").select(
        "k1", "k2", "rep", F.coalesce("component", "node").alias("component"))
    if unique:
        rep_of = found.select("k1", "k2", F.col("component").alias("component_id"))
    else:
        smallest = stash(found.groupBy("component").agg(F.min("rep").alias("component_id"), F.count(F.lit(1)).alias("n")),
                         "near-smallest")
        rep_of = spread_join(found, smallest.drop("n"), hot_keys(smallest, ["component"], "n"), ["component"],
                             F.col("k1")).select("k1", "k2", "component_id")
    # A class of exact copies may hold a third of all rows.
    out = spread_join(signed.select("doc_id", "n_shingles", "k1", "k2"), rep_of, hot_keys(classes, ["k1", "k2"], "n"),
                      ["k1", "k2"], F.col("doc_id"), "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(component == F.col("doc_id"), F.lit(True)).alias("kept"))


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that are the smallest id of their component; of equal ids every row stays."""
    gone = near_duplicates(docs, id_col, text_col).filter(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col(id_col).cast("long") == F.col("__gone"), "left_anti")
