"""Merkle manifest of a table, with an octopus multiproof of its rows.

Rows are leaves of one tree a group, 8 consecutive nodes under each parent; the groups' subroots are
the leaves of a top tree. Leaves are sorted over the cluster and cut into leaf partitions of at most
``CHUNK`` consecutive leaves, wherever these fall in the tree. Each leaf partition hashes the
interior nodes that lie wholly inside it and passes on only the nodes left without a parent; blocks
of ``STEP`` levels of those are merged round by round up to the roots.

Proofs come by the octopus: from its bounds alone each leaf partition computes the minimal union of
node coordinates that the proofs of all its leaves need and that it cannot derive; the union is
fetched by one join; interiors shared by its leaves are derived once, and every leaf's own proof is
expanded locally. A proof has one step a level: the hashes before and after the node in its run.

Defined cases: a null field is hashed as ``-``, a null group is a tree of its own and comes first;
leaves with equal ids are ordered by their hash, so the tree does not depend on the order of rows;
repeated rows are leaves of their own with a proof each; a group of one row is its own subroot; an
empty table has no tree and gives an empty result; texts of any length are hashed whole by Spark;
columns that are not hashed are left out, so names cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerflow.llm.common import stash

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ARITY = 8
BITS = 3
# Levels that one round of hashing covers, and the leaves below one node of that level.
STEP = 4
CHUNK = ARITY ** STEP
# Sorted leaves a Spark partition aims at.
ROWS_A_PARTITION = 500_000
TOP = "^"  # key of the tree over the subroots; a group's key is empty (null) or starts with "="
PROOF_STEPS_A_BATCH = 4096


def field(column: str) -> Column:
    """A value that cannot be confused with its neighbours: byte count, colon, value; ``-`` for null."""
    text = F.col(column).cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def row_digest(columns: tuple[str, ...] = FIELDS) -> Column:
    return F.sha2(F.concat(*[field(c) for c in columns]), 256)


def ascii_lower(text: Column) -> Column:
    """A-Z lowered, all else as it is (``lower`` does so where there is nothing else to lower)."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(
        F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))


def tree_key(group: Column) -> Column:
    """The group as a key without nulls that sorts like it, nulls first."""
    return F.coalesce(F.concat(F.lit("="), group.cast("string")), F.lit(""))


def digest_of(run: list[str]) -> str:
    return hashlib.sha256("".join(run).encode("ascii")).hexdigest()


def level_sizes(leaves: int) -> list[int]:
    """Nodes at each level, the last of them 1."""
    sizes = [leaves]
    while sizes[-1] > 1:
        sizes.append(-(-sizes[-1] // ARITY))
    return sizes


def missing_nodes(known: np.ndarray, sizes: list[int]) -> list[np.ndarray]:
    """Per level the nodes that proofs of the leaves ``known`` need and that cannot be derived from them."""
    out = []
    for size in sizes[:-1]:
        runs = np.unique(known >> BITS)
        members = (runs[:, None] * ARITY + np.arange(ARITY)).ravel()
        out.append(np.setdiff1d(members[members < size], known, assume_unique=True))
        known = runs
    return out


def climb(given: dict[int, dict[int, str]], sizes: list[int], top: int) -> tuple[dict, dict]:
    """(derived, open) nodes by level: all parents up to level ``top`` whose whole run is known, and
    the nodes left without one."""
    derived: dict[int, dict[int, str]] = {}
    unused: dict[int, dict[int, str]] = {}
    top = min(top, len(sizes) - 1)
    for level in range(top + 1):
        nodes = {**given.get(level, {}), **derived.get(level, {})}
        if level == top:
            unused[level] = nodes
            break
        found, rest = {}, {}
        for parent in sorted({k >> BITS for k in nodes}):
            run = range(parent * ARITY, min(parent * ARITY + ARITY, sizes[level]))
            if all(k in nodes for k in run):
                found[parent] = digest_of([nodes[k] for k in run])
            else:
                rest |= {k: nodes[k] for k in run if k in nodes}
        derived[level + 1], unused[level] = found, rest
    return derived, unused


NODE = "tree string, total long, level int, place long, digest string, is_root boolean"
NODE_NAMES = ["tree", "total", "level", "place", "digest", "is_root"]
NODE_TYPES = [pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.string(), pa.bool_()]


def node_columns(tree: str, sizes: list[int], nodes: dict[int, dict[int, str]]) -> list[pa.Array]:
    rows = [(tree, sizes[0], level, place, digest, sizes[level] == 1)
            for level, found in nodes.items() for place, digest in found.items()]
    return [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(NODE_TYPES)]


def leaf_partitions(leaves: DataFrame, order: list[str], carry: list[str]) -> DataFrame:
    """One row for every leaf partition: chunk, tree, n, digests (joined), and ``carry`` as lists.

    ``leaves`` has tree, digest, the columns of ``order`` and ``carry``, and is a stored table. The
    chunk ids ascend in the order of the leaves. A row number keeps equal leaves apart, so that any
    number of copies is dealt evenly.
    """
    spark = leaves.sparkSession
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-leaves.count() // ROWS_A_PARTITION))
    by = ["tree", *order, "digest", "__copy"]
    rows = (leaves.withColumn("__copy", F.monotonically_increasing_id()).repartitionByRange(parts, *by)
            .sortWithinPartitions(*by).select("tree", "digest", *carry))
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    schema = T.StructType([T.StructField("tree", T.StringType()), T.StructField("n", T.LongType()),
                           T.StructField("digests", T.StringType())]
                          + [T.StructField(c, T.ArrayType(kinds[c])) for c in carry])
    names = [f.name for f in schema.fields]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []  # slices of one tree, fewer than CHUNK leaves together

        def chunk() -> pa.RecordBatch:
            n = sum(b.num_rows for b in held)
            digests = "".join(x for b in held for x in b.column(1).to_pylist())
            lists = [pa.ListArray.from_arrays(pa.array([0, n], pa.int32()),
                                              pa.concat_arrays([b.column(2 + k) for b in held]))
                     for k in range(len(carry))]
            return pa.RecordBatch.from_arrays(
                [pa.array([held[0].column(0)[0].as_py()]), pa.array([n], pa.int64()), pa.array([digests])] + lists, names)

        for batch in batches:
            trees = batch.column(0).to_pylist()
            at = 0
            while at < len(trees):
                if held and held[0].column(0)[0].as_py() != trees[at]:
                    yield chunk()
                    held = []
                end = at + min(CHUNK - sum(b.num_rows for b in held), len(trees) - at)
                if trees[end - 1] != trees[at]:  # sorted: the tree ends before
                    end = next(k for k in range(at, end) if trees[k] != trees[at])
                held.append(batch.slice(at, end - at))
                at = end
                if sum(b.num_rows for b in held) == CHUNK:
                    yield chunk()
                    held = []
        if held:
            yield chunk()

    return stash(rows.mapInArrow(cut, schema).withColumn("chunk", F.monotonically_increasing_id()), "leaf-partitions")


def placed_heads(chunks: DataFrame) -> DataFrame:
    """(chunk, tree, n, start, total): where each leaf partition lies among its tree's leaves."""
    before = Window.partitionBy("tree").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    heads = chunks.select("chunk", "tree", "n")
    totals = heads.groupBy("tree").agg(F.sum("n").alias("total"))
    return stash(heads.withColumn("start", F.coalesce(F.sum("n").over(before), F.lit(0))).join(totals, "tree")
                 .select("chunk", "tree", "n", "start", "total"), "leaf-places")


def split_digests(joined: str) -> list[str]:
    return [joined[k:k + 64] for k in range(0, len(joined), 64)]


def open_nodes(chunks: DataFrame, heads: DataFrame) -> DataFrame:
    """The nodes that each leaf partition derives and that its leaves cannot carry further up."""
    def hash_inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tree, start, total, joined in zip(*[c.to_pylist() for c in batch.columns]):
                sizes = level_sizes(total)
                given = {0: dict(enumerate(split_digests(joined), start))}
                yield pa.RecordBatch.from_arrays(
                    node_columns(tree, sizes, climb(given, sizes, STEP)[1]), NODE_NAMES)

    rows = chunks.select("chunk", "digests").join(heads, "chunk").select("tree", "start", "total", "digests")
    return rows.mapInArrow(hash_inside, NODE)


def merge_round(nodes: DataFrame, top: int) -> DataFrame:
    """All nodes up to level ``top`` that the open nodes of each block below such a node give."""
    def hash_block(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        sizes = level_sizes(rows[0]["total"])
        given: dict[int, dict[int, str]] = {}
        for r in rows:
            given.setdefault(r["level"], {})[r["place"]] = r["digest"]
        return pa.Table.from_arrays(node_columns(rows[0]["tree"], sizes, climb(given, sizes, top)[0]), NODE_NAMES)

    block = F.expr(f"shiftright(place, {BITS} * ({top} - level))")
    return nodes.groupBy("tree", block.alias("block")).applyInArrow(hash_block, NODE)


def hash_trees(chunks: DataFrame, heads: DataFrame) -> DataFrame:
    """Every node that can stand outside some leaf partition, roots included.

    One number, the largest tree's leaves, reaches the driver: it tells how many rounds there are.
    """
    largest = heads.agg(F.max("total")).first()[0] or 0
    rest = stash(open_nodes(chunks, heads), "open-nodes")
    found, top = rest, STEP
    while True:
        merged = stash(merge_round(rest, top), f"nodes-{top}")
        found = found.unionByName(merged)
        if ARITY ** top >= largest:
            return found
        # a leaf partition that is a whole block has already reached its level
        rest = merged.unionByName(rest.filter(F.col("level") == top)).filter(F.col("level") == top)
        top += STEP


@dataclass
class Manifest:
    """Stored tables of one manifest: leaf partitions, their places, nodes, and one row a tree."""

    chunks: DataFrame
    heads: DataFrame
    nodes: DataFrame
    trees: DataFrame


def build_manifest(leaves: DataFrame, order: list[str], carry: list[str]) -> Manifest:
    """``leaves``: tree, digest, and the columns of ``order`` and ``carry``.

    ``trees`` has (tree, subroot, top_place, n_trees, root).
    """
    chunks = leaf_partitions(stash(leaves, "leaves"), order, carry)
    heads = placed_heads(chunks)
    nodes = hash_trees(chunks, heads)
    subroots = stash(nodes.filter("is_root").select(F.lit(TOP).alias("tree"), F.col("tree").alias("group"), "digest"),
                     "subroots")
    top_chunks = leaf_partitions(subroots, ["group"], ["group"])
    top_heads = placed_heads(top_chunks)
    top_nodes = hash_trees(top_chunks, top_heads)
    root = top_nodes.filter("is_root").select("tree", F.col("digest").alias("root"))
    places = (top_chunks.select("chunk", F.posexplode("group").alias("k", "group")).join(top_heads, "chunk")
              .select("tree", "group", (F.col("start") + F.col("k")).alias("top_place"), F.col("total").alias("n_trees")))
    trees = (places.join(root, "tree").drop("tree").join(subroots.drop("tree"), "group")
             .select(F.col("group").alias("tree"), F.col("digest").alias("subroot"), "top_place", "n_trees", "root"))
    return Manifest(chunks, heads, nodes.unionByName(top_nodes), stash(trees, "trees"))


def expanded(lo: int, own: list[str], sizes: list[int], fetched: dict[tuple[int, int], str]
             ) -> tuple[list[list[str]], list[list[str]], list[int], str]:
    """Per level the hashes before and after each node over the leaves ``own`` (from place ``lo``), the
    first of those nodes, and at the end the root that they all lead to."""
    befores, afters, firsts = [], [], []
    for level, size in enumerate(sizes[:-1]):
        first, hi = lo & -ARITY, lo + len(own) - 1
        last = min(hi | (ARITY - 1), size - 1)
        nodes = ([fetched[level, k] for k in range(first, lo)] + own + [fetched[level, k] for k in range(hi + 1, last + 1)])
        befores.append(["".join(nodes[k - first & -ARITY:k - first]) for k in range(lo, hi + 1)])
        afters.append(["".join(nodes[k - first + 1:(k - first | (ARITY - 1)) + 1]) for k in range(lo, hi + 1)])
        firsts.append(lo)
        own = [digest_of(nodes[k:k + ARITY]) for k in range(0, len(nodes), ARITY)]
        lo = first >> BITS
    return befores, afters, firsts, own[0]


def prove(manifest: Manifest, carry: list[str]) -> DataFrame:
    """Every leaf with its proof: ``carry``, leaf, subroot, root, proof (a step a level, leaf to root).

    A step is (before, after): the joined hashes of the run's other nodes on either side.
    """
    heads = manifest.heads.join(manifest.trees, "tree")

    def wanted_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for chunk, tree, n, start, total, place, n_trees in zip(*[c.to_pylist() for c in batch.columns]):
                own = missing_nodes(np.arange(start, start + n), level_sizes(total))
                above = missing_nodes(np.array([place]), level_sizes(n_trees))
                rows += [(chunk, key, level, int(k)) for key, found in ((tree, own), (TOP, above))
                         for level, places in enumerate(found) for k in places]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], kind)
                 for k, kind in enumerate([pa.int64(), pa.string(), pa.int32(), pa.int64()])],
                ["chunk", "tree", "level", "place"])

    union = heads.select("chunk", "tree", "n", "start", "total", "top_place", "n_trees").mapInArrow(
        wanted_nodes, "chunk long, tree string, level int, place long")
    fetched = (union.join(manifest.nodes.select("tree", "level", "place", "digest"), ["tree", "level", "place"])
               .groupBy("chunk").agg(F.collect_list(F.struct("tree", "level", "place", "digest")).alias("fetched")))
    kinds = {f.name: f.dataType for f in manifest.chunks.schema.fields}
    step = T.StructType([T.StructField("before", T.StringType()), T.StructField("after", T.StringType())])
    schema = T.StructType([T.StructField(c, kinds[c].elementType) for c in carry]
                          + [T.StructField(c, T.StringType()) for c in ("leaf", "subroot", "root")]
                          + [T.StructField("proof", T.ArrayType(step))])
    names = [f.name for f in schema.fields]
    frame = (manifest.chunks.select("chunk", "digests", *carry).join(heads, "chunk").join(fetched, "chunk", "left")
             .select("tree", "start", "total", "subroot", "top_place", "n_trees", "root", "digests", "fetched", *carry))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            heads = [c.to_pylist() for c in batch.columns[:9]]
            for row, (tree, start, total, subroot, place, n_trees, root, joined, nodes) in enumerate(zip(*heads)):
                own, known = split_digests(joined), {(x["tree"], x["level"], x["place"]): x["digest"] for x in nodes or []}
                inside = {k[1:]: d for k, d in known.items() if k[0] == tree}
                above = {k[1:]: d for k, d in known.items() if k[0] == TOP}
                low = expanded(start, own, level_sizes(total), inside)
                high = expanded(place, [subroot], level_sizes(n_trees), above)
                if (low[3], high[3]) != (subroot, root):
                    raise ValueError(f"the stored nodes of tree {tree!r} do not lead to its root")
                steps = pa.StructArray.from_arrays(
                    [pa.array([x for level in low[side] + high[side] for x in level], pa.string()) for side in (0, 1)],
                    names=["before", "after"])
                widths = [len(x) for x in low[0] + high[0]]
                bases = np.concatenate(([0], np.cumsum(widths)[:-1])).astype(np.int64) if widths else np.zeros(0, np.int64)
                shifts = BITS * np.arange(len(low[0]))
                lists = [batch.column(9 + k)[row].values for k in range(len(carry))]
                size = max(1, PROOF_STEPS_A_BATCH // max(1, len(widths)))
                for k in range(0, len(own), size):
                    n = min(size, len(own) - k)
                    at = start + np.arange(k, k + n)[:, None]
                    inner = bases[:len(low[0])] + (at >> shifts) - np.array(low[2], np.int64)
                    outer = np.broadcast_to(bases[len(low[0]):], (n, len(high[0])))
                    picked = steps.take(pa.array(np.hstack([inner, outer]).ravel().astype(np.int64)))
                    ends = np.arange(n + 1, dtype=np.int32) * len(widths)
                    yield pa.RecordBatch.from_arrays(
                        [x.slice(k, n) for x in lists]
                        + [pa.array(own[k:k + n]), pa.array([subroot] * n), pa.array([root] * n),
                           pa.ListArray.from_arrays(pa.array(ends), picked)], names)

    return frame.mapInArrow(expand, schema)


def folded_root(leaf: Column, proof: Column) -> Column:
    """The root that a leaf leads to by its proof."""
    return F.aggregate(proof, leaf, lambda node, s: F.sha2(F.concat(s["before"], node, s["after"]), 256))


def proof_digest(proof: Column) -> Column:
    """Hash of all siblings of a proof, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.transform(proof, lambda s: F.concat(s["before"], s["after"]))), 256)


def tamper_audit(docs: DataFrame, tampered: Column, fields: tuple[str, ...] = FIELDS, id_col: str = "doc_id",
                 group_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Proofs of all rows against the manifest, rows marked ``tampered`` presented with a lower-cased text.

    (doc_id, leaf, subroot, root, proof, folded_root, verified): ``folded_root`` starts from the row
    as presented, all else from the row as recorded.
    """
    recorded = docs.select(*[F.col(c) for c in fields])
    lowered = F.when(tampered, ascii_lower(F.col(text_col)))
    presented = recorded.select(*[(lowered if c == text_col else F.col(c)).alias(c) for c in fields],
                                row_digest(fields).alias("__leaf"), tree_key(F.col(group_col)).alias("__tree"),
                                tampered.alias("__tampered"))
    # both digests in one projection over the scan: the text is read once and goes no further
    leaves = presented.select(F.col("__tree").alias("tree"), F.col(id_col).cast("long").alias("doc_id"),
                              F.col("__leaf").alias("digest"),
                              F.when(F.col("__tampered"), row_digest(fields)).alias("presented"))
    manifest = build_manifest(leaves, ["doc_id"], ["doc_id", "presented"])
    proofs = prove(manifest, ["doc_id", "presented"])
    return (proofs.withColumn("folded_root", folded_root(F.coalesce("presented", "leaf"), F.col("proof")))
            .select("doc_id", "leaf", "subroot", "root", "proof", "folded_root",
                    (F.col("folded_root") == F.col("root")).alias("verified")))
