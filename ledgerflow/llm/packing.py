"""Packing documents into fixed-length sequences with a grouping genetic algorithm.

Documents are tokenized, cut into pieces where longer than a sequence, and the pieces are dealt
by hash into shards of bounded size. Each shard is evolved on several islands: an individual is a
grouping of pieces into bins; crossover injects whole well-filled bins of one parent into the
other, removes the bins that hold their pieces a second time, and best-fits the displaced pieces.
The islands' elites then migrate into one population per shard, which is evolved once more.
The poorly filled bins of all shards migrate to a second, smaller round of shards, so that a
shard's remainder costs no sequence of its own.

Defined cases: null text counts as empty and still has its end token; texts of any length are cut,
never dropped; repeated rows are packed each; ties are broken by row number; an empty table gives
an empty table; extra columns are kept out.
"""

from __future__ import annotations

import math
import os
import unicodedata
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import stash, worker_state

CAPACITY = 2048
END_ID = 0
VOCABULARY = "word_bpe_49k.json"
SHARD_PIECES = 4096
ISLANDS = 2
POPULATION = 10
# A search ends after this many generations without a better grouping, or at the least number of bins.
STALE_GENERATIONS = 20
# Bins filled less than this migrate to the second round.
ELITE_FILL = 0.98


def byte_characters() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies: itself where it is printable."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


class TokenMemory(dict):
    """Ids of each white-space-separated chunk, as little-endian unsigned 32-bit bytes.

    The tokenizer drops white space and no token spans it, so a text's ids are those of its chunks.
    It lower-cases, so chunks are remembered with A-Z lowered; a mark at the end of a word is a
    token sequence of its own. Chunks of letters that normalisation leaves alone go to the model
    directly, all others through the whole tokenizer. The model keeps no memory of its own beside
    this one. Chunks not seen while half the limit of others came are forgotten.
    """

    def __init__(self, path: str, limit: int = 800_000):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        if hasattr(self.tokenizer.model, "_resize_cache"):
            self.tokenizer.model._resize_cache(0)
        self.older: dict[bytes, bytes] = {}
        self.characters = byte_characters()
        self.limit = limit

    @staticmethod
    def settled(text: str) -> bool:
        """Letters only, and left as they are by normalisation."""
        return text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text)

    def encode(self, chunk: bytes) -> bytes:
        text = chunk.decode("utf-8", "replace")
        if self.settled(text):
            word = text if text.isascii() else chunk.decode("latin-1").translate(self.characters)
            ids = [t.id for t in self.tokenizer.model.tokenize(word)]
        else:
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        return array("I", ids).tobytes()

    def __missing__(self, chunk: bytes) -> bytes:
        if len(self) >= self.limit // 2:
            self.older = dict(self)
            self.clear()
        ids = self.older.pop(chunk, None)
        if ids is not None:
            self[chunk] = ids
            return ids
        if len(chunk) > 1 and chunk[-1:] in b".,;:!?" and self.settled(chunk[:-1].decode("utf-8", "replace")):
            ids = self[chunk[:-1]] + self[chunk[-1:]]
        else:
            ids = self.encode(chunk)
        self[chunk] = ids
        return ids

    def of(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text; texts that could hold a special token's string keep their capitals."""
        get = self.__getitem__
        return [b"".join(map(get, (t if b"<|" in t else t.lower()).split())) for t in texts]


def token_ids(texts: list[str | None], vocabulary: str = VOCABULARY) -> list[bytes]:
    import public_tokenizers
    path = vocabulary if os.sep in vocabulary else public_tokenizers.path(vocabulary)
    memory = worker_state(f"tokens:{path}", lambda: TokenMemory(path))
    return memory.of([(t or "").encode("utf-8", "replace") for t in texts])


def token_pieces(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                 vocabulary: str = VOCABULARY, end_id: int = END_ID, with_ids: bool = False,
                 docs_a_step: int = 256) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]) of every document's tokens and end id.

    ``ids`` are little-endian unsigned 32-bit numbers.
    """
    end = array("I", [end_id]).tobytes()
    size = 4 * capacity
    names = ["doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * with_ids

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, docs_a_step):
                part = batch.slice(k, docs_a_step)
                ids, pieces, bodies = [], [], []
                for doc, body in zip(part.column(0).to_pylist(),
                                     token_ids(part.column(1).to_pylist(), vocabulary)):
                    body += end
                    for p in range(math.ceil(len(body) / size)):
                        ids.append(doc)
                        pieces.append(p)
                        bodies.append(body[p * size:(p + 1) * size])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(pieces, pa.int32()),
                     pa.array([p * capacity for p in pieces], pa.int64()),
                     pa.array([len(b) // 4 for b in bodies], pa.int64()),
                     pa.array([zlib.crc32(b) for b in bodies], pa.int64())]
                    + [pa.array(bodies, pa.binary())] * with_ids, names)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long"
                           + ", ids binary" * with_ids)


class Bins:
    """A grouping of items into bins; free room is indexed by its size in a bit set."""

    def __init__(self, lengths: list[int], capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bins: list[list[int]] = []
        self.room: list[int] = []
        self.by_room: dict[int, list[int]] = {}
        self.mask = 0

    def offer(self, b: int) -> None:
        r = self.room[b]
        if r:
            self.by_room.setdefault(r, []).append(b)
            self.mask |= 1 << r

    def add_bin(self, items: list[int], room: int) -> None:
        self.bins.append(items)
        self.room.append(room)
        self.offer(len(self.bins) - 1)

    def best_fit(self, items) -> None:
        """Each item to the fullest bin that still takes it, in the order given."""
        lengths, by_room, room, bins = self.lengths, self.by_room, self.room, self.bins
        for i in items:
            need = lengths[i]
            fits = self.mask >> need
            if fits:
                r = need + (fits & -fits).bit_length() - 1
                at = by_room[r]
                b = at.pop()
                if not at:
                    self.mask &= ~(1 << r)
                bins[b].append(i)
                room[b] = r - need
                self.offer(b)
            else:
                self.add_bin([i], self.capacity - need)

    def fitness(self) -> tuple[int, float]:
        """Fewest bins first, then the fuller bins: the sum of squared fills."""
        c = self.capacity
        return len(self.bins), -sum((c - r) * (c - r) for r in self.room)


def crossover(one: Bins, other: Bins, share: float, rng: np.random.Generator) -> Bins:
    """``one`` with some of the fullest bins of ``other`` injected whole."""
    room = np.array(other.room)
    order = np.argsort(room, kind="stable")
    pick = order[:max(1, int(2 * share * len(order)))]
    pick = pick[rng.random(len(pick)) < 0.5]
    injected = {i for b in pick.tolist() for i in other.bins[b]}
    child = Bins(one.lengths, one.capacity)
    displaced: list[int] = []
    for items, r in zip(one.bins, one.room):
        if injected.isdisjoint(items):
            child.add_bin(list(items), r)
        else:
            displaced += [i for i in items if i not in injected]
    for b in pick.tolist():
        child.add_bin(list(other.bins[b]), other.room[b])
    displaced.sort(key=one.lengths.__getitem__, reverse=True)
    child.best_fit(displaced)
    return child


def evolve(lengths: list[int], capacity: int, seed: int, start: list[Bins], population: int = POPULATION,
           stale_generations: int = STALE_GENERATIONS) -> Bins:
    """Best grouping once no better one comes up; ``start`` are individuals that migrate in."""
    rng = np.random.default_rng(seed)
    size = np.array(lengths)
    individuals = list(start)
    while len(individuals) < population:
        # Best-fit decreasing; all but the first island's first individual with blurred lengths.
        blur = rng.normal(0, 0.02 * capacity, len(size)) if individuals or seed % ISLANDS else 0
        b = Bins(lengths, capacity)
        b.best_fit(np.argsort(-(size + blur), kind="stable").tolist())
        individuals.append(b)
    least = math.ceil(sum(lengths) / capacity)
    individuals.sort(key=Bins.fitness)
    stale = 0
    while stale < stale_generations and len(individuals[0].bins) > least:
        best = individuals[0]
        a, b = rng.choice(len(individuals), 2, replace=False)
        individuals.append(crossover(individuals[a], individuals[b], 0.3, rng))
        individuals.sort(key=Bins.fitness)
        individuals.pop()
        stale = stale + 1 if individuals[0] is best else 0
    return individuals[0]


def _numbered(groups: list[list[int]], n: int) -> np.ndarray:
    at = np.empty(n, np.int64)
    for b, items in enumerate(groups):
        at[items] = b
    return at


_PIECE = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"


def _evolve_round(pieces: DataFrame, shards: int, level: int, capacity: int) -> DataFrame:
    """Pieces with the bin they are in: islands evolve apart, then their elites together."""
    dealt = pieces.withColumn("shard", F.pmod(F.xxhash64("uid"), F.lit(shards)))

    def island(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["length", "uid"], ascending=[False, True], ignore_index=True)
        seed = int(rows["shard"].iloc[0]) * ISLANDS + int(rows["island"].iloc[0])
        best = evolve(rows["length"].tolist(), capacity, seed, [])
        return rows.assign(bin=_numbered(best.bins, len(rows)))

    def elites(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["island", "length", "uid"], ascending=[True, False, True], ignore_index=True)
        own = rows[rows["island"] == 0].reset_index(drop=True)
        lengths, n = own["length"].tolist(), len(own)
        migrants = []
        for k in range(ISLANDS):
            groups: dict[int, list[int]] = {}
            for i, b in enumerate(rows["bin"].to_numpy()[k * n:(k + 1) * n].tolist()):
                groups.setdefault(b, []).append(i)
            m = Bins(lengths, capacity)
            for items in groups.values():
                m.add_bin(items, capacity - sum(map(lengths.__getitem__, items)))
            migrants.append(m)
        best = evolve(lengths, capacity, int(own["shard"].iloc[0]), migrants)
        bins = _numbered(best.bins, n)
        filled = np.bincount(bins, weights=own["length"], minlength=len(best.bins)).astype(np.int64)
        order = np.argsort(bins, kind="stable")
        out = own.iloc[order]
        bins = bins[order]
        ends = out["length"].cumsum().to_numpy()
        first = np.searchsorted(bins, bins)
        offset = ends - out["length"].to_numpy() - (ends - out["length"].to_numpy())[first]
        return out.drop(columns=["island"]).assign(bin=bins, offset=offset, filled=filled[bins], level=level)

    on_islands = dealt.withColumn("island", F.explode(F.array(*[F.lit(i) for i in range(ISLANDS)])))
    evolved = on_islands.groupBy("shard", "island").applyInPandas(
        island, _PIECE + ", shard long, island int, bin long")
    return evolved.groupBy("shard").applyInPandas(
        elites, _PIECE + ", shard long, bin long, offset long, filled long, level int")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (doc_id, piece, start, length, ids_crc32) with ``sequence_id`` and ``offset``."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    pieces = stash(pieces.select(F.monotonically_increasing_id().alias("uid"), *columns), "packing-pieces")
    part = pieces.filter(F.col("length") < capacity)
    first = stash(_evolve_round(part, max(1, math.ceil(part.count() / SHARD_PIECES)), 1, capacity), "packing-round")
    elite = F.col("filled") >= ELITE_FILL * capacity
    left = first.filter(~elite).select("uid", *columns)
    second = _evolve_round(left, max(1, math.ceil(left.count() / SHARD_PIECES)), 2, capacity)
    # Sequence numbers of the two rounds and of full pieces differ by their remainder modulo 4.
    number = (F.col("shard") * (16 * SHARD_PIECES) + F.col("bin")) * 4 + F.col("level")
    places = first.filter(elite).unionByName(second).select(*columns, number.alias("sequence_id"), "offset")
    full = pieces.filter(F.col("length") >= capacity).select(
        *columns, (F.col("uid") * 4).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return full.unionByName(places)


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY,
                   vocabulary: str = VOCABULARY) -> DataFrame:
    """Place of every piece of every document in sequences of at most ``capacity`` tokens."""
    return pack(token_pieces(docs, id_col, text_col, capacity, vocabulary), capacity)


def sequences(docs: DataFrame, places: DataFrame, capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """(sequence_id, n_tokens, ids): the packed sequences themselves, for ids that are unique in ``docs``."""
    ids = token_pieces(docs, capacity=capacity, vocabulary=vocabulary, with_ids=True).select("doc_id", "piece", "ids")
    joined = places.select("doc_id", "piece", "sequence_id", "offset", "length").join(ids, ["doc_id", "piece"])
    in_order = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (joined.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"), in_order.alias("parts"))
            .select("sequence_id", "n_tokens", F.aggregate(
                "parts", F.unhex(F.lit("")), lambda all_ids, p: F.concat(all_ids, p["ids"])).alias("ids")))
