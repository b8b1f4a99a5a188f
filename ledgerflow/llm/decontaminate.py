"""Benchmark decontamination by canonical templates.

Words become template tokens: numbers, units and names turn into typed
placeholders, the rest is lower-cased without outer punctuation. Windows of
template tokens are hash-joined with those of the benchmark; a joined window is a
seed. Around the seeds, the equal runs of document and item are chained in order, a few
words of drift apart, so that words put in, left out or changed do not hide a copy. A
document holds a benchmark item if such a chain has enough of its tokens, or one unbroken
run of ``RUN_TOKENS``, and the slots of the chain are consistent: each value of the item
stands for one value of the document, so re-parameterised
questions are caught and chance matches of placeholders are not. ``coverage`` is the
share of the item's tokens in the chain.

A bitmap of the benchmark's window hashes (at most ``FILTER_BITS`` bits, however large the
benchmark) keeps hopeless windows out of the join; the join itself decides.

Defined cases: null or empty texts have no windows; the windows of items of fewer than 16 tokens
are half as long as the item, so that one break leaves a whole one, and at least ``MIN_TOKENS``;
windows with fewer than ``MIN_PLAIN`` plain tokens must be equal word for word; items under ``MIN_TOKENS``
tokens are one window and found where all their words stand, values included; items without a word
are nowhere; a repeated document row gives one result per id; a null id is an id like any other; extra
columns are kept out.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerflow.llm.common import gram_hashes, mixed, stash, worker_state

WINDOW = 8
MIN_TOKENS = 4
MIN_COVERAGE = 0.6
# Short items need so many tokens, or all they have.
MIN_HELD = 6
# So many tokens of an item in one unbroken run are a leak, whatever share of it they are; as many of
# them as a window has must be plain.
RUN_TOKENS = 13
# Two runs of a chain may be so many words out of step; more drift is reached step by step.
DRIFT = 8
# Shorter runs of equal tokens are chance.
MIN_RUN = 3
FILTER_BITS = 1 << 22
# A window passes if the bits at both of these shifts of its hash are set.
PROBES = (0, 32)
# Templates of nothing but placeholders say nothing; windows with fewer plain tokens are compared by their words.
MIN_PLAIN = 3

# Words for units.
UNITS = frozenset("""mm cm m km in inch inches ft foot feet yd yard yards mile miles g kg mg gram grams kilogram
    kilograms lb lbs pound pounds oz ounce ounces ml l liter liters litre litres gallon gallons s sec second
    seconds min minute minutes h hr hour hours day days week weeks month months year years dollar dollars cent
    cents euro euros usd eur percent mph kph kmh degree degrees""".split())
# Number words.
NUMBERS = frozenset("""zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen
    fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred
    thousand million billion""".split())
# Words that are capitalised for their place only.
STARTERS = frozenset("""a about after all also although an and any are as at because before both but by can consider
    could did do does during each either every find for from given had has have he her here his how however i if in
    is it its let many may most my no not of on once one or our she should show since so some such suppose than that
    the their then there these they this those though to under until was we were what when where which while who
    whose why will with would you your""".split())
# Line breaks as a word of their own: it ends a sentence and has no letters.
BREAK = "\ue000"
_EDGE = regex.compile(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}%]+$")
_NUMBER = regex.compile(r"^[\p{Sc}]?\p{N}[\p{N}.,:/]*(?:%|st|nd|rd|th)?$")
PLAIN, NUM, UNIT, NAME, MAYBE = 0, 1, 2, 3, 4


class Vocabulary(dict):
    """Word -> row of the token table: template hash, kind, capitalised, ends a sentence, value."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit
        self.values: list[str] = []
        self.token = np.zeros(1024, np.uint64)
        self.exact = np.zeros(1024, np.uint64)
        self.kind, self.capital, self.ends = np.zeros(1024, np.int8), np.zeros(1024, bool), np.zeros(1024, bool)
        self.open = np.zeros(1024, bool)  # no punctuation after it

    def __missing__(self, word: str) -> int:
        core = word if word.isalpha() else _EDGE.sub("", word)
        low = core.lower()
        kind = PLAIN
        if low in NUMBERS or not low.isalpha() and _NUMBER.match(core):
            kind = NUM
        elif low in UNITS:
            kind = UNIT
        at = self[word] = len(self.values)
        if at == len(self.token):
            for name in ("token", "exact", "kind", "capital", "ends", "open"):
                old = getattr(self, name)
                setattr(self, name, np.concatenate((old, np.zeros_like(old))))
        self.token[at] = xxhash.xxh64_intdigest(f"<{kind}>" if kind else low) if core else 0
        self.exact[at] = xxhash.xxh64_intdigest(low, 1)
        self.kind[at] = kind
        self.capital[at] = kind == PLAIN and core[:1].isupper() and core[1:2].islower() and low not in STARTERS
        self.open[at] = word.endswith(core)
        self.ends[at] = word == BREAK or word[-1] in ".!?:;" or word[-2:-1] in (".", "!", "?")
        self.values.append(low)
        return at

    def look_up(self, words: list[str]):
        if len(self) > self.limit:
            self.clear()
            self.values.clear()
        ids = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return ids, self.token[ids], self.kind[ids], self.capital[ids], self.ends[ids]


_NAME_HASH = xxhash.xxh64_intdigest("<3>")


def templates(texts: list[str | None], vocabulary: Vocabulary):
    """(document number, token hash, kind, may be a name, exact hash, values) of every template token of some texts.

    Neighbouring numbers or names without punctuation between them are one token. A capitalised word
    at the start of a text, line or sentence is a plain word that may be a name. ``values`` gives the
    words of a slice of tokens.
    """
    words = [(t or "").replace("\n", f" {BREAK} ").split() for t in texts]
    sizes = np.array([len(w) for w in words], np.int64)
    doc = np.repeat(np.arange(len(texts)), sizes)
    ids, token, kind, capital, ends = vocabulary.look_up(list(chain.from_iterable(words)))
    initial = np.ones(len(ids), bool)  # the first word of a sentence or text is no name by its capital
    initial[1:] = ends[:-1] | (doc[1:] != doc[:-1])
    name = capital & ~initial
    kind = np.where(name, NAME, kind)
    token = np.where(name, np.uint64(_NAME_HASH), token)
    joined = np.zeros(len(ids), bool)
    joined[1:] = ((kind[1:] == kind[:-1]) & ((kind[1:] == NUM) | (kind[1:] == NAME)) & ~initial[1:]
                  & vocabulary.open[ids[:-1]])
    keep = token != 0
    ids, first = ids[keep], np.flatnonzero(~joined[keep])
    head = keep & ~joined
    exact = np.add.reduceat(mixed(vocabulary.exact[ids], 7), first) if len(first) else np.empty(0, np.uint64)
    last = np.append(first[1:], len(ids))

    def values(at: slice) -> list[str]:
        return [" ".join(vocabulary.values[i] for i in ids[a:b]) for a, b in zip(first[at], last[at])]

    return doc[head], token[head], kind[head], (capital & initial)[head], exact, values


def windows(doc, token, kind, maybe, exact, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(first token, hash) of the windows of ``size`` tokens that stay in one document.

    Windows with a word that may be a name have both readings: all such words plain, or all names.
    Windows with too few plain tokens are hashed by their lower-cased words.
    """
    if len(token) < size:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    inside = doc[:len(doc) - size + 1] == doc[size - 1:]
    found = []
    for names in (False, True):
        k = np.where(maybe, NAME, kind) if names else kind
        h = mixed(gram_hashes(np.where(maybe, np.uint64(_NAME_HASH), token) if names else token, size), size)
        plain = np.concatenate(([0], np.cumsum(k == PLAIN)))
        few = plain[size:] - plain[:-size] < min(MIN_PLAIN, size)
        ok = inside & ~few
        if names:
            some = np.concatenate(([0], np.cumsum(maybe)))
            ok &= some[size:] > some[:-size]
        else:
            at = np.flatnonzero(inside & few)
            whole = np.full(len(at), np.uint64(size))
            for step in range(size):
                whole = mixed(whole ^ exact[at + step], 6)
            found.append((at, whole))
        at = np.flatnonzero(ok)
        found.append((at, h[at]))
        if not maybe.any():
            break
    return np.concatenate([a for a, _ in found]), np.concatenate([h for _, h in found])


def seed_size(n_tokens: np.ndarray, window: int) -> np.ndarray:
    """Window size of an item: with one word put in, left out or changed, one side still holds a window.

    Items under MIN_TOKENS tokens are one window.
    """
    return np.minimum(window, np.maximum(np.minimum(MIN_TOKENS, n_tokens), n_tokens // 2))


def _slices(texts, docs_a_step: int = 256):
    """(texts, document number, token, kind, may be a name, exact hash, values, first token, tokens), some texts at a time."""
    for k in range(0, len(texts), docs_a_step):
        part = texts[k:k + docs_a_step]
        vocabulary = worker_state("template_vocabulary", Vocabulary)
        doc, token, kind, maybe, exact, values = templates(part, vocabulary)
        yield (k, doc, token, kind, maybe, exact, values,
               np.searchsorted(doc, np.arange(len(part))), np.bincount(doc, minlength=len(part)))


def item_windows(rows: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(id, at, size, hash): the template windows of benchmark items, all of one item of one size."""
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for k, doc, token, kind, maybe, exact, _, begin, length in _slices(batch.column(1).to_pylist()):
                wanted = seed_size(length, window)
                for size in np.unique(wanted[wanted > 0]):
                    at, h = windows(doc, token, kind, maybe, exact, int(size))
                    ok = wanted[doc[at]] == size
                    at, h = at[ok], h[ok]
                    d = doc[at]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([ids[k + i] for i in d], pa.int64()), pa.array((at - begin[d]).astype(np.int32)),
                         pa.array(np.full(len(at), size, np.int32)), pa.array(h.view(np.int64)),
                         pa.array(length[d].astype(np.int32))], ["id", "at", "size", "hash", "n_tokens"])

    return (rows.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .filter("text is not null").mapInArrow(scan, "id long, at int, size int, hash long, n_tokens int"))


def filter_bits(h: np.ndarray) -> list[np.ndarray]:
    return [((h.view(np.int64) >> k) & (FILTER_BITS - 1)) for k in PROBES]


_SEED = pa.list_(pa.struct([("at", pa.int32()), ("size", pa.int32()), ("hash", pa.int64())]))


def regions(docs: DataFrame, id_col: str, text_col: str, sizes: list[int], bitmap: np.ndarray, reach: int) -> DataFrame:
    """(doc_id, tokens, kinds, values, seeds): the parts of whole texts around windows that the bitmap passes.

    A part reaches ``reach`` tokens to both sides of its windows; windows nearer than that share one.
    """
    names = ["doc_id", "tokens", "kinds", "values", "seeds"]

    def cut(ids, texts) -> Iterator[pa.RecordBatch]:
        for k, doc, token, kind, maybe, exact, values, begin, length in _slices(texts):
            hits = []
            for size in sizes:
                at, h = windows(doc, token, kind, maybe, exact, size)
                ok = np.logical_and.reduce([bitmap[b] for b in filter_bits(h)])
                hits.append((at[ok], np.full(int(ok.sum()), size), h[ok].view(np.int64)))
            at, size, h = (np.concatenate(c) for c in zip(*hits))
            if not len(at):
                continue
            order = np.argsort(at, kind="stable")
            at, size, h = at[order], size[order], h[order]
            apart = (np.diff(at) > 2 * reach) | (np.diff(doc[at]) != 0)
            first = np.flatnonzero(np.concatenate(([True], apart)))
            for a, b in zip(first, np.append(first[1:], len(at))):
                d = doc[at[a]]
                lo = max(begin[d], at[a] - reach)
                hi = min(begin[d] + length[d], at[b - 1] + size[a:b].max() + reach)
                seeds = [{"at": int(x - lo), "size": int(n), "hash": int(y)} for x, n, y in zip(at[a:b], size[a:b], h[a:b])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids[k + d]], pa.int64()), pa.array([token[lo:hi].view(np.int64)], pa.list_(pa.int64())),
                     pa.array([(kind + MAYBE * maybe)[lo:hi].astype(np.int32)], pa.list_(pa.int32())),
                     pa.array([values(slice(lo, hi))], pa.list_(pa.string())), pa.array([seeds], _SEED)], names)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from cut(batch.column(0).to_pylist(), batch.column(1).to_pylist())

    return (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
            .filter("text is not null").mapInArrow(
                scan, "doc_id long, tokens array<long>, kinds array<int>, values array<string>,"
                      " seeds array<struct<at:int,size:int,hash:long>>"))


class Text:
    """Template tokens, kinds (MAYBE: plain or a name) and values of an item or of a part of a document."""

    def __init__(self, tokens, kinds, values):
        self.tokens, self.kinds, self.values = tokens, kinds, values
        self.slots = np.flatnonzero(kinds != PLAIN)


def consistent(pairs: set) -> bool:
    """Each value of the item stands for one value of the document."""
    return len({t for t, _ in pairs}) == len(pairs)


def pairs_at(item: Text, part: Text, places, shift: int) -> set:
    """A word that may be a name is one where the other side's is a name or another such word."""
    return {(item.values[k], part.values[k + shift]) for k in places
            if item.kinds[k] != MAYBE or part.kinds[k + shift] == NAME or item.values[k] != part.values[k + shift]}


def same_tokens(item: Text, part: Text, a: int, b: int, shift: int) -> np.ndarray:
    x, y = item.kinds[a:b], part.kinds[a + shift:b + shift]
    return ((item.tokens[a:b] == part.tokens[a + shift:b + shift])
            | (x >= NAME) & (y >= NAME))


def slot_pairs(item: Text, part: Text, i: int, shift: int, n: int) -> set:
    a, b = np.searchsorted(item.slots, [i, i + n])
    return pairs_at(item, part, item.slots[a:b], shift)


def equal_runs(item: Text, part: Text, low: int, high: int) -> list[tuple[int, int, int]]:
    """(place in the item, shift, length) of the runs of at least MIN_RUN equal tokens at some shifts."""
    n, m = len(item.tokens), len(part.tokens)
    found = []
    for shift in range(low, high + 1):
        a, b = max(0, -shift), min(n, m - shift)
        if b - a < MIN_RUN:
            continue
        same = np.concatenate(([0], same_tokens(item, part, a, b, shift), [0]))
        edge = np.flatnonzero(np.diff(same))
        found += [(int(a + x), shift, int(y - x)) for x, y in zip(edge[::2], edge[1::2]) if y - x >= MIN_RUN]
    return sorted(found, key=lambda r: (r[0] + r[1], r[0]))


def chains(item: Text, part: Text, runs: list[tuple[int, int, int]]) -> Iterator[tuple[int, int, set]]:
    """(tokens, longest run with enough plain tokens, slot pairs) of the best consistent chain to each run."""
    plain = np.concatenate(([0], np.cumsum((item.kinds == PLAIN) | (item.kinds == MAYBE))))
    done = []
    for i, shift, n in runs:
        own = slot_pairs(item, part, i, shift, n)
        if not consistent(own):
            continue
        long = n if plain[i + n] - plain[i] >= WINDOW else 0
        best = (n, long, own)
        for j, other, size, (total, longest, pairs) in done:
            # Runs may overlap by words that are equal on both sides of a break: they count once.
            over = max(0, j + size - i, j + size + other - i - shift)
            if j < i and j + other < i + shift and abs(other - shift) <= DRIFT and over < n \
                    and total + n - over > best[0] and consistent(pairs | own):
                best = (total + n - over, max(longest, long), pairs | own)
        done.append((i, shift, n, best))
        yield best


def best_chain(item: Text, part: Text, seeds: list[tuple[int, int, int]], min_coverage: float):
    """(coverage, unchanged, slots) of an item in a part of a document, or None; seeds are (at, item_at, size)."""
    n = len(item.tokens)
    found = []

    def judge(total, longest, pairs):
        if n < MIN_TOKENS and any(t != o for t, o in pairs):
            return
        if total >= max(min_coverage * n, min(n, MIN_HELD)) or longest >= RUN_TOKENS:
            found.append((round(total / n, 6), all(t == o for t, o in pairs), len(pairs)))

    by_shift: dict[int, list] = {}
    for at, item_at, size in seeds:
        by_shift.setdefault(at - item_at, []).append((item_at, size))
    for shift, places in by_shift.items():
        held = np.zeros(n, bool)
        for a, size in places:
            held[a:a + size] = True
        pairs = pairs_at(item, part, [k for k in item.slots if held[k]], shift)
        if consistent(pairs):
            judge(int(held.sum()), 0, pairs)
    if max(found, default=(0,))[:2] == (1.0, True):
        return max(found)
    last = None
    for shift in sorted(by_shift):
        if last is None or shift > last + DRIFT:  # the shifts around a seed; the next seeds are among them
            last = shift
            for chain_ in chains(item, part, equal_runs(item, part, shift - 2 * DRIFT, shift + 3 * DRIFT)):
                judge(*chain_)
    return max(found, default=None)


def _aligned(min_coverage: float):
    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part = Text(np.array(row["tokens"], np.int64), np.array(row["kinds"]), row["values"])
                out = []
                for entry in row["items"]:
                    _, _, token, kind, maybe, _, values, _, _ = next(_slices([entry["text"]]))
                    item = Text(token.view(np.int64), kind + MAYBE * maybe, values(slice(None)))
                    best = best_chain(item, part, [(s["at"], s["item_at"], s["size"]) for s in entry["seeds"]], min_coverage)
                    if best:
                        out.append((row["doc_id"], entry["item_id"], *best))
                if out:
                    d, i, c, same, n = zip(*out)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(d, pa.int64()), pa.array(i, pa.int64()), pa.array(c, pa.float64()),
                         pa.array(same, pa.bool_()), pa.array(n, pa.int64())],
                        ["doc_id", "item_id", "coverage", "same", "n_slots"])
    return scan


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW,
               min_coverage: float = MIN_COVERAGE) -> DataFrame:
    """(doc_id, item_id, coverage, n_slots, reparameterised): documents that hold a benchmark item."""
    # Rows that share an item id are read apart.
    texts = stash(benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text"))
                  .filter("text is not null").withColumn("item_row", F.monotonically_increasing_id()), "benchmark-items")
    items = item_windows(texts, "item_row", "text", window)
    used = items.groupBy("size").agg(F.max("n_tokens").alias("longest")).collect()
    sizes = sorted(r["size"] for r in used) or [window]
    reach = max((r["longest"] for r in used), default=0) + 3 * DRIFT
    # Bounded by the number of bits, not by the benchmark.
    places = F.array(*[F.pmod(F.shiftright("hash", k), F.lit(FILTER_BITS)) for k in PROBES])
    bits = items.select(F.explode(places).alias("bit")).distinct().collect()
    bitmap = np.zeros(FILTER_BITS, bool)
    bitmap[[r["bit"] for r in bits]] = True
    parts = stash(regions(docs, id_col, text_col, sizes, bitmap, reach)
                  .withColumn("part", F.monotonically_increasing_id()), "leak-parts")
    seeds = parts.select("part", F.inline("seeds")).join(
        items.select(F.col("id").alias("item_row"), "hash", "size", F.col("at").alias("item_at")), ["hash", "size"])
    met = (seeds.groupBy("part", "item_row").agg(F.collect_list(F.struct("at", "item_at", "size")).alias("seeds"))
           .join(texts, "item_row").groupBy("part").agg(F.collect_list(F.struct("item_id", "text", "seeds")).alias("items")))
    scored = (parts.drop("seeds").join(met, "part").drop("part").mapInArrow(
        _aligned(min_coverage), "doc_id long, item_id long, coverage double, same boolean, n_slots long"))
    best = F.max(F.struct("coverage", "same", "n_slots"))
    return (scored.groupBy("doc_id", "item_id").agg(best.alias("b"))
            .select("doc_id", "item_id", F.col("b.coverage").alias("coverage"), F.col("b.n_slots").alias("n_slots"),
                    (~F.col("b.same")).alias("reparameterised")))


def remove_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 **options) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    leaks = find_leaks(docs, benchmark, id_col, text_col, **options).select(F.col("doc_id").alias("__leak")).distinct()
    return docs.join(leaks, F.col(id_col).cast("long").eqNullSafe(F.col("__leak")), "left_anti")
