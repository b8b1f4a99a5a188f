"""Fault injection as Spark transforms, to test the guardrails and gates at scale.

Each fault hits exactly ``max(1, floor(rows x rate))`` rows, chosen without
replacement by a seeded hash of the row key: the rows with the smallest
``md5(order_id|ride_id|seed-fault)`` (ties broken by the whole row).

Picking the smallest n hashes never sorts the table. The hash prefix space
is narrowed with 256-way histograms (one small aggregate per round, at most
256 rows a fault to the driver) until the boundary prefix holds few rows or is one
whole hash; every row below the boundary prefix is hit. The boundary rows are
counted by content and ranked by a distributed running sum, so any number of
rows may share the boundary hash, equal rows included.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from decimal import ROUND_FLOOR, Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerflow import schemas as S
from ledgerflow.operators import staging
from ledgerflow.operators.ranking import running_sum
from ledgerflow.operators.staging import order_columns, ride_order
from ledgerflow.session import keep, store

# Stop narrowing once the boundary prefix holds at most this many rows (more where one hash does).
BOUNDARY_ROWS = 20_000
# Digits of a hash that are written beside the rows several faults pick among; where they do not tell
# enough rows apart, further digits are hashed again.
HEAD = 4


def fault_count(rows: int, rate: float) -> int:
    return max(1, int((Decimal(rows) * Decimal(str(rate))).to_integral_value(ROUND_FLOOR)))


def pick_hash(seed_text: str) -> Column:
    key = F.concat(F.coalesce(F.col("order_id").cast("string"), F.lit("_null_")), F.lit("|"),
                   F.coalesce(F.col("ride_id").cast("string"), F.lit("_null_")), F.lit("|"),
                   F.lit(seed_text))
    return F.md5(key)


def _boundaries(ids: DataFrame, wanted: dict[str, int], heads: dict[str, str] | None = None) -> dict[str, tuple[str, int]]:
    """Per seed text and its n: prefix P and count m such that rows with hash < P number n - m and the
    n-th smallest hash starts with P (P holds at most BOUNDARY_ROWS rows, or is a whole hash).

    All seeds are narrowed together, one scan a round. ``heads`` names columns of ``ids`` that hold the
    first HEAD digits of a seed's hash.
    """
    heads = heads or {}
    found, narrowing, width = {}, {text: ("", n) for text, n in wanted.items()}, 0
    while narrowing:
        width += 2
        texts = list(narrowing)
        names = [f"_{i}" for i in range(len(texts))]
        hashes = ids.select(*[(F.col(heads[t]) if t in heads and width <= HEAD else pick_hash(t)).alias(name)
                              for name, t in zip(names, texts)])
        digits = [F.when(F.col(name).startswith(narrowing[t][0]), F.substring(name, 1, width)).alias(name)
                  for name, t in zip(names, texts)]
        rows = (hashes.select(*digits).unpivot([], names, "_seed", "_p").where(F.col("_p").isNotNull())
                .groupBy("_seed", "_p").agg(F.count(F.lit(1)).alias("_n")).collect())
        for name, text in zip(names, texts):
            remaining = narrowing.pop(text)[1]
            for p, c in sorted((r["_p"], r["_n"]) for r in rows if r["_seed"] == name):
                if c >= remaining:
                    if c <= BOUNDARY_ROWS or width >= 32:
                        found[text] = p, remaining
                    else:
                        narrowing[text] = p, remaining
                    break
                remaining -= c
            else:  # fewer rows than asked for: every row is hit
                found[text] = "g", 0
    return found


def mark_picks(df: DataFrame, rate: float, seed_text: str) -> DataFrame:
    """``df`` with a boolean ``_hit`` column on exactly the picked rows."""
    # count, histogram rounds, the boundary and the final pass all read df
    df = keep(df)
    bound = _boundaries(df, {seed_text: fault_count(df.count(), rate)})[seed_text]
    return _marked(df, bound, seed_text, "_hit", ride_order())


def _marked(df: DataFrame, bound: tuple[str, int], seed_text: str, hit: str, order: list[Column],
            settle: bool = False) -> DataFrame:
    """``df`` with its hash ``_h`` and ``hit`` on the rows below the boundary and, of the rows on it,
    on the first m by (hash, ``order``)."""
    prefix, m = bound
    hashed = df.withColumn("_h", pick_hash(seed_text))
    h = F.col("_h")
    rest = hashed.where(~h.startswith(prefix)).withColumn(hit, h < F.lit(prefix))
    edge = hashed.where(h.startswith(prefix)).groupBy("_h", *df.columns).agg(F.count(F.lit(1)).alias("_copies"))
    upto = running_sum(edge, [], [h.asc(), *order], "_copies", "_upto")
    hits = F.greatest(F.lit(0).cast("bigint"), F.least(F.col("_copies"), F.lit(m) - (F.col("_upto") - F.col("_copies"))))
    parts = F.array(F.struct(F.lit(True).alias(hit), hits.alias("_n")),
                    F.struct(F.lit(False).alias(hit), (F.col("_copies") - hits).alias("_n")))
    marked = (upto.select("_h", *df.columns, F.inline(parts)).where(F.col("_n") > 0)
              .withColumn("_n", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_n"))))).select(*rest.columns)
    # The boundary is small; written, a frame that is marked again and again does not rank it anew.
    return rest.unionByName(store(marked, "boundary") if settle else marked)


def fault_sample(df: DataFrame, rate: float, seed_text: str) -> DataFrame:
    return mark_picks(df, rate, seed_text).where("_hit").select(
        "order_id", "ride_id", F.col("_h").alias("pick_hash"))


def _apply(df: DataFrame, rate: float, seed_text: str, change: dict) -> DataFrame:
    marked = mark_picks(df, rate, seed_text)
    hit = F.col("_hit")
    cols = [F.when(hit, change[c]).otherwise(F.col(c)).alias(c) if c in change else F.col(c)
            for c in df.columns]
    return marked.select(*cols)


def inject_null(df: DataFrame, rate: float = S.FAULT_RATES["null"], seed=S.FAULT_SEED) -> DataFrame:
    """Null the three money columns of the picked rows."""
    null = {c: F.lit(None).cast(df.schema[c].dataType) for c in S.MONEY_COLUMNS}
    return _apply(df, rate, f"{seed}-null", null)


def inject_outlier(df: DataFrame, rate: float = S.FAULT_RATES["outlier"], seed=S.FAULT_SEED) -> DataFrame:
    """Shift the decimal point of the picked rows' money columns two places to the right."""
    times = {c: (F.col(c) * 100).cast(df.schema[c].dataType) for c in S.MONEY_COLUMNS}
    return _apply(df, rate, f"{seed}-outlier", times)


def inject_duplicate(df: DataFrame, rate: float = S.FAULT_RATES["duplicate"], seed=S.FAULT_SEED) -> DataFrame:
    """The table with the picked rows in it twice, as an event delivered again leaves them."""
    marked = mark_picks(df, rate, f"{seed}-duplicate")
    return df.unionByName(marked.where("_hit").select(*df.columns))


def inject_country(df: DataFrame, rate: float = S.FAULT_RATES["country"], seed=S.FAULT_SEED,
                   value: str = S.FAULT_COUNTRY) -> DataFrame:
    """Replace the country of the picked rows with a value no rule accepts."""
    return _apply(df, rate, f"{seed}-country", {"country": F.lit(value)})


FAULTS = {
    "null": inject_null,
    "outlier": inject_outlier,
    "duplicate": inject_duplicate,
    "country": inject_country,
}


def inject_faults(df: DataFrame, faults=tuple(S.DEFAULT_FAULTS), seed=S.FAULT_SEED,
                  rates: dict | None = None) -> DataFrame:
    """Apply the named faults in order; each one picks among the rows left by
    the previous ones, so hits may overlap (a nulled row may be duplicated)."""
    rates = {**S.FAULT_RATES, **(rates or {})}
    unknown = [f for f in faults if f not in FAULTS]
    if unknown:
        raise ValueError(f"unknown fault type(s) {unknown}; valid: {list(FAULTS)}")
    faults = tuple(faults)
    while faults:
        # up to a duplicate, which changes the rows that later faults pick among, one written table serves all
        upto = faults.index("duplicate") + 1 if "duplicate" in faults else len(faults)
        df = fault_scenarios(df, {"": faults[:upto]}, seed, rates).drop(SCENARIO)
        faults = faults[upto:]
    return df


SCENARIO = "scenario"


def _changes(fault: str) -> list[str]:
    """The columns that a fault changes."""
    return {"duplicate": [], "country": ["country"]}.get(fault, S.MONEY_COLUMNS)


def _changed(fault: str, cols: dict[str, Column], df: DataFrame) -> dict[str, Column]:
    """What a fault makes of the columns of a row it hits."""
    if fault == "null":
        return {c: F.lit(None).cast(df.schema[c].dataType) for c in S.MONEY_COLUMNS}
    if fault == "outlier":
        return {c: (cols[c] * 100).cast(df.schema[c].dataType) for c in S.MONEY_COLUMNS}
    return {"country": F.lit(S.FAULT_COUNTRY)}


def fault_scenarios(rides: DataFrame, chains: dict[str, tuple[str, ...]], seed=S.FAULT_SEED,
                    rates: dict | None = None) -> DataFrame:
    """``rides`` as every chain of faults leaves them, in one table with the chain's name in ``scenario``."""
    return scenarios(rides, chains, seed, rates).rows()


@dataclass(frozen=True)
class Scenarios:
    """Rides and what every chain of faults makes of them (see ``scenarios``)."""

    columns: list[str]
    chains: dict[str, tuple[str, ...]]
    # the rides and those on the boundary of a fault; the latter with their marks
    base: DataFrame
    edge: DataFrame | None
    # per fault: the column with the head of its hash, and the boundary's prefix
    heads: dict[str, str]
    prefixes: dict[str, str]
    # per beginning of a chain: the column that marks the rides its last fault hits
    marks: dict[tuple[str, ...], str]
    # per chain: what it makes of each column
    views: dict[str, dict[str, Column]]

    def on_boundary(self, faults) -> Column:
        on = F.lit(False)
        for f in faults:
            on = on | F.col(self.heads[f]).startswith(self.prefixes[f][:HEAD])
        return on

    def _marked(self, marks: dict[tuple[str, ...], str]) -> DataFrame:
        """All rides with the given marks."""
        if not marks:
            return self.base.select(*self.columns)
        faults = sorted({chain[-1] for chain in marks})
        hit = {mark: F.col(self.heads[chain[-1]]) < F.lit(self.prefixes[chain[-1]][:HEAD]) for chain, mark in marks.items()}
        return (self.base.where(~self.on_boundary(faults)).withColumns(hit).select(*self.columns, *hit)
                .unionByName(self.edge.where(self.on_boundary(faults)).select(*self.columns, *hit)))

    def rows(self) -> DataFrame:
        """The rows of every scenario, with its name."""
        out = []
        for name, chain in self.chains.items():
            marked = self._marked({chain[:i + 1]: self.marks[chain[:i + 1]] for i in range(len(chain))})
            if chain[-1:] == ("duplicate",):
                copies = F.when(F.col(self.marks[chain]), F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
                marked = marked.withColumn("_copy", F.explode(copies))
            out.append(marked.select(F.lit(name).alias(SCENARIO), *[v.alias(c) for c, v in self.views[name].items()]))
        return reduce(DataFrame.unionByName, out)

    def _chosen(self, marked: DataFrame, names: Column) -> DataFrame:
        """The rows of the scenarios in the array ``names`` of each ride."""
        rows = marked.withColumn(SCENARIO, F.explode(names))
        scenario = F.col(SCENARIO)
        twice = F.lit(False)
        for name, chain in self.chains.items():
            if chain[-1:] == ("duplicate",):
                twice = twice | (scenario.eqNullSafe(F.lit(name)) & F.col(self.marks[chain]))
        rows = rows.withColumn("_copy", F.explode(F.when(twice, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
        changed = {}
        for c in self.columns:
            value = F.col(c)
            for name, chain in self.chains.items():
                if any(c in _changes(f) for f in chain):
                    value = F.when(scenario == name, self.views[name][c]).otherwise(value)
            changed[c] = value
        return rows.select(SCENARIO, *[v.alias(c) for c, v in changed.items()])

    def by_order(self) -> list[DataFrame]:
        """The rows of every scenario, the orders that no fault hits only once, under no scenario's name.

        Such an order's rows are the same in all scenarios, and so is what is made of them order by order:
        ``each`` gives it to every scenario. The rides are shuffled once, by order, for all scenarios. The frames
        share no order; crowded orders are in one of their own, which is not shuffled here.
        """
        marked = self._marked(self.marks)
        hit = F.lit(False)
        for mark in self.marks.values():
            hit = hit | F.col(mark)
        names = F.array(*[F.lit(n) for n in self.chains])
        crowded = staging.crowded_buckets(self.base)
        spread = staging.in_buckets(crowded)
        rest = marked.where(~spread) if crowded else marked
        touched = F.max(hit).over(Window.partitionBy("order_id"))
        rest = rest.repartition("order_id").withColumn("_touched", touched)
        out = [self._chosen(rest, F.when(F.col("_touched"), names).otherwise(F.array(F.lit(None).cast("string"))))]
        return [*out, self._chosen(marked.where(spread), names)] if crowded else out

    def each(self, df: DataFrame) -> DataFrame:
        """Rows under no scenario's name stand in every scenario."""
        scenario = F.col(SCENARIO)
        names = F.when(scenario.isNull(), F.array(*[F.lit(n) for n in self.chains])).otherwise(F.array(scenario))
        return df.withColumn(SCENARIO, F.explode(names))


def scenarios(rides: DataFrame, chains: dict[str, tuple[str, ...]], seed=S.FAULT_SEED,
              rates: dict | None = None) -> Scenarios:
    """``rides`` and what every chain of faults makes of them.

    The rows of a scenario are those of ``inject_faults(rides, chain)``. No fault but the duplicate
    changes the number of rows, and none the ids that picks are hashed from, so the rides are written
    once with the first digits of their hashes, the picks of all faults are found in common scans, and
    whether a fault hits a ride is read off these digits. Only the few rides on a fault's boundary are ranked; they are marked in a small table
    of their own. Each scenario is a projection of both. A duplicate has to be its chain's last fault.
    """
    rates = {**S.FAULT_RATES, **(rates or {})}
    unknown = sorted({f for chain in chains.values() for f in chain} - set(FAULTS))
    if unknown:
        raise ValueError(f"unknown fault type(s) {unknown}; valid: {list(FAULTS)}")
    if any("duplicate" in chain[:-1] for chain in chains.values()):
        raise ValueError("a duplicate has to be the last fault of its chain")
    texts = {f: f"{seed}-{f}" for chain in chains.values() for f in chain}
    heads = {text: f"_head{i}" for i, text in enumerate(texts.values())}
    base = keep(rides.withColumns({head: F.substring(pick_hash(text), 1, HEAD) for text, head in heads.items()}))
    rows = base.count() if texts else 0
    bounds = _boundaries(base, {text: fault_count(rows, rates[f]) for f, text in texts.items()}, heads)

    marks, views = {}, {}
    found = Scenarios(rides.columns, dict(chains), base, None, {f: heads[t] for f, t in texts.items()},
                      {f: bounds[t][0] for f, t in texts.items()}, marks, views)
    edge = store(base.where(found.on_boundary(texts)), "boundaries") if texts else None
    for name, chain in chains.items():
        view = {c: F.col(c) for c in rides.columns}
        for i, fault in enumerate(chain):
            mark = marks.get(chain[:i + 1])
            if mark is None:
                mark = marks[chain[:i + 1]] = f"_mark{len(marks)}"
                # Rows with one hash are ranked as the faults before have left them, then as they were.
                order = [view[c].asc_nulls_last() for c in order_columns()]
                told_apart = [*ride_order(), *[F.col(m).asc() for m in edge.columns if m.startswith("_mark")]]
                edge = _marked(edge, bounds[texts[fault]], texts[fault], mark, [*order, *told_apart],
                               settle=True).drop("_h")
            if fault != "duplicate":
                view = view | {c: F.when(F.col(mark), new).otherwise(view[c])
                               for c, new in _changed(fault, view, rides).items()}
        views[name] = view
    return replace(found, edge=edge)
