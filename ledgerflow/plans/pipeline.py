"""Period runner: build every layer for one period into stored tables, gated.

``run_period`` is the monthly job: staging -> journal -> ledger -> trial
balance -> reports. Each layer is computed from the stored table of the layer
before (month partitions pruned to the period), written with period
replacement, and checked before the next layer starts. ``backfill`` runs it
month by month; ``full_refresh=True`` rebuilds every table from scratch.

Lineage is cut at every layer by the written tables themselves, so a lost
executor only recomputes the layer being built.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerflow.operators import balances, journal, posting, quality, staging, statements
from ledgerflow.periods import Period
from ledgerflow.session import FREE_SHUFFLES, checkpoint_dir, settings
from ledgerflow.sources.adapter import Books
from ledgerflow.sources.closing import ClosingBalances
from ledgerflow.sources.orderstate import OrderState
from ledgerflow.sources.sinks import PeriodTable, rows_by_month

# Stored tables and the date column their period replacement deletes by.
TABLES = {
    "stg_rides": "ride_date",
    "stg_rides_quarantine": "ride_date",
    "int_journal_entries": "ride_date",
    "fct_general_ledger": "ride_date",
    "fct_trial_balance": "reporting_period",
    "rpt_income_statement_detail": "period_end",
    "rpt_income_statement_summary": "period_end",
    "rpt_balance_sheet_detail": "report_date",
    "rpt_balance_sheet_summary": "report_date",
}
# Unique keys: rows whose key arrives again are replaced, whatever month they are in. The other
# tables' keys hold the column that the period replacement deletes by.
KEYS = {
    "stg_rides": ["order_id"],
    "stg_rides_quarantine": ["quarantine_id"],
    "int_journal_entries": ["journal_entry_id"],
    "fct_general_ledger": ["journal_entry_id"],
}
# Tables with one row per month and account: a run rebuilds the months it touches.
MONTHLY = frozenset(["fct_trial_balance"])

GATE_MODES = ("stop", "warn", "off")
# A task writes up to so many months at a time as their rows come, instead of sorting the rows by month first.
SETTINGS = {**FREE_SHUFFLES, "spark.sql.maxConcurrentOutputFileWriters": "100"}


@dataclass
class Warehouse:
    """Where the stored tables live, and the shared folder for staged writes."""

    spark: SparkSession
    root: str
    work_dir: str | None = None
    whole_months: bool = False

    def __post_init__(self):
        if self.work_dir is None:
            self.work_dir = checkpoint_dir(self.spark)

    def table(self, name: str) -> PeriodTable:
        return PeriodTable(self.spark, f"{self.root}/{name}", TABLES[name], self.work_dir,
                           self.whole_months or name in MONTHLY, KEYS.get(name))

    def order_state(self) -> OrderState:
        return OrderState(self.spark, f"{self.root}/order_state")

    def closing_balances(self) -> ClosingBalances:
        # Beside the layers: carried from the trial balance, never gated, rebuilt where it is stale.
        table = PeriodTable(self.spark, f"{self.root}/closing_balances", "reporting_period", self.work_dir, True)
        return ClosingBalances(table, self.table("fct_trial_balance"))

    def read(self, name: str) -> DataFrame:
        return self.table(name).read()


@dataclass
class RunResult:
    period: Period
    reports: dict[str, list[tuple]] = field(default_factory=dict)
    # Row-wise check counts of each table, taken while it was written.
    seen: dict = field(default_factory=dict, repr=False)

    @property
    def failing(self) -> list[tuple]:
        return [r for rows in self.reports.values() for r in rows if r[3] > 0]


def _store(wh: Warehouse, name: str, df: DataFrame, period: Period, full_refresh: bool,
           watch: Callable[[str, DataFrame], DataFrame], by_month: bool = False) -> DataFrame:
    t = wh.table(name)
    df = watch(name, df)
    if full_refresh:
        t.overwrite(df, by_month=by_month)
    else:
        t.replace(df, period, by_month=by_month)
    months = period.months()
    return t.read_months(months[0].start, months[-1].start, df.schema)


def _together(*jobs):
    """Run independent writes as concurrent Spark jobs (they share the cores
    instead of queueing); results in order, the first error is raised."""
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        futures = [pool.submit(j) for j in jobs]
        return [f.result() for f in futures]


def _prepare_source(spark: SparkSession, books: Books, period: Period, wh: Warehouse,
                    full_refresh: bool) -> tuple[DataFrame, str | None]:
    """Write the staging input once to the shared work folder and read it back.

    Staging deduplicates over whole orders. With a first-seen state a period run needs the
    period's rows only; without one (rides that come from no files) every source row of the orders
    that occur in the period (a null-safe semi join). The quarantine needs the period rows. Writing
    it cuts the lineage and spares both outputs from re-deriving the source. A full refresh shuffles
    rides of files once for both outputs, so these are read where they are.
    """
    rides = books.rides
    if full_refresh and books.source:
        return rides, None
    if full_refresh:
        needed = rides
    elif books.source:
        needed = rides.where(staging.in_period_by_start(period))
    else:
        needed = staging.orders_touching(rides, period)
    path = f"{wh.work_dir}/run-source-{uuid.uuid4().hex}"
    needed.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(rides.schema).parquet(path), path


def _store_sorted_out(wh: Warehouse, source: DataFrame, period: Period, ts: Column,
                      watch: Callable[..., DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Full refresh of staged rides and quarantine: one pass sorts the rides out and one job writes both tables.

    The job writes to a folder beside the tables, which takes each table's share over by a rename; a run that
    dies before leaves it unread.
    """
    rows = staging.sorted_out(source, period)
    schemas = {"stg_rides": staging.staged_projection(rows).withColumn("loaded_at", ts).schema,
               "stg_rides_quarantine": staging.rejected_projection(rows).withColumn("quarantined_at", ts).schema}
    table, month = "_table", PeriodTable.MONTH_COL
    staged = F.col("rejection_reason").isNull()
    both = (staging.both_projections(rows_by_month(rows, "start_time"))
            .withColumn("loaded_at", F.when(staged, ts)).withColumn("quarantined_at", F.when(~staged, ts))
            .withColumn(table, F.when(staged, F.lit("stg_rides")).otherwise(F.lit("stg_rides_quarantine")))
            .withColumn(month, F.trunc("ride_date", "month")))
    for name in schemas:
        both = watch(name, both, F.col(table) == name)
    path = f"{wh.root}/sorted-out-{uuid.uuid4().hex}"
    both.write.option("compression", "zstd").partitionBy(table, month).parquet(path)
    months = period.months()
    out = []
    for name, schema in schemas.items():
        t = wh.table(name)
        t.take_over(f"{path}/{table}={name}", schema)
        out.append(t.read_months(months[0].start, months[-1].start, schema))
    _drop(wh.spark, path)
    return out[0], out[1]


def _drop(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _whole_months(period: Period) -> bool:
    months = period.months()
    return period.start == months[0].start and period.end == months[-1].end


def _gate(result: RunResult, layer: str, tables: dict, books: Books, mode: str, wh: Warehouse) -> None:
    """Check a layer before the next is built.

    Uniqueness is checked against all stored months through the key index; every other check is
    additive over rows, and rows outside the period stand as earlier runs have checked them.
    Row-wise checks were counted while the layer was written.
    """
    if mode == "off":
        return
    keyed = [m for m in tables if m in KEYS]
    found = _together(*[lambda m=m: wh.table(m).duplicate_keys(result.period) for m in keyed]) if keyed else []
    repeated = dict(zip(keyed, found))
    rows = quality.layer_rows(layer, tables, books.countries, result.seen, repeated)
    result.reports[layer] = rows
    failing = [r for r in rows if r[3] > 0]
    if failing and mode == "stop":
        raise quality.QualityError(failing)


def run_period(spark: SparkSession, books: Books, period: Period, warehouse: Warehouse,
               run_ts: datetime | None = None, gate: str = "stop",
               full_refresh: bool = False) -> RunResult:
    """Build (or rebuild) one period in every stored table.

    ``gate="stop"`` raises ``QualityError`` at the first layer with failing
    checks, before the next layer is built; ``"warn"`` records and goes on.
    Each table's new version becomes visible by one commit; a run that dies leaves every table
    at one version or the next.
    """
    if gate not in GATE_MODES:
        raise ValueError(f"gate must be one of {GATE_MODES}")
    # Key indexes and the first-seen state are built beside the layers; the run waits for them.
    with settings(spark, SETTINGS), ThreadPoolExecutor(max_workers=3) as later:
        pending: list[Future] = []
        result = _build(spark, books, period, warehouse, run_ts, gate, full_refresh, later, pending)
        for job in pending:
            job.result()
    return result


def _build(spark: SparkSession, books: Books, period: Period, warehouse: Warehouse, run_ts: datetime | None,
           gate: str, full_refresh: bool, later: ThreadPoolExecutor, pending: list[Future]) -> RunResult:
    def watch(name: str, df: DataFrame, of: Column | None = None) -> DataFrame:
        if gate != "off":
            df, seen = quality.watch(name, df, books.countries, of)
            if seen is not None:
                res.seen[name] = seen
        return df

    def index(*names: str) -> None:
        if gate == "off":  # else the gate has built them
            pending.extend(later.submit(wh.table(n).build_index) for n in names)

    ts = F.lit(run_ts or datetime.now())
    res = RunResult(period)
    wh = warehouse
    in_period = period.contains(F.col("ride_date"))

    # staging: both outputs come from one pass on a full refresh, else they read one materialized input
    known = later.submit(wh.order_state().refresh, books.source) if books.source else None
    pending.extend([known] if known else [])
    source, source_path = _prepare_source(spark, books, period, wh, full_refresh)

    def store_staged():
        staged = staging.stage_rides(source, period)
        if known:
            known.result()
            staged = wh.order_state().first_seen_in(staged, period)
        return _store(wh, "stg_rides", staged.withColumn("loaded_at", ts), period, False, watch)

    def store_rejected():
        rejected = staging.quarantine_rides(source, period)
        return _store(wh, "stg_rides_quarantine", rejected.withColumn("quarantined_at", ts), period, False, watch)

    stg, qua = (_store_sorted_out(wh, source, period, ts, watch) if full_refresh
                else _together(store_staged, store_rejected))
    if source_path:
        _drop(spark, source_path)
    index("stg_rides", "stg_rides_quarantine")
    # reference tables: size-checked once per run, then broadcast by hint
    rules = posting.bounded_broadcast(posting.posting_rules(books.rules))
    accounts = posting.bounded_broadcast(posting.chart_of_accounts(books.accounts))
    _gate(res, "staging", {"stg_rides": stg.where(in_period),
                           "stg_rides_quarantine": qua.where(in_period),
                           "stg_account_mapping": rules, "stg_chart_of_accounts": accounts},
          books, gate, wh)

    # intermediate and ledger. Under a stopping gate the ledger waits for the
    # journal's checks; otherwise both are derived from the stored staged rows
    # (the explosion is narrow, cheap to repeat) and written concurrently. The stored rows lie by
    # month already: what is derived from them row by row is written as it lies, without a shuffle.
    rides = stg.where(in_period)
    jr_fresh = journal.journal_entries(rides)
    if gate == "stop":
        jr = _store(wh, "int_journal_entries", jr_fresh.withColumn("loaded_at", ts), period,
                    full_refresh, watch, by_month=True)
        _gate(res, "intermediate", {"int_journal_entries": jr.where(in_period)}, books, gate, wh)
        gl_fresh = posting.general_ledger(jr.where(in_period).drop("loaded_at"), rules, accounts,
                                          broadcast_check=False)
        gl = _store(wh, "fct_general_ledger", gl_fresh.withColumn("loaded_at", ts), period,
                    full_refresh, watch, by_month=True)
    else:
        gl_fresh = posting.general_ledger(jr_fresh, rules, accounts, broadcast_check=False)
        jobs = [
            lambda: _store(wh, "int_journal_entries", jr_fresh.withColumn("loaded_at", ts), period,
                           full_refresh, watch, by_month=True),
            lambda: _store(wh, "fct_general_ledger", gl_fresh.withColumn("loaded_at", ts), period,
                           full_refresh, watch, by_month=True)]
        # For whole months the stored ledger of those months is exactly the
        # fresh one, so the trial balance can be built alongside.
        if _whole_months(period):
            jobs.append(lambda: _store(wh, "fct_trial_balance",
                                       balances.trial_balance(gl_fresh, period), period,
                                       full_refresh, watch))
        done = _together(*jobs)
        jr, gl = done[0], done[1]
        _gate(res, "intermediate", {"int_journal_entries": jr.where(in_period)}, books, gate, wh)
    index("int_journal_entries", "fct_general_ledger")
    _gate(res, "general_ledger", {"fct_general_ledger": gl.where(in_period)}, books, gate, wh)

    if gate == "stop" or not _whole_months(period):
        tb = balances.trial_balance(gl.drop("loaded_at"), period)
        tb = _store(wh, "fct_trial_balance", tb, period, full_refresh, watch)
    else:
        tb = done[2]
    _gate(res, "trial_balance", {"fct_trial_balance": tb}, books, gate, wh)

    # reports: income statement on the period's months, balance sheet on the balances carried to its end
    at_end = wh.closing_balances().as_of(period.months()[-1].start)
    isd, bsd = _together(
        lambda: _store(wh, "rpt_income_statement_detail",
                       statements.income_statement_detail(tb, period), period, full_refresh, watch),
        lambda: _store(wh, "rpt_balance_sheet_detail",
                       statements.balance_sheet_detail(at_end, period), period, full_refresh, watch))
    pending.append(later.submit(wh.closing_balances().refresh))
    iss, bss = _together(
        lambda: _store(wh, "rpt_income_statement_summary",
                       statements.income_statement_summary(isd, period), period, full_refresh, watch),
        lambda: _store(wh, "rpt_balance_sheet_summary",
                       statements.balance_sheet_summary(bsd, period), period, full_refresh, watch))
    on_end = period.contains(F.col("period_end"))
    on_report = period.contains(F.col("report_date"))
    _gate(res, "reports", {"rpt_income_statement_detail": isd.where(on_end),
                           "rpt_income_statement_summary": iss.where(on_end),
                           "rpt_balance_sheet_detail": bsd.where(on_report),
                           "rpt_balance_sheet_summary": bss.where(on_report)}, books, gate, wh)
    return res


def backfill(spark: SparkSession, books: Books, period: Period, warehouse: Warehouse,
             run_ts: datetime | None = None, gate: str = "stop") -> list[RunResult]:
    """The monthly run for each month of the period, in order, one at a time."""
    return [run_period(spark, books, m, warehouse, run_ts, gate) for m in period.months()]
