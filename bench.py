"""Benchmark: the reference's three headline timings plus the registered queries.

    BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
    BENCH_RUNS (default 3, median reported), BENCH_WORK (scratch folder).

Headline, as the reference times them:
  shortcut_pnl        P&L straight from the billing rows (read + aggregate)
  full_rebuild        every layer rebuilt for the whole range and written
  incremental_month   one month re-run into tables preloaded with the months
                      before it (preload untimed)
Other queries are forced with a no-op write (full computation, no collect).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from datetime import date

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerflow import Period  # noqa: E402
from ledgerflow.operators import reconcile  # noqa: E402
from ledgerflow.plans import queries as Q  # noqa: E402
from ledgerflow.plans.context import FULL  # noqa: E402
from ledgerflow.plans.pipeline import Warehouse, run_period  # noqa: E402
from ledgerflow.session import build_session, checkpoint_dir  # noqa: E402
from ledgerflow.sources import adapter  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))
PRELOAD = Period(FULL.start, date(2001, 9, 30))
LAST_MONTH = Period.month(2001, 10)
TIMED_QUERIES = ["stg_rides", "quarantine", "general_ledger", "trial_balance",
                 "income_statement_summary", "balance_sheet_summary", "staging_reconciliation",
                 "pnl_reconciliation", "dq_report", "unposted_lines", "fault_impact"]


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def main() -> None:
    work = os.environ.get("BENCH_WORK") or tempfile.mkdtemp(prefix="ledgerflow-bench-")
    spark = build_session(f"local[{CPUS}]", "ledgerflow-bench", shuffle_partitions=CPUS,
                          extra={"spark.driver.memory": "16g",
                                 "spark.checkpoint.dir": os.path.join(work, "checkpoints")})
    checkpoint_dir(spark)
    books = adapter.adapter_books(spark, SF_DIR)
    rides_n = books.rides.count()  # warm-up: JVM, parquet footers, code paths

    def shortcut():
        reconcile.direct_income_statement(books.rides, books.rules, books.accounts).collect()

    run_id = [0]

    def fresh_wh() -> Warehouse:
        run_id[0] += 1
        return Warehouse(spark, os.path.join(work, f"wh{run_id[0]}"))

    def full():
        run_period(spark, books, FULL, fresh_wh(), gate="off", full_refresh=True)

    def incremental() -> float:
        wh = fresh_wh()
        run_period(spark, books, PRELOAD, wh, gate="off", full_refresh=True)
        return timed(lambda: run_period(spark, books, LAST_MONTH, wh, gate="off"))

    shortcut()  # untimed warm-up of the shortcut plan (the other two take the median of 3)
    head = {
        "shortcut_pnl": statistics.median(timed(shortcut) for _ in range(RUNS)),
        "full_rebuild": statistics.median(timed(full) for _ in range(RUNS)),
        "incremental_month": statistics.median(incremental() for _ in range(RUNS)),
    }
    per_query = {}
    for name in TIMED_QUERIES:
        fn = Q.QUERIES[name]
        per_query[name] = timed(
            lambda fn=fn: fn(spark, SF_DIR).write.format("noop").mode("overwrite").save())
    out = {
        "metric": "headline_total_sec",
        "value": round(sum(head.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in {**head, **per_query}.items()},
        "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
        "rides": rides_n,
        "cpus": CPUS,
        "runs": RUNS,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
