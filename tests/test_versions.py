"""Stored tables: commits that happen whole or not at all, replacement by key, keys over all months,
and the first-seen state of orders."""

import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from ledgerflow import Period
from ledgerflow import schemas as S
from ledgerflow.operators import quality, staging
from ledgerflow.plans.pipeline import Warehouse, _gate, RunResult
from ledgerflow.sources import sinks
from ledgerflow.sources.files import read_rides, ride_files, write_csv
from ledgerflow.sources.orderstate import OrderState
from ledgerflow.sources.sinks import PeriodTable
from ledgerflow.sources.versions import CommitConflict
from tests import fixtures

JAN, FEB = Period.month(2026, 1), Period.month(2026, 2)
SCHEMA = "k string, d date, v int"


def make(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows_of(df):
    return sorted(((r.k, r.d, r.v) for r in df.collect()), key=str)


def files_of(path):
    return sorted(os.path.join(a, f) for a, _, fs in os.walk(os.path.join(path, "data")) for f in fs if f.endswith(".parquet"))


class Killed(RuntimeError):
    pass


class Dying(PeriodTable):
    """A table whose writer dies when it comes to one step."""

    dies_at = None

    def step(self, name):
        if name == self.dies_at:
            raise Killed(name)


OLD = [("a", date(2026, 1, 5), 1), ("b", date(2026, 1, 20), 1), ("c", date(2026, 2, 5), 1), ("m", date(2026, 3, 5), 1),
       ("n", date(2026, 3, 6), 1), (None, date(2026, 3, 7), 1)]
# inside half of January: b again, m moved here from March, a null key
FRESH = [("b", date(2026, 1, 21), 2), ("m", date(2026, 1, 22), 2), (None, date(2026, 1, 23), 2)]
HALF = Period(date(2026, 1, 15), date(2026, 1, 31))
AFTER = [("a", date(2026, 1, 5), 1), ("c", date(2026, 2, 5), 1), ("n", date(2026, 3, 6), 1), (None, date(2026, 3, 7), 1), *FRESH]


@pytest.mark.parametrize("step", ["write", "find keys", "rewrite", "commit"])
def test_a_run_that_dies_leaves_the_version_before(spark, workdir, step):
    path = os.path.join(workdir, "t")
    t = Dying(spark, path, "d", keys=["k"])
    t.overwrite(make(spark, OLD))
    reader = t.read()
    t.dies_at = step
    with pytest.raises(Killed):
        t.replace(make(spark, FRESH), HALF)
    assert rows_of(PeriodTable(spark, path, "d").read()) == rows_of(make(spark, OLD))
    t.dies_at = None
    t.replace(make(spark, FRESH), HALF)
    assert rows_of(t.read()) == rows_of(make(spark, AFTER))
    assert rows_of(reader) == rows_of(make(spark, OLD))  # pinned to its version
    t.vacuum()
    assert rows_of(t.read()) == rows_of(make(spark, AFTER))
    assert len(os.listdir(os.path.join(path, "data"))) <= 3


def test_a_full_refresh_that_dies_leaves_the_version_before(spark, workdir):
    t = Dying(spark, os.path.join(workdir, "t"), "d", keys=["k"])
    t.overwrite(make(spark, OLD))
    for step in ("write", "commit"):
        t.dies_at = step
        with pytest.raises(Killed):
            t.overwrite(make(spark, FRESH))
        assert rows_of(t.read()) == rows_of(make(spark, OLD))


def test_versions_stay_readable_until_vacuum(spark, workdir):
    t = PeriodTable(spark, os.path.join(workdir, "t"), "d", keys=["k"])
    t.overwrite(make(spark, OLD))
    t.replace(make(spark, FRESH), HALF)
    assert t.versions.numbers() == [1, 2]
    assert rows_of(t.read(version=1)) == rows_of(make(spark, OLD))
    t.vacuum()
    assert t.versions.numbers() == [2]
    assert rows_of(t.read()) == rows_of(make(spark, AFTER))
    t.replace(make(spark, []), Period(date(2026, 1, 1), date(2026, 3, 31)))  # still indexed and replaceable
    assert rows_of(t.read()) == []


def test_a_commit_after_another_fails(spark, workdir):
    t = PeriodTable(spark, os.path.join(workdir, "t"), "d")
    t.overwrite(make(spark, OLD))
    seen = t.versions.load()
    t.replace(make(spark, []), FEB)
    with pytest.raises(CommitConflict):
        t.versions.commit({"schema": seen["schema"], "months": {}}, seen)
    assert rows_of(t.read()) == rows_of(make(spark, [r for r in OLD if r[1].month != 2]))


def test_only_files_with_incoming_keys_are_rewritten(spark, workdir):
    path = os.path.join(workdir, "t")
    t = PeriodTable(spark, path, "d", keys=["k"])
    t.overwrite(make(spark, [(f"jan{k}", date(2026, 1, 5), k) for k in range(50)]))
    t.replace(make(spark, [(f"feb{k}", date(2026, 2, 5), k) for k in range(50)]), FEB)
    t.replace(make(spark, [(f"mar{k}", date(2026, 3, 5), k) for k in range(50)]), Period.month(2026, 3))
    before = files_of(path)
    t.replace(make(spark, [("feb7", date(2026, 4, 5), 100)]), Period.month(2026, 4))
    manifest = t.versions.load()
    gone = {m: [n for e in entries for n in e["except"]] for m, entries in manifest["months"].items()}
    assert {m for m, names in gone.items() if names} == {"_month=2026-02-01"}
    assert set(before) <= set(files_of(path))  # nothing is overwritten
    assert len(files_of(path)) == len(before) + 2  # the fresh row, and what stays of February's file
    got = {r.k: r.v for r in t.read().collect()}
    assert len(got) == 150 and got["feb7"] == 100 and got["jan7"] == 7
    # unmoved keys touch nothing
    t.replace(make(spark, [("new", date(2026, 5, 5), 1)]), Period.month(2026, 5))
    assert len(files_of(path)) == len(before) + 3


def test_replacement_equals_the_transform_on_random_runs(spark, workdir):
    import random
    rnd = random.Random(5)
    t = PeriodTable(spark, os.path.join(workdir, "t"), "d", keys=["k"])
    state = {}
    t.overwrite(make(spark, []))
    for run in range(6):
        month = rnd.randrange(1, 5)
        start = date(2026, month, rnd.choice([1, 10]))
        period = Period(start, Period.month(2026, month).end)
        fresh = {f"k{rnd.randrange(40)}": (date(2026, month, rnd.randrange(start.day, 28)), run) for _ in range(12)}
        t.replace(make(spark, [(k, d, v) for k, (d, v) in fresh.items()]), period)
        state = {k: x for k, x in state.items() if not period.start <= x[0] <= period.end and k not in fresh} | fresh
        assert rows_of(t.read()) == sorted(((k, d, v) for k, (d, v) in state.items()), key=str)


def test_a_key_repeated_in_another_month_stops_the_run(spark, workdir):
    wh = Warehouse(spark, os.path.join(workdir, "wh"), workdir)
    staged = staging.stage_rides(fixtures.rides(spark).where("order_id = 'o1' or order_id = 'o14'"),
                                 Period(date(2026, 1, 1), date(2026, 2, 28))).withColumn("loaded_at", F.lit(datetime(2026, 1, 1)))
    twice = staged.unionByName(staged.where("order_id = 'o1'").withColumn("ride_date", F.lit(date(2026, 2, 3))))
    # two months of a table loaded without replacement by key
    table = wh.table("stg_rides")
    loaded = PeriodTable(spark, table.path, "ride_date")
    loaded.overwrite(twice)
    assert sorted(r[0] for r in table.duplicate_keys().collect()) == [2]
    assert sorted(r[0] for r in table.duplicate_keys(JAN).collect()) == [2]
    assert table.duplicate_keys(Period.month(2026, 3)).collect() == []
    own = table.read_months(date(2026, 2, 1), date(2026, 2, 1))
    assert quality.unique(own, "stg_rides", "order_id").first()["failures"] == 0  # the month alone is fine
    books = fixtures.books(spark)
    tables = {"stg_rides": own, "stg_rides_quarantine": own.limit(0).select(
        F.lit("x").alias("quarantine_id"), "order_id", F.lit("null_financial_amount").alias("rejection_reason"),
        F.col("loaded_at").alias("quarantined_at")), "stg_account_mapping": books.rules, "stg_chart_of_accounts": books.accounts}
    wh.table("stg_rides_quarantine").overwrite(
        tables["stg_rides_quarantine"].withColumn("ride_date", F.lit(date(2026, 2, 3))))
    with pytest.raises(quality.QualityError) as err:
        _gate(RunResult(FEB), "staging", tables, books, "stop", wh)
    assert [(m, k, n) for m, k, _, n in err.value.failing] == [("stg_rides", "unique", 1)]


# -- first-seen state ----------------------------------------------------------------

def write_rides(spark, rows, path):
    spark.createDataFrame(rows, S.RIDES).coalesce(1).write.parquet(path)


def by_state(spark, state, folder, period):
    source = ride_files(spark, folder, "parquet")
    read = state.refresh(source)
    own = read_rides(spark, folder, "parquet").where(staging.in_period_by_start(period))
    return read, state.first_seen_in(staging.stage_rides(own, period), period)


def test_month_by_state_equals_the_full_dedup(spark, workdir):
    folder = os.path.join(workdir, "rides")
    rows = fixtures.ride_rows()
    write_rides(spark, [r for r in rows if r[3] is None or r[3] < datetime(2026, 1, 20)], f"{folder}/part=1")
    state = OrderState(spark, os.path.join(workdir, "state"))
    read, _ = by_state(spark, state, f"{folder}/*", JAN)
    assert len(read) == 1
    write_rides(spark, [r for r in rows if r[3] is not None and r[3] >= datetime(2026, 1, 20)], f"{folder}/part=2")
    for period in (JAN, FEB, Period(date(2026, 1, 11), date(2026, 2, 28)), Period(date(2026, 1, 13), date(2026, 1, 13))):
        read, got = by_state(spark, state, f"{folder}/*", period)
        assert len(read) == (1 if period is JAN else 0)  # only files that are new
        want = staging.stage_rides(read_rides(spark, f"{folder}/*", "parquet"), period)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_changed_file_starts_the_state_over(spark, workdir):
    folder = os.path.join(workdir, "rides")
    rows = fixtures.ride_rows()
    write_rides(spark, rows, f"{folder}/part=1")
    state = OrderState(spark, os.path.join(workdir, "state"))
    by_state(spark, state, f"{folder}/*", JAN)
    late = [(*r[:3], datetime(2026, 2, 9), *r[4:]) if r[0] == "o13" else r for r in rows]
    spark.createDataFrame(late, S.RIDES).coalesce(1).write.mode("overwrite").parquet(f"{folder}/part=1")
    read, got = by_state(spark, state, f"{folder}/*", FEB)
    assert len(read) == 1
    assert "o13" in {r.order_id for r in got.collect()}


def test_a_monthly_run_opens_its_month_and_the_touched_buckets(spark, workdir):
    folder = os.path.join(workdir, "rides")
    write_rides(spark, fixtures.ride_rows(), f"{folder}/part=1")
    state = OrderState(spark, os.path.join(workdir, "state"))
    one_day = Period(date(2026, 1, 14), date(2026, 1, 14))
    _, got = by_state(spark, state, f"{folder}/*", one_day)
    plan = got._jdf.queryExecution().executedPlan().toString()
    # one order that day: one bucket; the source is read within the period's bounds only
    assert plan.count("PushedFilters: [IsNotNull(start_time)") == 1 or "GreaterThanOrEqual(start_time" in plan
    scans = [line for line in plan.splitlines() if "batches" in line]
    assert len(scans) == 1 and "_bucket" in scans[0]
    buckets = {f.split("_bucket=")[1].split("/")[0] for f in got.inputFiles() if "_bucket=" in f}
    assert buckets  # files listed; pruned below by the partition filter
    assert "PartitionFilters: [" in scans[0] and "PartitionFilters: []" not in scans[0]


def test_batches_merge_when_there_are_many(spark, workdir, monkeypatch):
    monkeypatch.setattr(OrderState, "MAX_BATCHES", 2)
    folder, state = os.path.join(workdir, "rides"), OrderState(spark, os.path.join(workdir, "state"))
    rows = fixtures.ride_rows()
    for k in range(4):
        write_rides(spark, rows[k::4], f"{folder}/part={k}")
        state.refresh(ride_files(spark, f"{folder}/*", "parquet"))
    assert len(state.versions.load()["batches"]) <= 2
    _, got = by_state(spark, state, f"{folder}/*", FEB)
    want = staging.stage_rides(read_rides(spark, f"{folder}/*", "parquet"), FEB)
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_csv_sources_have_files_too(spark, workdir):
    path = os.path.join(workdir, "csv")
    write_csv(spark.createDataFrame(fixtures.ride_rows(), S.RIDES).where("order_id is not null").coalesce(1), path)
    state = OrderState(spark, os.path.join(workdir, "state"))
    assert len(state.refresh(ride_files(spark, path))) == 1
    assert state.refresh(ride_files(spark, path)) == []


def test_lines_of_rides_dealt_by_month_are_stored_without_another_shuffle(spark, workdir):
    rides = spark.range(400).select(F.col("id"), F.expr("date_add(DATE'2020-01-15', cast(id % 60 as int))").alias("day"))
    lines = sinks.rows_by_month(rides, "day").select(F.explode(F.array(F.col("id"), F.col("id") + 1000)).alias("key"), "day")
    table = sinks.PeriodTable(spark, f"{workdir}/lines", "day", keys=["key"])
    asked = []
    table._write = lambda df, by_month=False, write=table._write: asked.append(by_month) or write(df, by_month)
    table.overwrite(lines, by_month=True)
    assert asked == [True] and sorted(map(tuple, table.read().collect())) == sorted(map(tuple, lines.collect()))
    assert all(f.endswith(".zstd.parquet") for f in table.read().inputFiles())
    # A period that holds every stored month finds what no period finds.
    table.overwrite(lines.union(lines.where("key < 7")), by_month=True)
    whole = Period.of("2020-01-01", "2020-03-31")
    assert table.duplicate_keys(whole).count() == table.duplicate_keys().count() == 7
    assert table.duplicate_keys(Period.month(2020, 2)).count() == 0
