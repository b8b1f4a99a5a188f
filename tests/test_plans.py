"""Physical plan shape of the core operators: what scale depends on."""

import pytest

from ledgerflow.plans import queries as Q

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["stg_rides", "general_ledger", "trial_balance",
                                  "quarantine", "income_statement_summary", "direct_income_statement"])
def test_no_python_in_plans(spark, name):
    p = plan(Q.QUERIES[name](spark, SF))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in p


def test_staging_is_one_scan_and_one_exchange_with_a_group_limit(spark):
    p = plan(Q.stg_rides(spark, SF))
    assert p.count("lineitem.parquet") == 1
    # ranking: partial top-1 before the single exchange on the order key
    assert "WindowGroupLimit" in p and "Partial" in p
    assert p.count("Exchange hashpartitioning(order_id") == 1


def test_ledger_joins_reference_tables_by_broadcast(spark):
    p = plan(Q.general_ledger(spark, SF))
    assert p.count("BroadcastHashJoin") >= 5     # 3 dimension joins + rules + chart
    assert "SortMergeJoin" not in p


def test_month_run_reads_no_row_after_the_month(spark):
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)   # the whole list of pushed filters
    try:
        text = plan(Q.general_ledger_month(spark, SF))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    scans = [line for line in text.splitlines() if "PushedFilters" in line and "l_shipdate" in line]
    assert scans and all("LessThan(l_shipdate,1998-04-01T00:00)" in line for line in scans)


def test_trial_balance_aggregates_partially(spark):
    p = plan(Q.trial_balance(spark, SF))
    assert "partial_sum" in p


def test_period_filter_reaches_scan(spark):
    from ledgerflow.operators import staging
    from ledgerflow.plans.context import MONTH, Ledger
    lg = Ledger(spark, SF)
    df = staging.stage_rides(lg.rides, MONTH, dedup_scope="period")
    scan = [line for line in plan(df).splitlines() if "lineitem.parquet" in line][0]
    pushed = scan.split("PushedFilters: [")[1].split("]")[0]
    assert "GreaterThanOrEqual(l_shipdate,1998-03-01T00:00)" in pushed  # (plan text is truncated after it)


def test_scan_prunes_columns(spark):
    p = plan(Q.direct_income_statement(spark, SF))
    scan = [line for line in p.splitlines() if "lineitem.parquet" in line][0]
    assert "l_shipdate" not in scan and "l_orderkey" not in scan
