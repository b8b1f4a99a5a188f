"""Every registered query against its DuckDB oracle on the smallest tables."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from ledgerflow.plans import oracle, queries as ledger_queries  # noqa: E402
from oracle_check import TABLES, digest, type_class  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["period_start", "period_end", "total_revenue", "total_expenses",
                          "net_income"]
    assert len(rows) == 1


def test_every_query_has_an_oracle():
    assert set(ledger_queries.queries()) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())
    assert set(ledger_queries.queries()) == set(oracle.oracle_sql())


@pytest.mark.parametrize("name", sorted(ledger_queries.queries()))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    s_rows = [tuple(r) for r in df.collect()]
    rel = con.sql(E.oracle_sql()[name])
    o_rows = rel.fetchall()
    assert sorted(df.columns) == sorted(rel.columns)
    s_types = dict(zip(df.columns, [type_class(f.dataType.simpleString()) for f in df.schema.fields]))
    o_types = dict(zip(rel.columns, [type_class(str(t)) for t in rel.types]))
    assert s_types == o_types
    assert len(s_rows) == len(o_rows)
    assert digest(df.columns, s_rows)[0] == digest(rel.columns, o_rows)[0]
