"""Guards read derived money columns without deriving them again, and keep the same rows."""

import pytest
from pyspark.sql import functions as F

from ledgerflow import schemas as S
from ledgerflow.operators import staging
from ledgerflow.plans import queries as Q
from tests import fixtures

SF = "/root/testdata/sf0.001"


def filters(df) -> list[str]:
    text = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in text.splitlines() if "- Filter " in line or "- *Filter " in line or ") Filter " in line]


@pytest.mark.parametrize("name", ["stg_rides", "replace_period", "replace_by_key", "dedup_orders", "guard_not_null"])
def test_filters_do_not_derive_money(spark, name):
    found = filters(Q.QUERIES[name](spark, SF))
    assert found
    for line in found:
        assert "l_tax" not in line and "l_extendedprice" not in line


def test_guards_keep_the_rows_of_plain_filters(spark):
    rides = fixtures.rides(spark)
    for c in S.MONEY_COLUMNS:   # each money column null on its own, and whole rows twice
        rides = rides.unionByName(fixtures.rides(spark).limit(3).withColumn(c, F.lit(None).cast(rides.schema[c].dataType)))
    rides = rides.unionByName(rides)
    plain = rides.where(" and ".join(f"{c} is not null" for c in S.MONEY_COLUMNS))
    got = staging.guard_not_null(rides)
    assert got.schema == plain.schema and got.columns == rides.columns
    assert got.exceptAll(plain).count() == 0 and plain.exceptAll(got).count() == 0
    assert 0 < got.count() < rides.count()
