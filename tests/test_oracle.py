"""Every registered query against its SQL, whole results."""

from __future__ import annotations

import os

import pytest

from __spark_entry__ import entry, oracle_sql, queries

from spendmill.plans import catalog, layers
from spendmill.plans.catalog import QUERIES
from spendmill.plans.oracle import ORACLE

from .compare import canonical, connect, oracle_rows

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    frame = QUERIES[name](spark, SF_DIR)
    got = frame.collect()
    columns, want = oracle_rows(con, ORACLE[name])
    assert sorted(frame.columns) == sorted(columns)
    assert len(got) == len(want) > 0
    assert canonical(got, frame.columns) == canonical(want, columns)


@pytest.mark.parametrize("name", ["gold_incremental", "reconciliation_report", "silver_upsert"])
def test_without_a_shared_folder_the_plan_stays_lazy(spark, con, monkeypatch, name):
    for module in (catalog, layers):
        monkeypatch.setattr(module, "settle", lambda df: df)
    frame = queries()[name](spark, SF_DIR)
    columns, want = oracle_rows(con, oracle_sql()[name])
    assert canonical(frame.collect(), frame.columns) == canonical(want, columns)


def test_entry(spark):
    frame = entry(spark)
    assert frame.count() == 392
    assert round(frame.groupBy().sum("total_spend_usd").collect()[0][0], 2) == 32227.18
