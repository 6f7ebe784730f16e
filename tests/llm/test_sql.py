"""Every query that SQL can express against DuckDB on the same whole tables."""

from __future__ import annotations

import glob

import pytest

from spendmill.llm.queries import ORACLE, QUERIES
from tests.compare import canonical, connect, oracle_rows

SF = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, name):
    ours = QUERIES[name](spark, SF)
    columns, rows = oracle_rows(connect(SF), ORACLE[name])
    assert sorted(ours.columns) == sorted(columns)
    assert canonical(ours.collect(), ours.columns) == canonical(rows, columns)


def test_queries_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert glob.glob(f"{SF}/documents.parquet")
