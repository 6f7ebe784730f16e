"""Benchmark items with a null id, by the operator and by the query's SQL."""

from __future__ import annotations

import hashlib

import duckdb
import pytest

from spendmill.llm.decontaminate import PositionalIndex, contamination
from spendmill.llm.queries import ORACLE

ITEMS = [(None, "alpha beta"), (None, "gamma delta"), (0, "gamma delta"), (3, "zeta")]
DOCS = [(1, "an Alpha beta here"), (2, "gamma delta then alpha beta"), (3, "zeta"), (4, "alpha gamma")]


def test_items_without_an_id_contaminate_as_the_sql_says(spark):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    got = sorted(tuple(r) for r in contamination(docs, items).drop("hits").collect())
    db = duckdb.connect()
    for name, column, data in (("documents", "doc_id", DOCS), ("benchmark", "item_id", ITEMS)):
        db.execute(f"CREATE TABLE {name} ({column} BIGINT, text VARCHAR)")
        db.executemany(f"INSERT INTO {name} VALUES (?, ?)", data)
    assert got == sorted(db.execute(ORACLE["op6_decontamination"]).fetchall())
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert got[0] == (1, 4, 2, 1, sha(""), True) and got[1] == (2, 5, 4, 2, sha("0"), True)


@pytest.mark.parametrize("block", [100_000, 1])
def test_null_is_one_item_in_any_blocks(spark, block):
    docs, items = spark.createDataFrame(DOCS, "doc_id long, text string"), spark.createDataFrame(ITEMS, "item_id long, text string")
    found = PositionalIndex.build(docs).phrases(items, block_windows=block, null_ids=True)
    got = {r["doc_id"]: set(r["items"]) if len(set(r["items"])) == len(r["items"]) else r["items"] for r in found.collect()}
    assert got == {1: {None}, 2: {None, 0}, 3: {3}, 4: set()}
