"""Sketches bound the exact counts and merge; payload fields are found whatever the rows hold."""

from __future__ import annotations

from pyspark.sql import functions as F

from spendmill import distinct_bounds, payload_fields, payload_schema, uniqueness, value_sketches
from spendmill.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"


def test_bounds_hold_the_exact_count_and_sketches_merge(spark):
    rows = spark.range(30_000).selectExpr("id", "id % 977 AS few", "IF(id % 3 = 0, NULL, id) AS gaps", "CAST(id % 7 AS INT) AS day")
    by_day = value_sketches(rows, ["id", "few", "gaps"], F.col("day"))
    assert by_day.count() == 21
    found = {r["column"]: r for r in distinct_bounds(by_day).collect()}
    exact = {"id": 30_000, "few": 977, "gaps": 20_001}
    assert all(found[c]["at_least"] <= n <= found[c]["at_most"] and found[c]["rows"] == 30_000 for c, n in exact.items())
    halves = by_day.where("day < 3").unionByName(value_sketches(rows.where("day >= 3"), ["id", "few", "gaps"], F.col("day")))
    assert {r["column"]: r["estimate"] for r in distinct_bounds(halves).collect()} == {c: r["estimate"] for c, r in found.items()}


def test_exact_counts_run_only_where_the_sketch_cannot_decide(spark):
    rows = spark.range(5_000).selectExpr("id", "id % 10 AS few", "IF(id = 7, 8, id) AS nearly", "IF(id = 7, NULL, id) AS one_null")
    columns = ["id", "few", "nearly", "one_null"]
    found = uniqueness(rows, value_sketches(rows, columns, F.lit(1)), columns)
    assert {r["column"]: (r.passed, r.decided_by) for r in found.collect()} == {
        "id": (True, "exact"), "few": (False, "sketch"), "nearly": (False, "exact"), "one_null": (True, "exact"),
    }
    empty = rows.limit(0)
    assert all(r.passed for r in uniqueness(empty, value_sketches(empty, columns, F.lit(1)), columns).collect())


def test_payload_fields_and_schema(spark):
    texts = ['{"a": 1, "b": {"c": [1]}}', '{"a": "x", "key": null}', '{"a": 2}', "[1]", "no json", None, "{}"]
    df = spark.createDataFrame([(t, 1, "z") for t in texts], "_payload string, pos int, key string")
    found = sorted(map(tuple, payload_fields(df, known=["b"]).collect()))
    assert found == [("a", "BIGINT", 2), ("a", "STRING", 1), ("key", "VOID", 1)]
    assert payload_fields(df.limit(0)).count() == 0
    assert "a" in payload_schema(df.where("_payload LIKE '{%'")).first()[0]


def test_checks_over_damaged_layers_fail(spark):
    found = {r.check_name: r.passed for r in QUERIES["damaged_reconciliation"](spark, SF).collect()}
    assert {c for c, ok in found.items() if not ok} >= {"bronze_rows", "quarantine_split", "dedup_arithmetic", "spend_conservation", "event_conservation"}
