from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spendmill import DataQualityError, Rule, dq_report, enforce, run_dq_checks
from spendmill.operators import checks as C

NOW = "2024-01-31T00:00:00Z"


# The three example cases below must give what they are documented to give.
def test_null_rate_over_its_limit(spark):
    df = spark.createDataFrame([("adv_1",), ("adv_2",), (None,), (None,)], "advertiser_id string")
    (result,) = run_dq_checks(df, [{"type": "null_rate", "column": "advertiser_id", "max_rate": 0.05}])
    assert result["actual_value"] == 0.5 and result["passed"] is False
    assert result["rule"]["max_rate"] == 0.05


def test_repeated_ids_are_not_unique(spark):
    df = spark.createDataFrame([("evt_1",), ("evt_1",), ("evt_2",)], "event_id string")
    (result,) = run_dq_checks(df, [{"type": "uniqueness", "column": "event_id"}])
    assert result["actual_value"] == 2 and result["passed"] is False


def test_empty_frame(spark):
    df = spark.createDataFrame([], "advertiser_id string, t timestamp")
    rules = [
        {"type": "null_rate", "column": "advertiser_id", "max_rate": 0.05},
        {"type": "uniqueness", "column": "advertiser_id"},
        {"type": "freshness", "column": "t", "max_age_hours": 24},
    ]
    got = [(r["actual_value"], r["passed"]) for r in run_dq_checks(df, rules)]
    assert got == [(0, True), (0, True), (None, False)]
    assert run_dq_checks(df, []) == []


def test_null_counts_as_one_value(spark):
    df = spark.createDataFrame([("x",), (None,), (None,)], "c string")
    assert run_dq_checks(df, [{"type": "uniqueness", "column": "c"}])[0]["actual_value"] == 2
    one_null = spark.createDataFrame([("x",), (None,)], "c string")
    assert run_dq_checks(one_null, [{"type": "uniqueness", "column": "c"}])[0]["passed"] is True


@pytest.mark.parametrize("kind", ["timestamp", "string", "timestamp_ntz"])
@pytest.mark.parametrize("now", [NOW, dt.datetime(2024, 1, 31), dt.datetime(2024, 1, 31, 5, 30, tzinfo=dt.timezone(dt.timedelta(hours=5, minutes=30)))])
def test_freshness_in_hours(spark, kind, now):
    base = spark.sql("SELECT '2024-01-30T00:00:00' AS t UNION ALL SELECT '2024-01-30T12:00:00' UNION ALL SELECT NULL")
    df = base.select(F.col("t").cast(kind).alias("t")) if kind != "string" else base.select(F.concat("t", F.lit("Z")).alias("t"))
    rules = [Rule("freshness", "t", 12.0), Rule("freshness", "t", 11.9)]
    got = [(r.actual_value, r.passed) for r in dq_report(df, rules, now).orderBy("rule_no").collect()]
    assert got == [(12.0, True), (12.0, False)]


def test_freshness_against_the_clock(spark):
    df = spark.range(1).select(F.current_timestamp().alias("t"))
    assert run_dq_checks(df, [{"type": "freshness", "column": "t", "max_age_hours": 1}])[0]["passed"] is True


def test_rule_mistakes_are_errors(spark):
    df = spark.range(1)
    for bad in ({"type": "mystery", "column": "id"}, {"type": "null_rate", "column": "id"}, Rule("freshness", "id")):
        with pytest.raises(ValueError):
            dq_report(df, [bad])
    with pytest.raises(ValueError):
        dq_report(df, [])


def test_plain_rules_share_one_scan_and_unique_columns_read_themselves(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).select("id", F.col("id").alias("other"), F.lit("x").alias("unused")).write.parquet(path)
    rules = [Rule("null_rate", "id", 0.1), Rule("uniqueness", "id"), Rule("uniqueness", "other")]
    plan = dq_report(spark.read.parquet(path), rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan parquet") == 3 and "unused" not in plan
    assert plan.count("ReadSchema: struct<other:") == 1
    rules = [Rule("null_rate", "id", 0.1), Rule("null_rate", "other", 0.1)]
    assert dq_report(spark.read.parquet(path), rules)._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_gate_lists_every_failure(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,)], "c string")
    rules = [Rule("null_rate", "c", 0.1), Rule("uniqueness", "c"), Rule("null_rate", "c", 0.9)]
    with pytest.raises(DataQualityError) as failure:
        enforce(dq_report(df, rules))
    assert str(failure.value).count('"passed":false') == 2
    enforce(dq_report(df, rules[2:]))


def test_checks_notice_lost_rows_and_spend(spark):
    rows = spark.range(10).select(F.col("id").alias("event_id"), F.lit(1.0).alias("cost_usd"))
    gold = spark.createDataFrame([(9.5, 9, False, dt.date(2024, 1, 1))], "total_spend_usd double, event_count bigint, is_unmapped_advertiser boolean, event_date date").withColumn("advertiser_id", F.lit("a"))
    report = C.compare([C.spend_measures(rows), C.gold_measures(gold)], C.pick("spend_conservation", "event_conservation"))
    got = {r.check_name: (r.expected, r.actual, r.passed) for r in report.collect()}
    assert got == {"spend_conservation": (10.0, 9.5, False), "event_conservation": (10.0, 9.0, False)}


def test_spend_tolerance_is_below_a_cent(spark):
    def verdict(total):
        side = spark.createDataFrame([(total,)], "v double")
        parts = [C.measure(side, silver_spend=F.sum("v")), C.measure(spark.createDataFrame([(1.0,)], "v double"), gold_spend=F.sum("v"))]
        return C.compare(parts, C.pick("spend_conservation")).first().passed

    assert verdict(1.009) is True and verdict(1.011) is False


def test_missing_measure_does_not_pass(spark):
    report = C.compare([C.rows_of("bronze_rows", spark.range(3))], C.pick("bronze_rows"))
    assert report.first().passed is False


def test_surplus_of_no_rows_is_zero(spark):
    empty = spark.createDataFrame([], "event_id string")
    assert {r.measure: r.value for r in C.good_measures(empty).collect()} == {"good_rows": 0.0, "surplus_rows": 0.0}


def test_unmapped_advertisers_count_null_like_the_anti_join(spark):
    rows = [("x", True), ("x", True), (None, True), ("k", False)]
    gold = spark.createDataFrame(rows, "advertiser_id string, is_unmapped_advertiser boolean").selectExpr(
        "*", "1.0D AS total_spend_usd", "1L AS event_count", "DATE '2024-01-01' AS event_date"
    )
    got = {r.measure: r.value for r in C.gold_measures(gold).collect()}
    assert got["gold_unmapped_advertisers"] == 2.0 and got["gold_unmapped_rows"] == 3.0


def test_rules_do_not_multiply_rows(spark):
    df = spark.range(50).selectExpr("id AS a", "id % 7 AS b", "IF(id % 5 = 0, NULL, id) AS c")
    rules = [{"type": "uniqueness", "column": c} for c in ("a", "b", "c")] + [{"type": "null_rate", "column": "c", "max_rate": 0.1}]
    report = dq_report(df, rules)
    assert "Expand" not in report._jdf.queryExecution().executedPlan().toString()
    got = {(r.rule, r.column): (r.actual_value, r.passed) for r in report.collect()}
    assert got == {
        ("uniqueness", "a"): (50.0, True),
        ("uniqueness", "b"): (7.0, False),
        ("uniqueness", "c"): (41.0, False),
        ("null_rate", "c"): (0.2, False),
    }
