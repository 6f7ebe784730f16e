from __future__ import annotations

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from spendmill import (
    dedup_latest,
    duplicate_keys,
    label_quarantine,
    normalise,
    parse_event_time,
    purge_keys,
    split,
    unify_columns,
    with_offset,
)

SCHEMA = "event_id string, event_time string, ingest_time timestamp, currency string, spend double, media_cost double"
T0 = dt.datetime(2024, 1, 1)


def events(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def reasons(spark, rows):
    out = label_quarantine(normalise(events(spark, rows))).collect()
    return {r.event_id: r.quarantine_reason for r in out}


def test_unify_takes_whichever_version_is_filled(spark):
    df = events(spark, [("a", None, T0, "USD", 1.0, None), ("b", None, T0, "USD", None, 2.0), ("c", None, T0, "USD", None, None)])
    assert [r.cost_raw for r in unify_columns(df).orderBy("event_id").collect()] == [1.0, 2.0, None]
    assert unify_columns(df.drop("media_cost")).where("event_id = 'b'").first().cost_raw is None
    with pytest.raises(ValueError):
        unify_columns(df, {"cost_raw": ["nowhere"]})


def test_offsets_become_utc_and_bad_text_becomes_null(spark):
    texts = ["2024-01-01T10:00:00Z", "2024-01-01T10:00:00+05:30", "N/A", "", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, event_time string")
    got = [r[0] for r in parse_event_time(df).orderBy("i").select(F.col("event_time_utc").cast("timestamp_ntz")).collect()]
    assert got == [dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 4, 30), None, None, None]


def test_strict_offset_rejects_text_that_leans_on_the_session(spark):
    texts = ["2024", "T12:30", "2024-01-01 10:00:00", "2024-01-01T10:00:00Z", "2024-01-01T10:00:00.123+05:30"]
    df = spark.createDataFrame([(t,) for t in texts], "event_time string")
    lenient = parse_event_time(df).where("event_time_utc IS NOT NULL").count()
    strict = parse_event_time(df, strict_offset=True).where("event_time_utc IS NOT NULL").count()
    assert (lenient, strict) == (5, 2)


def test_strict_parse_fails_the_job(spark):
    df = spark.createDataFrame([("N/A",)], "event_time string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|CANNOT_PARSE_TIMESTAMP"):
        parse_event_time(df, on_error="raise").collect()
    with pytest.raises(ValueError):
        parse_event_time(df, on_error="ignore")


def test_first_reason_wins_and_na_text_is_malformed(spark):
    got = reasons(
        spark,
        [
            ("all", "N/A", T0, None, -1.0, None),
            ("two", "2024-01-01T10:00:00Z", T0, None, -1.0, None),
            ("cur", "2024-01-01T10:00:00Z", T0, None, None, None),
            ("cost", "2024-01-01T10:00:00Z", T0, "USD", None, None),
            ("null", None, T0, "USD", 1.0, None),
            ("ok", "2024-01-01T10:00:00Z", T0, "USD", 0.0, None),
        ],
    )
    assert got == {
        "all": "malformed_timestamp",
        "two": "negative_cost",
        "cur": "missing_currency",
        "cost": "missing_cost",
        "null": "malformed_timestamp",
        "ok": None,
    }


def test_split_is_total_and_disjoint(spark):
    rng = random.Random(7)
    rows = [
        (str(i), rng.choice(["2024-01-01T10:00:00Z", "N/A", None]), T0, rng.choice(["USD", "INR", None]), rng.choice([1.0, -1.0, None]), None)
        for i in range(300)
    ]
    labelled = label_quarantine(normalise(events(spark, rows)))
    good, bad = split(labelled)
    assert "quarantine_reason" not in good.columns
    g = {r.event_id for r in good.collect()}
    b = {r.event_id for r in bad.collect()}
    assert not g & b and len(g | b) == 300


def test_offset_filter_uses_a_colon(spark):
    df = spark.createDataFrame([("2024-01-01T10:00:00+05:30",), ("2024-01-01T10:00:00Z",)], "event_time string")
    assert with_offset(df).count() == 1
    assert with_offset(df, "+05.30").count() == 0


def test_newest_ingest_time_wins_not_load_time(spark):
    rows = [
        ("a", "x", dt.datetime(2024, 1, 3), "USD", 1.0, None),
        ("a", "y", dt.datetime(2024, 1, 5), "USD", 2.0, None),
        ("a", "z", None, "USD", 9.0, None),
        ("b", "x", None, "USD", 3.0, None),
    ]
    df = normalise(events(spark, rows)).withColumn("ingested_at", F.current_timestamp())
    got = {r.event_id: r.event_time for r in dedup_latest(df).collect()}
    assert got == {"a": "y", "b": "x"}


def test_survivor_does_not_depend_on_row_order(spark):
    rng = random.Random(11)
    rows = [
        (str(rng.randrange(40)), f"t{rng.randrange(9)}", T0 + dt.timedelta(hours=rng.randrange(3)), rng.choice(["USD", "INR", None]), float(rng.randrange(3)), None)
        for _ in range(500)
    ]
    results = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = unify_columns(events(spark, rows)).repartition(3 + seed)
        results.append(sorted(map(repr, dedup_latest(df).collect())))
    assert results[0] == results[1] and len(results[0]) == 40
    once = dedup_latest(unify_columns(events(spark, rows)))
    assert sorted(map(repr, dedup_latest(once).collect())) == results[0]


def test_dedup_of_rows_with_a_map_column(spark):
    df = spark.sql("SELECT 1 AS k, 1 AS o, map('a', 1) AS m UNION ALL SELECT 1, 2, map('a', 2)")
    assert dedup_latest(df, "k", "o", ()).first().m == {"a": 2}
    with pytest.raises(ValueError):
        dedup_latest(df, "k", "missing")


def test_dedup_sends_one_row_per_key_and_task(spark):
    """A key with most of the rows is reduced before the shuffle."""
    df = spark.range(0, 200_000, numPartitions=8).select(
        F.when(F.col("id") % 3 > 0, F.lit(-1)).otherwise(F.col("id")).alias("event_id"), F.col("id").alias("ingest_time")
    )
    out = dedup_latest(df, tie_breakers=())
    assert out.where("event_id = -1").first().ingest_time == 199_999
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_purge_and_duplicates(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", -1.0), ("b", 2.0), ("c", None), (None, 1.0)], "k string, v double")
    assert sorted((r.k or "", r.v) for r in purge_keys(df, "k", "v < 0").collect() if r.v) == [("", 1.0), ("b", 2.0)]
    assert purge_keys(df, "k", F.col("v") < 0).count() == 3
    assert [(r.k, r.n) for r in duplicate_keys(df, "k").collect()] == [("a", 2)]
