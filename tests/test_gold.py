from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spendmill import (
    active_days,
    assert_utc,
    daily_spend,
    first_days,
    join_dimension,
    longest_streak,
    orphans,
    refresh_days,
    rolling_spend,
    streaks,
    to_usd,
    to_usd_daily,
    unique_dimension,
    unknown_names,
)

D = dt.date


@pytest.fixture()
def dim(spark):
    return spark.createDataFrame([("a", "Ann"), ("n", None), ("u", "UNKNOWN")], "advertiser_id string, advertiser_name string")


@pytest.fixture()
def facts(spark):
    rows = [
        ("1", "a", "USD", 1.0, "2024-01-01T20:00:00Z"),
        ("2", "a", "INR", 83.0, "2024-01-01T23:59:59Z"),
        ("3", "n", "USD", 2.0, "2024-01-02T00:00:00Z"),
        ("4", "x", "EUR", 5.0, "2024-01-02T00:00:00Z"),
        ("5", None, "USD", 7.0, "2024-01-02T00:00:00Z"),
    ]
    df = spark.createDataFrame(rows, "event_id string, advertiser_id string, currency string, cost_raw double, t string")
    return df.select("event_id", "advertiser_id", "currency", "cost_raw", F.to_timestamp("t").alias("event_time_utc"))


def test_fixed_rates_and_unknown_currency(spark, facts):
    got = {r.event_id: r.cost_usd for r in to_usd(facts).collect()}
    assert got["1"] == 1.0 and got["2"] == pytest.approx(1.0) and got["4"] is None


def test_unmapped_flag_is_the_anti_join_not_the_name(spark, facts, dim):
    joined = {r.event_id: r for r in join_dimension(facts, dim).collect()}
    assert len(joined) == 5
    assert (joined["3"].advertiser_name, joined["3"].is_unmapped_advertiser) == ("UNKNOWN", False)
    assert (joined["4"].advertiser_name, joined["4"].is_unmapped_advertiser) == ("UNKNOWN", True)
    flagged = {r.advertiser_id for r in joined.values() if r.is_unmapped_advertiser}
    assert flagged == {r.advertiser_id for r in orphans(facts, dim).collect()} == {"x", None}
    assert sorted(r.advertiser_id for r in unknown_names(dim).collect()) == ["n", "u"]


def test_shared_columns_do_not_clash(spark, facts, dim):
    stamped = facts.withColumn("ingested_at", F.current_timestamp())
    joined = join_dimension(stamped, dim.withColumn("ingested_at", F.current_timestamp()))
    assert joined.columns.count("ingested_at") == 1 and joined.count() == 5


def test_duplicate_dimension_key_fails_or_resolves(spark, facts, dim):
    doubled = dim.union(spark.createDataFrame([("a", "Abe")], dim.schema))
    with pytest.raises(Exception, match="not unique"):
        join_dimension(facts, doubled).collect()
    names = {r.advertiser_id: r.advertiser_name for r in unique_dimension(doubled, on_duplicate="smallest").collect()}
    assert names == {"a": "Abe", "n": None, "u": "UNKNOWN"}
    assert daily_spend(to_usd(facts), doubled, on_duplicate="smallest").count() == 4
    with pytest.raises(ValueError):
        unique_dimension(dim, on_duplicate="any")


def test_daily_spend_keeps_unconverted_events_in_the_count(spark, facts, dim):
    got = {(r.event_date, r.advertiser_id): (r.total_spend_usd, r.event_count) for r in daily_spend(to_usd(facts), dim).collect()}
    assert got[(D(2024, 1, 1), "a")] == (pytest.approx(2.0), 2)
    assert got[(D(2024, 1, 2), "x")] == (None, 1)
    assert got[(D(2024, 1, 2), None)] == (7.0, 1)


def test_daily_spend_equals_joining_first(spark, facts, dim):
    joined = join_dimension(to_usd(facts), dim).groupBy(
        F.to_date("event_time_utc").alias("event_date"), "advertiser_id", "advertiser_name", "is_unmapped_advertiser"
    ).agg(F.sum("cost_usd").alias("total_spend_usd"), F.count("event_id").alias("event_count"))
    assert sorted(map(repr, joined.collect())) == sorted(map(repr, daily_spend(to_usd(facts), dim).collect()))


def test_session_zone_is_checked(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kolkata")
    try:
        with pytest.raises(ValueError, match="UTC"):
            assert_utc(spark)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert_utc(spark)


def test_daily_rates_use_the_latest_at_or_before_the_day(spark):
    rates = spark.createDataFrame(
        [("INR", D(2024, 1, 2), 80.0), ("INR", D(2024, 1, 5), 90.0), ("EUR", D(2024, 1, 3), 2.0), ("INR", D(2024, 1, 5), 90.0)],
        "currency string, rate_date date, rate double",
    )
    rows = [("before", "INR", "2024-01-01"), ("on", "INR", "2024-01-02"), ("gap", "INR", "2024-01-04"), ("late", "INR", "2024-03-01"), ("eur", "EUR", "2024-01-09"), ("usd", "USD", "2024-01-01"), ("none", "JPY", "2024-01-04"), ("undated", "INR", None)]
    df = spark.createDataFrame(rows, "event_id string, currency string, d string").select(
        "event_id", "currency", F.lit(720.0).alias("cost_raw"), F.to_timestamp("d").alias("event_time_utc")
    )
    got = {r.event_id: r.cost_usd for r in to_usd_daily(df, rates).collect()}
    assert got == {"before": None, "on": 9.0, "gap": 9.0, "late": 8.0, "eur": 360.0, "usd": 720.0, "none": None, "undated": None}


def gold(spark, rows):
    return spark.createDataFrame(
        [(a, D(2024, 1, d), a.upper(), False, v, n) for a, d, v, n in rows],
        "advertiser_id string, event_date date, advertiser_name string, is_unmapped_advertiser boolean, total_spend_usd double, event_count bigint",
    )


def test_row_and_calendar_frames_differ_across_a_gap(spark):
    g = gold(spark, [("a", 1, 1.0, 1), ("a", 2, 2.0, 1), ("a", 20, 9.0, 1), ("b", 20, 5.0, 1)])
    by_row = {(r.advertiser_id, r.event_date.day): r for r in rolling_spend(g).collect()}
    by_day = {(r.advertiser_id, r.event_date.day): r for r in rolling_spend(g, calendar=True).collect()}
    assert by_row[("a", 20)].rolling_7day_avg_spend == 4.0 and by_day[("a", 20)].rolling_7day_avg_spend == 9.0
    assert by_row[("a", 20)].pct_change_vs_prior_day == 350.0 and by_day[("a", 20)].pct_change_vs_prior_day is None
    assert by_row[("a", 2)].pct_change_vs_prior_day == by_day[("a", 2)].pct_change_vs_prior_day == 100.0
    assert by_row[("b", 20)].pct_change_vs_prior_day is None


def test_frame_is_seven_rows_and_zero_does_not_divide(spark):
    g = gold(spark, [("a", d, float(d if d > 1 else 0), 1) for d in range(1, 10)])
    got = {r.event_date.day: r for r in rolling_spend(g).collect()}
    assert got[9].rolling_7day_avg_spend == sum(range(3, 10)) / 7
    assert got[2].pct_change_vs_prior_day is None


def test_first_days_filter_goes_below_the_window(spark, tmp_path):
    path = str(tmp_path / "gold")
    gold(spark, [("a", d, 1.0, 1) for d in range(1, 20)] + [("b", 1, 1.0, 1)]).write.parquet(path)
    top = first_days(rolling_spend(spark.read.parquet(path)), "a")
    assert [r.event_date.day for r in top.collect()] == list(range(1, 11))
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(advertiser_id,a)" in plan and "TakeOrderedAndProject" in plan


def test_streaks(spark):
    g = gold(spark, [("a", d, 1.0, 1) for d in (1, 2, 3, 7, 8, 9, 12)] + [("b", 5, 1.0, 1), ("b", 6, 0.0, 0), ("c", 9, 0.0, 0)])
    g = g.union(spark.createDataFrame([("b", None, "B", False, 1.0, 1)], g.schema))
    best = {r.advertiser_id: (r.longest_streak_days, r.streak_start.day, r.streak_end.day) for r in longest_streak(g).collect()}
    assert best == {"a": (3, 1, 3), "b": (1, 5, 5)}
    assert sorted(r.streak_length for r in streaks(g).collect()) == [1, 1, 3, 3]
    assert active_days(g.union(g)).count() == 8


def test_refresh_replaces_only_the_listed_days(spark, facts, dim):
    events = to_usd(facts)
    old = daily_spend(events, dim).withColumn("total_spend_usd", F.lit(-1.0))
    days = spark.createDataFrame([(D(2024, 1, 2),)], "event_date date")
    got = {(r.event_date.day, r.advertiser_id): r.total_spend_usd for r in refresh_days(old, events, dim, days).collect()}
    assert got == {(1, "a"): -1.0, (2, "n"): 2.0, (2, "x"): None, (2, None): 7.0}


@pytest.mark.parametrize("threshold", ["10MB", "-1"])
def test_hot_advertiser_joins_with_or_without_broadcast(spark, threshold):
    """Two thirds of the rows share one key: the sort-merge plan must split that partition."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": threshold,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        fact = spark.range(0, 300_000, numPartitions=8).select(
            F.when(F.col("id") % 3 > 0, F.lit(0)).otherwise(F.col("id") % 1000).alias("advertiser_id"), F.col("id").alias("event_id")
        )
        names = spark.range(0, 900).select(F.col("id").alias("advertiser_id"), F.concat(F.lit("n"), "id").alias("advertiser_name"))
        joined = join_dimension(fact, names)
        got = joined.groupBy("is_unmapped_advertiser").count().collect()
        assert {r[0]: r[1] for r in got} == {False: 290_000, True: 10_000}
        if threshold == "-1":
            joined.collect()
            assert "SortMergeJoin(skew=true)" in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
