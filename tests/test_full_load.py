from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from spendmill import DataQualityError, MillConfig, active_days, daily_spend, rolling_spend
from spendmill.plans import FullLoad
from spendmill.plans.layers import Layers

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def loaded(spark):
    x = Layers(spark, SF)
    load = FullLoad(spark, MillConfig(bronze="fb", silver="fs", gold="fg"))
    rules = [{"type": "uniqueness", "column": "event_id"}, {"type": "null_rate", "column": "currency", "max_rate": 0.0}]
    report = load.run(*x.feeds, x.dim, rules)
    return load, report


def test_layers_are_stored_and_add_up(spark, loaded):
    load, report = loaded
    assert report.where("NOT passed").count() == 0
    assert spark.table("fb.raw_events").count() == 1044
    assert spark.table("fs.quarantine_events").count() == 60
    assert spark.table("fs.events").count() == 940
    gold = spark.table("fg.daily_advertiser_spend")
    assert gold.count() == 392
    assert round(gold.agg(F.sum("total_spend_usd")).first()[0], 4) == 32227.1816


def test_provenance_is_never_null(spark, loaded):
    schema = spark.table("fb.raw_events")
    missing = " OR ".join(f"{c} IS NULL" for c in ("schema_version", "source_file", "ingested_at"))
    assert schema.where(missing).count() == 0


def test_sql_on_the_stored_tables_answers_like_the_operators(spark, loaded):
    rolling = spark.sql("""
        SELECT event_date, advertiser_id, advertiser_name, total_spend_usd,
               avg(total_spend_usd) OVER week AS rolling_7day_avg_spend,
               round((total_spend_usd - lag(total_spend_usd) OVER days) / nullif(lag(total_spend_usd) OVER days, 0) * 100, 2)
                 AS pct_change_vs_prior_day
        FROM fg.daily_advertiser_spend
        WINDOW days AS (PARTITION BY advertiser_id ORDER BY event_date),
               week AS (PARTITION BY advertiser_id ORDER BY event_date ROWS BETWEEN 6 PRECEDING AND CURRENT ROW)""")
    gold = spark.table("fg.daily_advertiser_spend")
    assert sorted(map(repr, rolling.collect())) == sorted(map(repr, rolling_spend(gold).collect()))
    days = spark.sql("SELECT DISTINCT advertiser_id, event_date FROM fg.daily_advertiser_spend WHERE event_count >= 1")
    assert sorted(map(repr, days.collect())) == sorted(map(repr, active_days(gold).collect()))
    low, high = spark.sql("SELECT min(event_date), max(event_date) FROM fs.events").first()
    assert (str(low), str(high)) == ("2024-01-01", "2024-01-30")


def test_day_filter_prunes_partitions(spark, loaded):
    one = spark.table("fs.events").where("event_date = '2024-01-05'")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_date" in plan
    assert len(one.inputFiles()) < len(spark.table("fs.events").inputFiles())


def test_rerun_gives_the_same_tables(spark, loaded):
    load, _ = loaded
    before = sorted(map(repr, spark.table("fg.daily_advertiser_spend").collect()))
    x = Layers(spark, SF)
    load.run(*x.feeds, x.dim)
    again = spark.table("fg.daily_advertiser_spend")
    assert again.count() == len(before)
    assert sorted(r.tableName for r in spark.sql("SHOW TABLES IN fg").where("NOT isTemporary").collect()) == ["daily_advertiser_spend", "load_report"]


LAYERS = ("fb.raw_events", "fb.advertiser_dim", "fs.quarantine_events", "fs.events", "fg.daily_advertiser_spend")


def counts(spark):
    return [spark.table(t).count() for t in LAYERS]


def test_failed_rule_blocks_the_publish(spark, loaded):
    load, _ = loaded
    x = Layers(spark, SF)
    before = counts(spark)
    v2 = x.feeds.v2.where("event_id < 0")
    with pytest.raises(DataQualityError, match="freshness"):
        load.run(x.feeds.v1, v2, x.dim, [{"type": "freshness", "column": "event_time_utc", "max_age_hours": 1}], "2025-01-01T00:00:00Z")
    assert counts(spark) == before


def test_null_keys_do_not_stop_the_load(spark, loaded):
    x = Layers(spark, SF)
    keyless = x.feeds.v1.where("event_id % 100 = 10").withColumn("event_id", F.lit(None).cast("long"))
    load = FullLoad(spark, MillConfig(bronze="nb", silver="ns", gold="ng"))
    report = load.run(x.feeds.v1.union(keyless), x.feeds.v2, x.dim)
    assert report.where("NOT passed").count() == 0
    assert spark.table("ns.quarantine_events").where("quarantine_reason = 'missing_event_id'").count() > 0


def test_daily_sums_do_not_depend_on_the_partitions(spark):
    x = Layers(spark, SF)
    gold = [sorted(map(repr, daily_spend(x.spend_events.repartition(n), x.dim).collect())) for n in (1, 3, 17)]
    assert gold[0] == gold[1] == gold[2]


def test_duplicate_dimension_key_blocks_the_publish(spark, loaded):
    load, _ = loaded
    x = Layers(spark, SF)
    before = counts(spark)
    doubled = x.dim.union(x.dim)
    with pytest.raises(Exception, match="not unique"):
        load.run(*x.feeds, doubled)
    assert counts(spark) == before


def test_bronze_schema_only_grows(spark, loaded):
    load, _ = loaded
    x = Layers(spark, SF)
    load.load_bronze(x.feeds.v1, x.feeds.v2.drop("viewability").withColumn("clicks", F.lit(1)), x.dim)
    assert {"viewability", "clicks"} <= set(spark.table("fb.raw_events").columns)
