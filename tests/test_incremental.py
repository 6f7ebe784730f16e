from __future__ import annotations

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from spendmill import EVENTS_V1, EVENTS_V2, DataQualityError, MillConfig, tag_provenance
from spendmill.plans import FullLoad, IncrementalLoad
from spendmill.plans.batch import by_day
from spendmill.plans.layers import Layers
from spendmill.sources import vendor_feeds
from spendmill.streaming import VendorFolder, start_incremental

SF = "/root/testdata/sf0.001"
GOLD_KEY = ("event_date", "advertiser_id", "advertiser_name", "is_unmapped_advertiser", "event_count")


def gold_rows(spark, table):
    rows = spark.table(table).collect()
    return sorted((*(str(r[k]) for k in GOLD_KEY), round(r.total_spend_usd, 6)) for r in rows)


def silver_rows(spark, table):
    cols = ["event_id", "event_time", "ingest_time", "cost_raw", "currency", "advertiser_id", "event_date"]
    return sorted(map(repr, spark.table(table).select(*cols).collect()))


@pytest.fixture(scope="module")
def full(spark):
    x = Layers(spark, SF)
    FullLoad(spark, MillConfig(bronze="rb", silver="rs", gold="rg")).run(*x.feeds, x.dim)
    return x


def _event(i, when, ingest, cost, adv="a", currency="USD"):
    return (str(i), when, dt.datetime.fromisoformat(ingest), adv, currency, cost)


COLUMNS = "event_id string, event_time string, ingest_time timestamp, advertiser_id string, currency string, spend double"


def batch(spark, rows):
    df = spark.createDataFrame(rows, COLUMNS).withColumn("media_cost", F.lit(None).cast("double"))
    return tag_provenance(df, "v1", "f.csv", F.lit("2024-02-01T00:00:00Z").cast("timestamp"))


@pytest.fixture()
def load(spark, request):
    n = request.node.name.replace("[", "_").replace("]", "")
    config = MillConfig(bronze=f"b_{n}", silver=f"s_{n}", gold=f"g_{n}")
    return IncrementalLoad(spark, config)


def test_correction_moves_an_event_and_empties_its_old_day(spark, load):
    load.apply(batch(spark, [_event(1, "2024-01-01T10:00:00Z", "2024-01-01 11:00:00", 5.0),
                             _event(2, "2024-01-02T10:00:00Z", "2024-01-02 11:00:00", 7.0)]), "one")
    days = load.apply(batch(spark, [_event(1, "2024-01-02T10:00:00Z", "2024-01-03 11:00:00", 6.0)]), "two")
    assert days == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    gold = {str(r.event_date): (r.total_spend_usd, r.event_count) for r in spark.table(load.gold).collect()}
    assert gold == {"2024-01-02": (13.0, 2)}
    assert spark.table(load.silver).count() == 2
    assert spark.table(load.bronze).count() == 3


def test_older_and_equal_rows_lose_and_replay_changes_nothing(spark, load):
    first = [_event(1, "2024-01-01T10:00:00Z", "2024-01-05 00:00:00", 5.0)]
    load.apply(batch(spark, first), "one")
    late = [_event(1, "2024-01-01T10:00:00Z", "2024-01-05 00:00:00", 9.0), _event(1, "2024-01-09T10:00:00Z", "2024-01-04 00:00:00", 8.0)]
    assert load.apply(batch(spark, late), "two") == []
    before = gold_rows(spark, load.gold)
    load.apply(batch(spark, late), "two")
    load.apply(batch(spark, first), "one")
    assert gold_rows(spark, load.gold) == before
    assert spark.table(load.silver).first().cost_raw == 5.0
    assert spark.table(load.bronze).count() == 3


def test_invalid_correction_is_quarantined_and_does_not_displace(spark, load):
    load.apply(batch(spark, [_event(1, "2024-01-01T10:00:00Z", "2024-01-05 00:00:00", 5.0)]), "one")
    load.apply(batch(spark, [_event(1, "N/A", "2024-01-06 00:00:00", 9.0), _event(1, "2024-01-01T10:00:00Z", "2024-01-06 00:00:00", None)]), "two")
    assert spark.table(load.silver).first().cost_raw == 5.0
    reasons = sorted(r.quarantine_reason for r in spark.table(load.quarantine).collect())
    assert reasons == ["malformed_timestamp", "missing_cost"]


def test_new_column_is_added_on_the_way(spark, load):
    load.apply(batch(spark, [_event(1, "2024-01-01T10:00:00Z", "2024-01-05 00:00:00", 5.0)]), "one")
    load.apply(batch(spark, [_event(2, "2024-01-02T10:00:00Z", "2024-01-05 00:00:00", 5.0)]).withColumn("clicks", F.lit(3)), "two")
    got = {r.event_id: r.clicks for r in spark.table(load.silver).collect()}
    assert got == {"1": None, "2": 3}


def test_killed_run_is_finished_by_the_next_one(spark, load, monkeypatch):
    load.apply(batch(spark, [_event(1, "2024-01-01T10:00:00Z", "2024-01-01 11:00:00", 5.0),
                             _event(2, "2024-01-03T10:00:00Z", "2024-01-01 11:00:00", 1.0)]), "one")
    fix = [_event(1, "2024-01-02T10:00:00Z", "2024-01-03 11:00:00", 6.0)]

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(load, "_refresh", die)
        with pytest.raises(RuntimeError):
            load.apply(batch(spark, fix), "two")
    # The clean events already moved; the daily rows of the old day are still there.
    assert spark.table(load.gold).where("event_date = '2024-01-01'").count() == 1
    days = load.apply(batch(spark, fix), "two")
    assert days == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    gold = {str(r.event_date): r.total_spend_usd for r in spark.table(load.gold).collect()}
    assert gold == {"2024-01-02": 6.0, "2024-01-03": 1.0}
    assert spark.sql(f"SHOW TABLES IN {load.config.silver}").where("NOT isTemporary").count() == 2


def test_broken_rule_stops_the_batch_before_it_is_published(spark, load):
    load.apply(batch(spark, [_event(1, "2024-01-01T10:00:00Z", "2024-01-05 00:00:00", 5.0)]), "one")
    load.rules = [{"type": "null_rate", "column": "advertiser_id", "max_rate": 0.0}]
    with pytest.raises(DataQualityError, match="advertiser_id"):
        load.apply(batch(spark, [_event(2, "2024-01-01T10:00:00Z", "2024-01-05 00:00:00", 5.0, adv=None)]), "two")
    assert spark.table(load.bronze).count() == 2
    assert spark.table(load.silver).count() == 1
    assert spark.table(load.gold).first().event_count == 1


def test_new_dimension_renames_only_the_days_it_changes(spark, load):
    load.apply(batch(spark, [_event(1, "2024-01-01T10:00:00Z", "2024-01-05 00:00:00", 5.0, "a"),
                             _event(2, "2024-01-02T10:00:00Z", "2024-01-05 00:00:00", 5.0, "b")]), "one")
    dim = "advertiser_id string, advertiser_name string"
    assert load.load_dimension(spark.createDataFrame([("a", "Ann")], dim)) == [dt.date(2024, 1, 1)]
    assert load.load_dimension(spark.createDataFrame([("a", "Ann"), ("b", None)], dim)) == [dt.date(2024, 1, 2)]
    assert load.load_dimension(spark.createDataFrame([("a", "Ann"), ("b", None)], dim)) == []
    got = {r.advertiser_id: (r.advertiser_name, r.is_unmapped_advertiser, r.total_spend_usd) for r in spark.table(load.gold).collect()}
    assert got == {"a": ("Ann", False, 5.0), "b": ("UNKNOWN", False, 5.0)}


def test_batches_on_top_of_a_full_load_equal_one_full_load(spark, full):
    """First delivery in full, then everything re-sent in two batches, newest batch first."""
    config = MillConfig(bronze="ob", silver="os", gold="og")
    first = vendor_feeds(spark, SF, resends=False)
    FullLoad(spark, config).run(*first, full.dim)
    load = IncrementalLoad(spark, config)
    late = full.bronze.where("ingest_time >= '2024-01-15'")
    early = full.bronze.where("ingest_time < '2024-01-15'")
    load.apply(late, "late")
    load.apply(early, "early")
    assert gold_rows(spark, load.gold) == gold_rows(spark, "rg.daily_advertiser_spend")
    assert silver_rows(spark, load.silver) == silver_rows(spark, "rs.events")


def test_stream_equals_batch_and_restart_adds_nothing(spark, full, tmp_path):
    x = full
    config = MillConfig(bronze="stb", silver="sts", gold="stg")
    load = IncrementalLoad(spark, config)
    load.tables.ensure_namespaces()
    load.tables.overwrite(x.dim, load.dim)
    folders = []
    for version, feed in zip(("v1", "v2"), x.feeds):
        path = str(tmp_path / version)
        feed.repartition(4).write.parquet(path)
        folders.append(VendorFolder(path, feed.schema, version, "parquet", max_files_per_batch=3))
    # Where the cluster names a checkpoint folder it outlives the test, so each run takes its own name.
    checkpoint, name = str(tmp_path / "checkpoints"), f"ingest_{uuid.uuid4().hex}"
    query = start_incremental(spark, folders, config, name, checkpoint)
    query.awaitTermination(600)
    assert query.exception() is None
    assert len({r[0] for r in spark.table("stb.raw_events").select("ingest_batch").distinct().collect()}) > 1
    assert gold_rows(spark, "stg.daily_advertiser_spend") == gold_rows(spark, "rg.daily_advertiser_spend")
    assert silver_rows(spark, "sts.events") == silver_rows(spark, "rs.events")
    assert spark.table("stb.raw_events").count() == 1044
    assert spark.table("sts.quarantine_events").count() == 60

    again = start_incremental(spark, folders, config, name, checkpoint)
    again.awaitTermination(600)
    assert spark.table("stb.raw_events").count() == 1044
    assert gold_rows(spark, "stg.daily_advertiser_spend") == gold_rows(spark, "rg.daily_advertiser_spend")

    # A new checkpoint reads every file again, under new labels: raw rows repeat, clean rows do not.
    fresh = start_incremental(spark, folders, config, f"ingest_{uuid.uuid4().hex}", checkpoint)
    fresh.awaitTermination(600)
    assert spark.table("stb.raw_events").count() == 2088
    assert gold_rows(spark, "stg.daily_advertiser_spend") == gold_rows(spark, "rg.daily_advertiser_spend")


def test_stream_can_run_on_a_cadence(spark, full, tmp_path):
    config = MillConfig(bronze="cab", silver="cas", gold="cag")
    path = str(tmp_path / "v1")
    full.feeds.v1.write.parquet(path)
    folder = VendorFolder(path, full.feeds.v1.schema.add("media_cost", "double"), "v1", "parquet")
    name = f"ingest_{uuid.uuid4().hex}"
    query = start_incremental(spark, [folder], config, name, str(tmp_path / "cp"), every="1 second")
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    assert spark.table("cas.events").count() > 0
    assert spark.table("cag.daily_advertiser_spend").where("NOT is_unmapped_advertiser").count() == 0


def test_csv_folders_of_both_versions(spark, tmp_path):
    head = "event_id,event_time,ingest_time,advertiser_id,currency"
    for version, extra, line in (
        ("v1", "spend", "e1,2024-01-01T23:00:00Z,2024-01-02T00:00:00Z,adv_1,USD,5.0"),
        ("v2", "media_cost,viewability", "e2,2024-01-02T03:00:00+05:30,2024-01-02T00:00:00Z,adv_1,INR,83.0,0.5"),
    ):
        (tmp_path / version).mkdir()
        (tmp_path / version / "day_1.csv").write_text(f"{head},{extra}\n{line}\n")
    folders = [VendorFolder(str(tmp_path / "v1"), EVENTS_V1, "v1"), VendorFolder(str(tmp_path / "v2"), EVENTS_V2, "v2")]
    config = MillConfig(bronze="cvb", silver="cvs", gold="cvg")
    query = start_incremental(spark, folders, config, f"ingest_{uuid.uuid4().hex}", str(tmp_path / "cp"))
    query.awaitTermination(300)
    assert query.exception() is None
    rows = {r.event_id: r for r in spark.table("cvs.events").collect()}
    assert {k: (r.schema_version, str(r.event_date), r.cost_raw) for k, r in rows.items()} == {
        "e1": ("v1", "2024-01-01", 5.0),
        "e2": ("v2", "2024-01-01", 83.0),
    }
    assert rows["e2"].source_file.endswith("v2/day_1.csv")
    (day,) = spark.table("cvg.daily_advertiser_spend").collect()
    assert (day.total_spend_usd, day.event_count, day.is_unmapped_advertiser) == (pytest.approx(6.0), 2, True)


def test_heavy_day_is_written_by_several_tasks(spark, tmp_path):
    days = F.when(F.col("id") % 10 > 0, F.lit("2024-01-01")).otherwise(F.concat(F.lit("2024-01-1"), F.col("id") % 7))
    rows = spark.range(0, 400_000, numPartitions=8).select(F.xxhash64("id").alias("v"), days.cast("date").alias("event_date"))
    setting = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(setting, "256KB")
    try:
        by_day(rows).write.partitionBy("event_date").parquet(str(tmp_path / "t"))
    finally:
        spark.conf.unset(setting)
    files = {d.name: len(list(d.glob("*.parquet"))) for d in (tmp_path / "t").glob("event_date=*")}
    assert files.pop("event_date=2024-01-01") > 4
    # A light day that hashes to the heavy day's partition is split along with it; the others are not.
    assert sum(n == 1 for n in files.values()) >= 5
    assert spark.read.parquet(str(tmp_path / "t")).count() == 400_000


def _ids(spark, table):
    return sorted(r.event_id for r in spark.table(table).collect())


@pytest.mark.parametrize("step", ["_swap", "_refresh"])
def test_a_batch_in_between_does_not_lose_a_killed_one(spark, load, monkeypatch, step):
    rows = {n: [_event(i, "2024-01-01T10:00:00Z", "2024-01-01 11:00:00", float(i))] for i, n in enumerate(("one", "two", "three"), 1)}
    load.apply(batch(spark, rows["one"]), "one")

    def die(*_):
        raise RuntimeError("killed")

    with monkeypatch.context() as m:
        m.setattr(load, step, die)
        with pytest.raises(RuntimeError):
            load.apply(batch(spark, rows["two"]), "two")
    load.apply(batch(spark, rows["three"]), "three")
    load.apply(batch(spark, rows["two"]), "two")
    assert _ids(spark, load.silver) == ["1", "2", "3"]
    gold = spark.table(load.gold).collect()
    assert [(r.event_count, r.total_spend_usd) for r in gold] == [(3, 6.0)]


def test_labels_that_look_alike_stay_apart(spark, load, monkeypatch):
    load.apply(batch(spark, [_event(1, "2024-01-01T10:00:00Z", "2024-01-01 11:00:00", 1.0)]), "one")

    def die(*_):
        raise RuntimeError("killed")

    for i, label in enumerate(("day-1", "two"), 2):
        with monkeypatch.context() as m:
            m.setattr(load, "_swap", die)
            with pytest.raises(RuntimeError):
                load.apply(batch(spark, [_event(i, "2024-01-01T10:00:00Z", "2024-01-01 11:00:00", 1.0)]), label)
        load.apply(batch(spark, [_event(i + 10, "2024-01-01T10:00:00Z", "2024-01-01 11:00:00", 1.0)]), {"day-1": "day_1", "two": "two_rows"}[label])
    assert _ids(spark, load.silver) == ["1", "12", "13", "2", "3"]


def test_a_repeated_dimension_key_leaves_the_stored_dimension(spark, load):
    names = "advertiser_id string, advertiser_name string"
    load.load_dimension(spark.createDataFrame([("a", "A")], names))
    with pytest.raises(DataQualityError, match="not unique"):
        load.load_dimension(spark.createDataFrame([("a", "B"), ("a", "C")], names))
    assert [r.advertiser_name for r in spark.table(load.dim).collect()] == ["A"]


def test_rows_without_a_key_are_quarantined(spark, load):
    rows = [_event(1, "2024-01-01T10:00:00Z", "2024-01-01 11:00:00", 1.0)] + [(None, *_event(1, "2024-01-01T10:00:00Z", "2024-01-01 11:00:00", 2.0)[1:])] * 2
    load.apply(batch(spark, rows), "one")
    assert _ids(spark, load.silver) == ["1"]
    assert [r.quarantine_reason for r in spark.table(load.quarantine).collect()] == ["missing_event_id"] * 2
