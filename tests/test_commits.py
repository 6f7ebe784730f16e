"""All layers change at once: kills at every step of both runners, one after the other on the same tables."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spendmill import MillConfig, tag_provenance
from spendmill.plans import FullLoad, IncrementalLoad
from spendmill.sources.commits import LoadLog
from spendmill.sources.layers import StoredLayers
from spendmill.sources.tables import LayerTables

COLUMNS = "event_id string, event_time string, ingest_time timestamp, advertiser_id string, currency string, spend double"
STEPS = ((LayerTables, "stage"), (LayerTables, "replace_partitions"), (LayerTables, "publish"), (LayerTables, "drop_partitions"), (LoadLog, "commit"), (LoadLog, "finished"))


class Killed(Exception):
    pass


def raw(spark, events):
    """``events``: {id: (day of January, cost, hour of ingest)}; a negative cost is a row for quarantine."""
    rows = [(i, f"2024-01-{day:02d}T10:00:00Z", dt.datetime(2024, 2, 1) + dt.timedelta(hours=hour), "a", "USD", cost) for i, (day, cost, hour) in events.items()]
    return spark.createDataFrame(rows, COLUMNS).withColumn("media_cost", F.lit(None).cast("double"))


def batch(spark, events):
    return tag_provenance(raw(spark, events), "v1", "f.csv", F.lit("2024-02-01T00:00:00Z").cast("timestamp"))


def dimension(spark, name="Ann"):
    return spark.createDataFrame([("a", name)], "advertiser_id string, advertiser_name string")


def contents(frames, layers):
    """What the layers hold: clean events, daily sums, numbers of raw and rejected rows, the name."""
    silver = {r.event_id: (str(r.event_date), r.cost_raw) for r in frames[layers.silver].collect()}
    gold = {str(r.event_date): (r.total_spend_usd, r.event_count, r.advertiser_name) for r in frames[layers.gold].collect()}
    labels = {r.ingest_batch: r["count"] for r in frames[layers.bronze].groupBy("ingest_batch").count().collect()}
    return silver, gold, labels, frames[layers.quarantine].count(), frames[layers.dim].first().advertiser_name


def expected(silver, labels, rejected, name):
    gold = {}
    for day, cost in silver.values():
        total, n, _ = gold.get(day, (0.0, 0, name))
        gold[day] = (total + cost, n + 1, name)
    return silver, gold, labels, rejected, name


def killed_at(monkeypatch, step, run):
    """``run`` with the ``step``-th change of tables or log from its first stage on raising instead; whether it came to that."""
    seen = 0
    with monkeypatch.context() as m:
        for owner, name in STEPS:

            def wrapped(self, *args, _real=getattr(owner, name), _name=name, **kwargs):
                nonlocal seen
                seen += bool(seen or _name == "stage")
                if seen == step + 1:
                    raise Killed
                return _real(self, *args, **kwargs)

            m.setattr(owner, name, wrapped)
        try:
            run()
        except Killed:
            return True
    return False


# The kind of load, the step at which it is killed, and whether it has been committed by then: a batch stages six tables
# and a full load five, then comes the commit, then each table is put in place.
KILLS = (
    ("batch", 6, False), ("full", 5, False), ("batch", 7, True), ("full", 6, True), ("full", 8, True), ("batch", 8, True),
    ("batch", 10, True), ("full", 11, True), ("full", 2, False), ("batch", 11, True), ("full", 14, True), ("batch", 99, True),
)


def test_every_kill_leaves_one_version(spark, monkeypatch):
    config = MillConfig(bronze="kb", silver="ks", gold="kg")
    full, load, layers = FullLoad(spark, config), IncrementalLoad(spark, config), StoredLayers(spark, config)
    full.run(raw(spark, {"1": (1, 5.0, 0), "2": (2, 7.0, 0), "x": (2, -1.0, 0)}), raw(spark, {}).drop("spend"), dimension(spark))
    now = expected({"1": ("2024-01-01", 5.0), "2": ("2024-01-02", 7.0)}, {"full": 3}, 1, "Ann")
    version = layers.log.version()
    for hour, (kind, step, committed) in enumerate(KILLS, 1):
        day, cost, name, label = 1 + hour % 3, 10.0 + hour, f"Ann {hour}", f"batch {hour}"
        if kind == "batch":
            after = expected(now[0] | {"1": (f"2024-01-{day:02d}", cost)}, now[2] | {label: 2}, now[3] + 1, now[4])
            run = lambda: load.apply(batch(spark, {"1": (day, cost, hour), "x": (1, -1.0, hour)}), label)  # noqa: E731, B023
        else:
            events = {"1": (day, cost, hour), "3": (2, 50.0, hour)}
            after = expected({"1": (f"2024-01-{day:02d}", cost), "3": ("2024-01-02", 50.0)}, {"full": 2}, 0, name)
            run = lambda: full.run(raw(spark, events), raw(spark, {}).drop("spend"), dimension(spark, name))  # noqa: E731, B023
        assert killed_at(monkeypatch, step, run) == (step < 99)
        # A kill may leave a load half in place, which the next one finds; what counts is whole all the same.
        found, frames = layers.snapshot()
        now = after if committed else now
        assert (found > version, contents(frames, layers)) == (committed, now)
        version = found
    layers.recover()
    assert contents({t: spark.table(t) for t in layers.layers}, layers) == now
    assert not [t for table in layers.layers for t in layers.tables.staged(table)]


def test_a_staged_batch_does_not_survive_a_full_load(spark, monkeypatch):
    config = MillConfig(bronze="lb", silver="ls", gold="lg")
    full, load = FullLoad(spark, config), IncrementalLoad(spark, config)
    load.apply(batch(spark, {"1": (1, 5.0, 0)}), "one")
    load.load_dimension(dimension(spark))
    assert killed_at(monkeypatch, 6, lambda: load.apply(batch(spark, {"2": (1, 7.0, 1)}), "two"))  # staged, not committed
    full.run(raw(spark, {"1": (1, 100.0, 2), "3": (1, 50.0, 2)}), raw(spark, {}).drop("spend"), dimension(spark))
    load.apply(batch(spark, {"4": (1, 1.0, 3)}), "three")
    assert {r.event_id: r.cost_raw for r in spark.table("ls.events").collect()} == {"1": 100.0, "3": 50.0, "4": 1.0}
    assert [(r.total_spend_usd, r.event_count) for r in spark.table("lg.daily_advertiser_spend").collect()] == [(151.0, 3)]


def test_log_never_overwrites_a_version(spark, tmp_path):
    log, other = LoadLog(spark, str(tmp_path / "log")), LoadLog(spark, str(tmp_path / "log"))
    assert log.version() == 0 and log.pending() is None
    record = log.commit("one", [], ["2024-01-01"])
    assert other.pending() == record and other.version() == 1
    real = LoadLog.version
    try:
        LoadLog.version = lambda self: 0  # as seen by a load that started before the commit
        with pytest.raises(Exception, match="exist"):
            other.commit("late", [])
    finally:
        LoadLog.version = real
    log.finished(record)
    assert other.pending() is None and other.record(1).label == "one"
