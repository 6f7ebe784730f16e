"""The key index: upserts through it equal upserts by scan, cost what the batch costs, and survive full loads and kills."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from spendmill import MillConfig
from spendmill.operators import held_rows
from spendmill.plans import FullLoad, IncrementalLoad, key_index
from spendmill.plans.key_index import KeyIndex
from spendmill.sources.commits import LoadLog

from .test_commits import batch, dimension, killed_at, raw


def state(spark, load):
    return sorted((r.event_id, str(r.event_date), r.cost_raw) for r in spark.table(load.silver).collect())


def test_batches_through_the_index_equal_batches_by_scan(spark, monkeypatch):
    monkeypatch.setattr(key_index, "LOADS_KEPT", 1)  # entries are put together on the way
    rng, loads = random.Random(9), {}
    for name, buckets in (("indexed", 4), ("scanned", None)):
        loads[name] = IncrementalLoad(spark, MillConfig(bronze=f"xb{name}", silver=f"xs{name}", gold=f"xg{name}", key_buckets=buckets))
    for n in range(3):
        events = {str(rng.randrange(40)): (1 + rng.randrange(5), float(rng.randrange(100)), rng.randrange(60)) for _ in range(15)}
        for load in loads.values():
            load.apply(batch(spark, events), f"batch {n}")
    assert state(spark, loads["indexed"]) == state(spark, loads["scanned"])
    indexed = loads["indexed"]
    incoming = spark.table(indexed.silver).where("event_id < '3'")
    by_index, by_scan = KeyIndex(indexed).held(incoming), held_rows(spark.table(indexed.silver), incoming, day=F.col("event_date"))
    assert sorted(map(tuple, by_index.collect())) == sorted(map(tuple, by_scan.collect()))
    assert "xsindexed/events/" not in "".join(by_index.inputFiles())


def test_only_the_buckets_of_the_batch_are_opened(spark):
    load = IncrementalLoad(spark, MillConfig(bronze="yb", silver="ys", gold="yg", key_buckets=16))
    load.apply(batch(spark, {str(i): (1 + i % 5, 1.0, 0) for i in range(400)}), "one")
    load.apply(batch(spark, {"7": (1, 2.0, 1)}), "two")
    index, silver = KeyIndex(load), spark.table(load.silver)
    opened = lambda n: len({f.split("key_bucket=")[1].split("/")[0] for f in index.held(silver.where(F.col("event_id").cast("int") < n)).inputFiles() if "key_bucket" in f})
    plans = [index.held(silver.where(F.col("event_id").cast("int") < n))._jdf.queryExecution().executedPlan().toString() for n in (1, 400)]
    assert all(re.search(r"PartitionFilters: \[[^\]]*key_bucket", plan) for plan in plans)
    assert opened(1) == 1 and opened(400) == 16


def test_full_loads_and_kills_leave_no_stale_index(spark, monkeypatch):
    config = MillConfig(bronze="zb", silver="zs", gold="zg", key_buckets=4)
    full, load, plain = FullLoad(spark, config), IncrementalLoad(spark, config), IncrementalLoad(spark, MillConfig(bronze="zb", silver="zs", gold="zg"))
    load.apply(batch(spark, {"1": (1, 5.0, 5)}), "one")
    load.load_dimension(dimension(spark))
    load.apply(batch(spark, {"2": (1, 5.0, 5)}), "two")
    assert spark.catalog.tableExists(load.keys)
    full.run(raw(spark, {"1": (2, 1.0, 0)}), raw(spark, {}).drop("spend"), dimension(spark))
    assert not spark.catalog.tableExists(load.keys)
    load.apply(batch(spark, {"1": (3, 2.0, 1), "2": (1, 3.0, 1)}), "three")  # older than what the full load replaced
    assert state(spark, load) == [("1", "2024-01-03", 2.0), ("2", "2024-01-01", 3.0)]
    # Killed before the commit: the index must not claim rows that never came.
    with monkeypatch.context() as m:
        m.setattr(LoadLog, "commit", lambda *_: (_ for _ in ()).throw(RuntimeError("killed")))
        with pytest.raises(RuntimeError):
            load.apply(batch(spark, {"1": (4, 9.0, 9)}), "four")
    load.apply(batch(spark, {"1": (4, 8.0, 8)}), "five")
    assert state(spark, load)[0] == ("1", "2024-01-04", 8.0)
    # Killed while putting in place: the next batch finds the index whole.
    assert killed_at(monkeypatch, 8, lambda: load.apply(batch(spark, {"1": (5, 10.0, 10)}), "six"))
    load.apply(batch(spark, {"1": (1, 9.5, 9)}), "seven")
    assert state(spark, load)[0] == ("1", "2024-01-05", 10.0)
    # A load that keeps no index drops it.
    plain.apply(batch(spark, {"1": (5, 11.0, 11)}), "eight")
    assert not spark.catalog.tableExists(load.keys)
    load.apply(batch(spark, {"1": (1, 9.5, 10)}), "nine")
    assert state(spark, load)[0] == ("1", "2024-01-05", 11.0)
