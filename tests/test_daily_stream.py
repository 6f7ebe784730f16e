"""Days that reach the layers as a whole, by watermark; what comes late is upserted."""

from __future__ import annotations

import os
import uuid

from spendmill import EVENTS_V1, MillConfig, load_events, tag_provenance
from spendmill.plans import IncrementalLoad
from spendmill.streaming import VendorFolder, start_daily

FIELDS = ("event_id", "event_time", "ingest_time", "advertiser_id", "currency", "spend")
# One file per micro-batch. The comments say what the watermark (one day behind the newest event) makes of each.
FILES = {
    "a": [  # nothing is closed yet; the last two are rejected and applied at once
        ("1", "2024-01-01T10:00:00Z", "2024-01-01T11:00:00Z", "adv_1", "USD", 5.0),
        ("1", "2024-01-01T10:00:00Z", "2024-01-01T11:00:00Z", "adv_1", "USD", 5.0),
        ("1", "2024-01-01T12:00:00Z", "2024-01-01T13:00:00Z", "adv_1", "USD", 6.0),
        ("2", "2024-01-02T03:00:00+05:30", "2024-01-02T11:00:00Z", "adv_2", "INR", 83.0),
        ("3", "2024-01-02T10:00:00Z", "2024-01-02T11:00:00Z", "adv_2", "USD", 7.0),
        ("8", "N/A", "2024-01-02T11:00:00Z", "adv_2", "USD", 7.0),
        ("", "2024-01-02T10:00:00Z", "2024-01-02T11:00:00Z", "adv_2", "USD", 7.0),
    ],
    "b": [("4", "2024-01-05T10:00:00Z", "2024-01-05T11:00:00Z", "adv_1", "USD", 1.0)],  # closes the first three days
    "c": [
        ("5", "2024-01-01T09:00:00Z", "2024-01-06T11:00:00Z", "adv_1", "USD", 2.0),  # late
        ("3", "2024-01-01T10:00:00Z", "2024-01-06T11:00:00Z", "adv_2", "USD", 9.0),  # late, moves event 3
        ("7", "2024-01-03T10:00:00Z", "2024-01-06T11:00:00Z", "adv_3", "USD", 3.0),  # late for a day without events
        ("4", "2024-01-05T10:00:00Z", "2024-01-06T11:00:00Z", "adv_1", "USD", 1.5),  # in time
        ("4", "2024-01-05T10:00:00Z", "2024-01-04T11:00:00Z", "adv_1", "USD", 8.0),  # in time, an older version
    ],
    "d": [("9", "2024-01-09T10:00:00Z", "2024-01-09T11:00:00Z", "adv_1", "USD", 4.0)],  # closes up to the 7th, stays open
}


def _write(folder, name, at):
    lines = [",".join(FIELDS), *(",".join(map(str, r)) for r in FILES[name])]
    path = folder / f"{name}.csv"
    path.write_text("\n".join(lines) + "\n")
    os.utime(path, (at, at))


def _layers(spark, load):
    gold = {(str(r.event_date), r.advertiser_id): (round(r.total_spend_usd, 6), r.event_count) for r in spark.table(load.gold).collect()}
    raw = sorted(map(repr, spark.table(load.bronze).select(*FIELDS).collect()))
    bad = sorted(r.quarantine_reason for r in spark.table(load.quarantine).collect())
    return gold, raw, bad


def test_closed_days_and_late_rows_equal_the_batch(spark, tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()
    schema = EVENTS_V1
    config, name = MillConfig(bronze="wb", silver="ws", gold="wg"), f"days_{uuid.uuid4().hex}"
    load = IncrementalLoad(spark, config)

    def run() -> None:
        feed = VendorFolder(str(folder), schema, "v1", max_files_per_batch=1)
        query = start_daily(spark, [feed], config, name, str(tmp_path / "cp"), delay="1 day")
        query.awaitTermination(300)
        assert query.exception() is None

    def expected(names, open_ids, tag):
        other = IncrementalLoad(spark, MillConfig(bronze=f"wb{tag}", silver=f"ws{tag}", gold=f"wg{tag}"))
        rows = load_events(spark, [str(folder / f"{n}.csv") for n in names], schema)
        rows = tag_provenance(rows.where(~rows.event_id.isin(open_ids) | rows.event_id.isNull()), "v1", "f.csv")
        other.apply(rows, "all")
        return _layers(spark, other)

    _write(folder, "a", 1_700_000_000)
    run()
    assert not spark.catalog.tableExists(load.gold)  # every good row waits
    assert spark.table(load.bronze).count() == 2
    _write(folder, "b", 1_700_000_100)
    run()
    assert _layers(spark, load) == expected("ab", ["4"], 1)
    _write(folder, "c", 1_700_000_200)
    _write(folder, "d", 1_700_000_300)
    run()
    found = _layers(spark, load)
    assert found == expected("abcd", ["9"], 2)
    assert found[0][("2024-01-01", "adv_2")][1] == 2 and ("2024-01-02", "adv_2") not in found[0]
    assert found[0][("2024-01-05", "adv_1")] == (1.5, 1) and found[0][("2024-01-03", "adv_3")] == (3.0, 1)
