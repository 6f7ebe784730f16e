"""The full rebuild: every layer is stored, the next one reads the stored table, and the daily table
is published only if the layers add up and the quality rules hold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import assert_utc
from ..functions import calendar_day
from ..operators import Rule, daily_spend, dq_report, enforce, reconcile, split, stamp_ingest, to_usd
from ..sources.commits import Change
from ..sources.layers import StoredLayers
from .layers import build_bronze, build_labelled, build_silver

FULL_LOAD = "full"


def dated(events: DataFrame) -> DataFrame:
    return events.withColumns({"event_date": calendar_day("event_time_utc")})


def by_day(df: DataFrame) -> DataFrame:
    """Lay rows out for a write partitioned by day. Adaptive execution sizes the tasks: a heavy day
    is split over several and light days share one, so no day is a single task or a thousand files."""
    return df.hint("rebalance", F.col("event_date"))


class FullLoad(StoredLayers):
    def run(
        self, v1: DataFrame, v2: DataFrame, dim: DataFrame, rules: Sequence[Rule | Mapping] = (), now=None
    ) -> DataFrame:
        """Rebuild all layers; returns the stored reconciliation report. Raises ``DataQualityError``, and
        leaves all published layers as they were, when a check or a rule (on the clean events) fails.

        All layers change with one commit: a run killed before it leaves the old version of every layer, one killed
        after it is finished by the next load of any kind. A full load is the whole delivery: what other batches had
        only staged is forgotten, and partitions of other batches go and are to be applied again.
        """
        assert_utc(self.spark)
        self.recover()
        feeds, tables, read = [v1, v2], self.tables, self.tables.read
        raw = self._stage_raw(v1, v2, dim)
        bronze, advertisers = read(raw[0].staged), read(raw[1].staged)
        good, rejected = split(build_labelled(bronze, self.config))
        quarantine = tables.stage(rejected, self.quarantine, FULL_LOAD, ["ingest_batch"])
        silver = tables.stage(by_day(dated(build_silver(good, self.config))), self.silver, FULL_LOAD, ["event_date"])
        if rules:
            enforce(dq_report(read(silver), rules, now))
        events = to_usd(read(silver), self.config.usd_rates)
        gold = tables.stage(by_day(daily_spend(events, advertisers)), self.gold, FULL_LOAD, ["event_date"])
        checks = reconcile(feeds, bronze, read(quarantine), good, events, read(gold), advertisers)
        tables.overwrite(checks, self.report)
        enforce(read(self.report))
        changes = [
            *raw,
            Change(self.quarantine, quarantine, "ingest_batch", whole=True),
            Change(self.silver, silver, "event_date", whole=True),
            Change(self.gold, gold, "event_date", whole=True),
        ]
        self.publish(FULL_LOAD, changes)
        return read(self.report)

    def load_bronze(self, v1: DataFrame, v2: DataFrame, dim: DataFrame) -> None:
        """Replace the raw layer and the dimension alone."""
        self.recover()
        self.publish(FULL_LOAD, self._stage_raw(v1, v2, dim))

    def _stage_raw(self, v1: DataFrame, v2: DataFrame, dim: DataFrame) -> list[Change]:
        """The raw layer, whose columns are only ever added to, and the dimension."""
        rows = build_bronze(v1, v2).withColumns({"ingest_batch": F.lit(FULL_LOAD)})
        if self.tables.exists(self.bronze):
            rows = with_columns_of(rows, self.tables.read(self.bronze))
        bronze = self.tables.stage(rows, self.bronze, FULL_LOAD, ["ingest_batch"])
        dimension = self.tables.stage(stamp_ingest(dim), self.dim, FULL_LOAD)
        return [Change(self.bronze, bronze, "ingest_batch", whole=True), Change(self.dim, dimension, None, whole=True)]


def with_columns_of(rows: DataFrame, held: DataFrame) -> DataFrame:
    """``rows`` with the columns that only ``held`` has, filled with NULL."""
    gone = [f for f in held.schema.fields if f.name not in rows.columns]
    return rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in gone}) if gone else rows
