"""Apply one batch of new or corrected vendor rows to stored layers, rewriting only the days it touches.

Raw and rejected rows, the rewritten days and their daily rows are all staged first and then committed as one version
of the layers. A run killed before the commit has changed nothing and is to be run again; one killed after it is
finished by running it again, or by the next load of any kind, before that load looks at the layers. The upsert ignores
rows that are not strictly newer, so a batch may be applied twice. Loads run one at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import MillConfig, assert_utc
from ..operators import (
    DataQualityError,
    Rule,
    beating,
    daily_spend,
    days_of_change,
    dedup_latest,
    dq_report,
    duplicate_keys,
    enforce,
    held_rows,
    join_dimension,
    replace_rows,
    split,
    stamp_ingest,
    to_usd,
)
from ..operators.rollup import GOLD_COLUMNS
from ..sources.commits import Change
from ..sources.layers import StoredLayers
from .batch import by_day, dated
from .key_index import KeyIndex
from .layers import build_labelled


def tag_of(label: str) -> str:
    """A name for the batch's stages that no other label shares."""
    return hashlib.sha256(label.encode()).hexdigest()[:24]


class IncrementalLoad(StoredLayers):
    """``rules`` are checked on the clean rows of every batch, before any clean or daily row changes."""

    def __init__(
        self,
        spark: SparkSession,
        config: MillConfig | None = None,
        rules: Sequence[Rule | Mapping] = (),
        now: Column | datetime | str | None = None,
    ):
        super().__init__(spark, config)
        self.rules, self.now = rules, now

    def apply(self, rows: DataFrame, label: str) -> list[date]:
        """Take in ``rows`` (tagged with their provenance) as batch ``label``; returns the days refreshed.

        ``label`` must be unique to the batch and the same when the batch is retried. A batch that
        fails a rule raises ``DataQualityError``: its raw rows are kept, nothing is published.
        """
        assert_utc(self.spark)
        tag, tables = tag_of(label), self.tables
        done = self.recover()
        if done and done.label == tag:
            return [date.fromisoformat(d) for d in done.days]
        if index := self._index():
            index.make_ready()
        batch = tables.conform(rows.withColumns({"ingest_batch": F.lit(label)}), self.bronze)
        raw = tables.stage(batch, self.bronze, f"{tag}_raw", ["ingest_batch"])
        good, rejected = split(build_labelled(tables.read(raw), self.config))
        quarantine = tables.stage(rejected, self.quarantine, f"{tag}_rejected", ["ingest_batch"])
        changes = [Change(self.bronze, raw, "ingest_batch"), Change(self.quarantine, quarantine, "ingest_batch")]
        if self.rules:
            try:
                enforce(dq_report(good, self.rules, self.now))
            except DataQualityError:
                self.publish(f"{tag} refused", changes)
                raise
        days, rewritten, entries = self._stage_days(dated(good), tag)
        if days:
            changes += entries
            changes += [Change(self.silver, rewritten, "event_date", dropped=self._emptied(days, rewritten))]
            changes += [Change(self.gold, self._stage_gold(rewritten, tag), "event_date", dropped=changes[-1].dropped)]
        self.publish(tag, changes, days)
        return days

    def _index(self) -> KeyIndex | None:
        return KeyIndex(self) if self.config.key_buckets and self.tables.exists(self.silver) else None

    def load_dimension(self, dim: DataFrame) -> list[date]:
        """Replace the dimension and rename the daily rows it changes; returns their days.

        Sums do not depend on the dimension, so no event is read again.
        """
        tables = self.tables
        self.recover()
        if not duplicate_keys(dim, "advertiser_id").isEmpty():
            raise DataQualityError("the dimension's advertiser_id is not unique; the stored one stays")
        staged = tables.stage(stamp_ingest(dim), self.dim, "dimension")
        changes, days = [Change(self.dim, staged, None, whole=True)], []
        if tables.exists(self.gold):
            before = tables.read(self.gold).withColumnsRenamed(
                {"advertiser_name": "_name", "is_unmapped_advertiser": "_unmapped"}
            )
            renamed = join_dimension(before, tables.read(staged))
            differs = ~(
                F.col("_name").eqNullSafe(F.col("advertiser_name"))
                & F.col("_unmapped").eqNullSafe(F.col("is_unmapped_advertiser"))
            )
            # One value per calendar day.
            days = [r.event_date for r in renamed.where(differs).select("event_date").distinct().collect()]
            if days:
                affected = renamed.where(F.col("event_date").isin(days)).select(*GOLD_COLUMNS)
                changes.append(Change(self.gold, tables.stage(affected, self.gold, "dimension", ["event_date"]), "event_date"))
        self.publish("dimension", changes, sorted(days))
        return sorted(days)

    def _stage_days(self, good: DataFrame, tag: str) -> tuple[list[date], str, list[Change]]:
        """The days that the batch touches, the staged clean events of those days after the upsert, and the winners'
        entries for the key index, where one is kept."""
        tables, c = self.tables, self.config
        if tables.exists(self.silver):
            current = tables.read(self.silver)
        else:
            current = self.spark.createDataFrame([], good.schema)
        newest = dedup_latest(good, c.key, c.order, c.tie_breakers)
        incoming = tables.read(tables.stage(newest, self.silver, f"{tag}_incoming"))
        index = self._index()
        held = index.held(incoming) if index else held_rows(current, incoming, c.key, c.order, F.col("event_date"))
        held = tables.read(tables.stage(held, self.silver, f"{tag}_held"))
        winners = beating(incoming, held, c.key, c.order)
        # One value per calendar day, so the list is bounded by the calendar.
        touched = days_of_change(held, winners, c.key).distinct().collect()
        days = sorted(r.event_date for r in touched)
        if not days:
            return [], "", []
        # The listed days become partition filters: the rest of the table is not opened.
        affected = current.where(F.col("event_date").isin(days))
        rewritten = tables.stage(by_day(replace_rows(affected, winners, c.key)), self.silver, f"{tag}_rows", ["event_date"])
        return days, rewritten, [index.entries(winners, tag)] if index else []

    def _stage_gold(self, rewritten: str, tag: str) -> str:
        """The daily rows of the rewritten days, from their staged events: those are all the events of the days."""
        events = self.tables.read(rewritten)
        fresh = daily_spend(to_usd(events.drop("event_date"), self.config.usd_rates), self._dimension(events))
        return self.tables.stage(by_day(fresh), self.gold, f"{tag}_gold", ["event_date"])

    def _emptied(self, days: list[date], rewritten: str) -> list[str]:
        left = {r.event_date for r in self.tables.read(rewritten).select("event_date").distinct().collect()}
        return [str(d) for d in days if d not in left]

    def _dimension(self, events: DataFrame) -> DataFrame:
        if self.tables.exists(self.dim):
            return self.tables.read(self.dim)
        kind = events.schema["advertiser_id"].dataType
        fields = [T.StructField("advertiser_id", kind), T.StructField("advertiser_name", T.StringType())]
        return self.spark.createDataFrame([], T.StructType(fields))
