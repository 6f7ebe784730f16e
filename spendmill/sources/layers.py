"""The stored layers under one configuration: their names, their version, and loads that change all of them at once."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from ..config import ADVERTISER_DIM, CLEAN_EVENTS, DAILY_SPEND, QUARANTINE_EVENTS, RAW_EVENTS, MillConfig
from .commits import Change, LoadLog, Record, as_changed, log_folder, put_in_place
from .tables import LayerTables


class StoredLayers:
    def __init__(self, spark: SparkSession, config: MillConfig | None = None):
        self.spark = spark
        self.tables = LayerTables(spark, config)
        self.config = c = self.tables.config
        self.bronze = c.table("bronze", RAW_EVENTS)
        self.dim = c.table("bronze", ADVERTISER_DIM)
        self.silver = c.table("silver", CLEAN_EVENTS)
        self.quarantine = c.table("silver", QUARANTINE_EVENTS)
        self.gold = c.table("gold", DAILY_SPEND)
        self.report = c.table("gold", "load_report")
        self.keys = c.table("silver", f"{CLEAN_EVENTS}_keys")

    @property
    def layers(self) -> tuple[str, ...]:
        return self.bronze, self.dim, self.quarantine, self.silver, self.gold

    @cached_property
    def log(self) -> LoadLog:
        self.tables.ensure_namespaces()
        return LoadLog(self.spark, log_folder(self.spark, self.tables))

    def snapshot(self) -> tuple[int, dict[str, DataFrame]]:
        """The version that counts and every layer of it, also while a load is being put in place or was killed there."""
        pending = self.log.pending()
        changed = {c.table: c for c in pending.changes} if pending else {}
        found = {t: as_changed(self.tables, changed[t]) if t in changed else self.tables.read(t) for t in self.layers if t in changed or self.tables.exists(t)}
        return self.log.version(), found

    def recover(self) -> Record | None:
        """Finish the load that a killed run had committed, forget what one had only staged; returns the finished load."""
        pending = self.log.pending()
        if pending:
            self._finish(pending)
        else:
            self._forget_stages()
        return pending

    def _forget_stages(self) -> None:
        for table in (*self.layers, self.keys):
            self.tables.drop_staged(table)

    def publish(self, label: str, changes: Sequence[Change], days: Sequence[date] = ()) -> Record:
        """Commit staged changes of any of the layers as one version, then put them in place.

        A change of the clean events that does not bring the key index along drops the index.
        """
        changed = {c.table for c in changes}
        if self.silver in changed and self.keys not in changed and self.tables.exists(self.keys):
            changes = [*changes, Change(self.keys, None, None, whole=True)]
        record = self.log.commit(label, changes, [str(d) for d in days])
        self._finish(record)
        return record

    def _finish(self, record: Record) -> None:
        self._swap(record)
        self._refresh(record)
        self.log.finished(record)
        self._forget_stages()

    def _swap(self, record: Record) -> None:
        """Put every layer but the daily table in place."""
        for change in record.changes:
            if change.table != self.gold:
                put_in_place(self.tables, change)

    def _refresh(self, record: Record) -> None:
        for change in record.changes:
            if change.table == self.gold:
                put_in_place(self.tables, change)
