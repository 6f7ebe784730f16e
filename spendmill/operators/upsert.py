"""Late corrections: the newest version of each key wins, on any table format."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import calendar_day
from .dedup import dedup_latest

TIES = ("cost_raw", "currency", "advertiser_id", "event_time_utc")


def _newer(incoming: Column, held: Column) -> Column:
    """True when ``incoming`` is strictly newer; NULL is older than any value."""
    return F.coalesce(incoming > held, incoming.isNotNull() & held.isNull())


def held_rows(
    target: DataFrame, incoming: DataFrame, key: str = "event_id", order: str = "ingest_time", day: Column | None = None
) -> DataFrame:
    """(_key, _held, _day): key, order and calendar day of the target's rows whose key is incoming.

    This is all an upsert needs to know of the target before it rewrites anything: one read of the
    few columns, cut to the incoming keys. While those are under the broadcast threshold the target
    is not shuffled. ``day`` may name a stored date column, which then replaces the event time.
    """
    keys = incoming.select(F.col(key).alias("_in_key"))
    day = calendar_day("event_time_utc") if day is None else day
    held = target.select(F.col(key).alias("_key"), F.col(order).alias("_held"), day.alias("_day"))
    return held.join(keys, F.col("_key").eqNullSafe(F.col("_in_key")), "left_semi")


def beating(incoming: DataFrame, held: DataFrame, key: str = "event_id", order: str = "ingest_time") -> DataFrame:
    """The incoming rows (one per key) that are new, or strictly newer than the held row of their key."""
    beaten = F.col(key).eqNullSafe(F.col("_key")) & ~_newer(F.col(order), F.col("_held"))
    return incoming.join(held, beaten, "left_anti")


def days_of_change(held: DataFrame, winners: DataFrame, key: str = "event_id") -> DataFrame:
    """Distinct ``event_date`` that replacing rows touches: the winners' days and, since a correction
    may move an event to another day, the days of the held rows they replace."""
    keys = winners.select(F.col(key).alias("_won"))
    old = held.join(keys, F.col("_key").eqNullSafe(F.col("_won")), "left_semi")
    new = winners.select(calendar_day("event_time_utc"))
    return old.select(F.col("_day").alias("event_date")).union(new).distinct()


def winning_rows(
    target: DataFrame,
    source: DataFrame,
    key: str = "event_id",
    order: str = "ingest_time",
    tie_breakers: Sequence[str] = TIES,
) -> DataFrame:
    """The rows of ``source`` that change ``target`` (unique on ``key``), at most one per key."""
    incoming = dedup_latest(source, key, order, tie_breakers)
    return beating(incoming, held_rows(target, incoming, key, order), key, order)


def replace_rows(target: DataFrame, winners: DataFrame, key: str = "event_id") -> DataFrame:
    """``target`` with each winner in place of the row of its key, or added."""
    keys = winners.select(F.col(key).alias("_won"))
    kept = target.join(keys, F.col(key).eqNullSafe(F.col("_won")), "left_anti")
    return kept.unionByName(winners, allowMissingColumns=True)


def upsert_latest(
    target: DataFrame,
    source: DataFrame,
    key: str = "event_id",
    order: str = "ingest_time",
    tie_breakers: Sequence[str] = TIES,
) -> DataFrame:
    """``target`` (unique on ``key``) after the upsert of ``source``.

    A source row replaces the target's only if its ``order`` is strictly greater, so replaying a
    batch changes nothing and the order of batches does not matter.
    """
    return replace_rows(target, winning_rows(target, source, key, order, tie_breakers), key)


def touched_days(
    target: DataFrame,
    source: DataFrame,
    key: str = "event_id",
    order: str = "ingest_time",
    tie_breakers: Sequence[str] = TIES,
) -> DataFrame:
    """Distinct ``event_date`` whose daily rows the upsert of ``source`` changes."""
    incoming = dedup_latest(source, key, order, tie_breakers)
    held = held_rows(target, incoming, key, order)
    return days_of_change(held, beating(incoming, held, key, order), key)


def merge_statement(
    target: str,
    source: str,
    columns: Sequence[str],
    key: str = "event_id",
    order: str = "ingest_time",
    tie_breakers: Sequence[str] = TIES,
) -> str:
    """The upsert as ``MERGE INTO``, for tables in a format that supports it.

    ``MERGE`` fails when two source rows match one target row, so the source is first reduced to the
    newest row per key. ``ingest_time`` ties keep the target's row, as in ``upsert_latest``.
    """
    rest = [c for c in columns if c != key]
    newest = ", ".join(dict.fromkeys([order, *(t for t in tie_breakers if t in rest), *rest]))
    fields = ", ".join(f"newest.{c} AS {c}" for c in rest)
    updates = ", ".join(f"t.{c} = s.{c}" for c in rest)
    names = ", ".join(columns)
    values = ", ".join(f"s.{c}" for c in columns)
    return (
        f"MERGE INTO {target} AS t\n"
        f"USING (SELECT {key}, {fields} FROM\n"
        f"       (SELECT {key}, max(struct({newest})) AS newest FROM {source} GROUP BY {key})) AS s\n"
        f"ON t.{key} <=> s.{key}\n"
        f"WHEN MATCHED AND (s.{order} > t.{order} OR (t.{order} IS NULL AND s.{order} IS NOT NULL))\n"
        f"  THEN UPDATE SET {updates}\n"
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )
