"""Vendor feeds derived from the ``events`` and ``customer`` tables.

The tables are clean, so the defects a real vendor sends (bad or missing times, mixed offsets,
negative or missing cost, missing currency, exact copies, later corrections) are written into the
rows by arithmetic on ``event_id``. Every event is used; the arithmetic only decides what is wrong
with it. Each feed is one scan: copies come from exploding a short array, not from re-reading.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession

# The columns of the given tables, so reading them never samples a file.
EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
CUSTOMER = "c_custkey BIGINT, c_name STRING"

class Feeds(NamedTuple):
    v1: DataFrame
    v2: DataFrame


# 0 = the event as first sent, 1 = an exact copy, 2 = a later correction.
_FIRST = "array(0)"
_ALL_SENT = "array_compact(array(0, IF(event_id % 41 = 1, 1, NULL), IF(event_id % 53 = 6, 2, NULL)))"
_SIGNED = "IF(event_id % 73 = 4, -value, value) * IF(_sent = 2, 2, 1)"
_COST = f"CASE WHEN event_id % 79 <> 2 THEN {_SIGNED} END"
_TEXT = "date_format({when}, \"yyyy-MM-dd'T'HH:mm:ss.SSSSSS\")"
_WHEN = ("ts", "ts + INTERVAL 330 MINUTES")
_OFFSET = ("Z", "+05:30")
_OWN = ([f"{_COST} AS spend"], [f"{_COST} AS media_cost", "value / 500 AS viewability"])


def _feed(events: DataFrame, version: int, resends: bool, extra: Sequence[str]) -> DataFrame:
    text = _TEXT.format(when=_WHEN[version])
    return (
        events.where(f"event_id % 2 = {version}")
        .selectExpr("*", f"explode({_ALL_SENT if resends else _FIRST}) AS _sent")
        .selectExpr(
            "event_id",
            f"""CASE WHEN event_id % 97 = 5 THEN 'N/A'
                     WHEN event_id % 89 <> 3 THEN concat({text}, '{_OFFSET[version]}') END AS event_time""",
            "IF(_sent = 2, ts + INTERVAL 1 HOUR, ts) AS ingest_time",
            "user_id AS advertiser_id",
            "CASE WHEN event_id % 83 <> 7 THEN IF(user_id % 3 = 0, 'INR', 'USD') END AS currency",
            *_OWN[version],
            *extra,
        )
    )


def given_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def vendor_feeds(spark: SparkSession, sf_dir: str, resends: bool = True, extra: Sequence[str] = ()) -> Feeds:
    """The version-1 (``Z`` times, ``spend``) and version-2 (``+05:30`` times, ``media_cost``) feeds.

    ``extra`` names columns of ``events`` to send along that no schema declares.
    """
    events = given_events(spark, sf_dir)
    return Feeds(_feed(events, 0, resends, extra), _feed(events, 1, resends, extra))


def all_advertisers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole dimension table under the names used here."""
    customers = spark.read.schema(CUSTOMER).parquet(f"{sf_dir}/customer.parquet")
    return customers.selectExpr("c_custkey AS advertiser_id", "c_name AS advertiser_name")


def advertisers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension, with some advertisers missing and some present without a name."""
    customers = spark.read.schema(CUSTOMER).parquet(f"{sf_dir}/customer.parquet")
    return customers.where("c_custkey % 10 <> 9").selectExpr(
        "c_custkey AS advertiser_id", "CASE WHEN c_custkey % 11 <> 5 THEN c_name END AS advertiser_name"
    )


def inr_rates(spark: SparkSession, days: int = 30, every: int = 3) -> DataFrame:
    """INR per USD on every third day of January 2024, so that most days need the as-of rate."""
    return spark.range(days // every).selectExpr(
        "'INR' AS currency",
        f"date_add(DATE '2024-01-01', CAST(id * {every} AS INT)) AS rate_date",
        f"80 + (1 + id * {every}) / 10 AS rate",
    )
