"""The layers as one lazy plan over the given tables, each step built from the public operators."""

from __future__ import annotations

import datetime
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import MillConfig, pin_utc
from ..operators import (
    daily_spend,
    dedup_latest,
    label_quarantine,
    normalise,
    split,
    tag_provenance,
    to_usd,
    union_versions,
)
from ..sources.interim import settle
from ..sources.vendor import advertisers, all_advertisers, vendor_feeds

# File names recorded as provenance.
SOURCE_NAMES = {"v1": "events_v1.csv", "v2": "events_v2.csv"}


def build_bronze(v1: DataFrame, v2: DataFrame, ingested_at=None) -> DataFrame:
    feeds = zip(("v1", "v2"), (v1, v2))
    return union_versions(*(tag_provenance(df, v, SOURCE_NAMES[v], ingested_at) for v, df in feeds))


def build_labelled(bronze: DataFrame, config: MillConfig) -> DataFrame:
    return label_quarantine(normalise(bronze, config.cost_aliases, config.strict_offset))


def build_silver(good: DataFrame, config: MillConfig) -> DataFrame:
    return dedup_latest(good, config.key, config.order, config.tie_breakers)


class Layers:
    """Lazily built frames for one folder of tables; nothing runs until a frame is used."""

    def __init__(self, spark: SparkSession, sf_dir: str, config: MillConfig | None = None):
        pin_utc(spark)
        self.spark, self.sf_dir, self.config = spark, sf_dir, config or MillConfig()

    @cached_property
    def feeds(self):
        return vendor_feeds(self.spark, self.sf_dir)

    @cached_property
    def first_delivery(self) -> DataFrame:
        """Both feeds without re-sent rows."""
        return union_versions(*vendor_feeds(self.spark, self.sf_dir, resends=False))

    @cached_property
    def sent(self) -> DataFrame:
        return union_versions(*self.feeds)

    @cached_property
    def bronze(self) -> DataFrame:
        at = F.lit("2024-02-01T00:00:00Z").cast("timestamp")
        return build_bronze(*self.feeds, ingested_at=at)

    @cached_property
    def troubled(self) -> DataFrame:
        """The raw layer with rows that lost their key and with a currency that no rate is known for."""
        return self.bronze.withColumns(
            {
                "event_id": F.expr("IF(event_id % 101 = 9, NULL, event_id)"),
                "currency": F.expr("IF(event_id % 103 = 4 AND currency IS NOT NULL, 'EUR', currency)"),
            }
        )

    @cached_property
    def normal(self) -> DataFrame:
        return normalise(self.bronze, self.config.cost_aliases, self.config.strict_offset)

    @cached_property
    def labelled(self) -> DataFrame:
        return label_quarantine(self.normal)

    @property
    def good(self) -> DataFrame:
        return split(self.labelled)[0]

    @property
    def quarantine(self) -> DataFrame:
        return split(self.labelled)[1]

    @cached_property
    def silver(self) -> DataFrame:
        return build_silver(self.good, self.config)

    @cached_property
    def silver_usd(self) -> DataFrame:
        return to_usd(self.silver, self.config.usd_rates)

    @cached_property
    def dim(self) -> DataFrame:
        return advertisers(self.spark, self.sf_dir)

    @cached_property
    def dim_deliveries(self) -> DataFrame:
        """The dimension as delivered twice in part, so that keys repeat."""
        return self.dim.unionByName(self.dim.where("advertiser_id % 13 = 1"))

    @cached_property
    def all_advertisers(self) -> DataFrame:
        return all_advertisers(self.spark, self.sf_dir)

    @cached_property
    def spend_events(self) -> DataFrame:
        """Clean events with only what the daily sums read.

        The kept columns are the ordering and the tie-breakers, which decide the survivor's values in
        all of them, so leaving the others out before the shuffle changes nothing.
        """
        c = self.config
        return to_usd(build_silver(self.good.select(c.key, c.order, *c.tie_breakers), c), c.usd_rates)

    @cached_property
    def gold(self) -> DataFrame:
        return daily_spend(self.spend_events, self.dim)

    @cached_property
    def before_corrections(self) -> DataFrame:
        """Clean rows of the first delivery: one row per event, stored as the target of corrections."""
        return settle(split(label_quarantine(normalise(self.first_delivery)))[0])

    @cached_property
    def corrections(self) -> DataFrame:
        """A late batch for two days: corrections (some older, equally old or newer; some move to the next
        day) and events not seen before."""
        known = self.before_corrections
        unseen = known.where("event_id % 7 = 1").withColumns({"event_id": F.col("event_id") + 1_000_000_007})
        late = known.unionByName(unseen).where("event_id % 3 < 2 OR event_id > 1000000000")
        days = [datetime.date(2024, 1, 10), datetime.date(2024, 1, 11)]
        return late.where(F.to_date("event_time_utc").isin(days)).withColumns(
            {
                "ingest_time": F.expr("ingest_time + INTERVAL 1 HOUR * (event_id % 3 - 1)"),
                "cost_raw": F.expr("cost_raw * 2"),
                "event_time_utc": F.expr("event_time_utc + INTERVAL 1 DAY * IF(event_id % 5 = 0, 1, 0)"),
            }
        )

    @cached_property
    def amendments(self) -> DataFrame:
        """A late batch for a quarter of the advertisers: newer versions of known events, many of which move by two days
        (so that days lose their last event), and events not seen before."""
        known = self.before_corrections.where("advertiser_id % 4 = 0")
        unseen = known.where("event_id % 29 = 1").withColumns({"event_id": F.col("event_id") + 1_000_000_007})
        late = known.where("event_id % 4 IN (1, 2)").unionByName(unseen)
        return late.withColumns(
            {
                "ingest_time": F.expr("ingest_time + INTERVAL 1 HOUR"),
                "cost_raw": F.expr("cost_raw * 3"),
                "event_time_utc": F.expr("event_time_utc + INTERVAL 1 DAY * IF(event_id % 3 = 0, 2, 0)"),
            }
        )
