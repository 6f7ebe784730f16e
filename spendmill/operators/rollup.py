"""Daily spend per advertiser, in full or only for the days that changed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import calendar_day
from .dimension import join_dimension

EXACT_AMOUNT = "decimal(28,10)"
# The published columns of the daily table.
GOLD_COLUMNS = (
    "event_date",
    "advertiser_id",
    "advertiser_name",
    "is_unmapped_advertiser",
    "total_spend_usd",
    "event_count",
)


def daily_spend(events: DataFrame, dim: DataFrame, on_duplicate: str = "error") -> DataFrame:
    """Spend and event count per UTC day and advertiser; ``events`` carries ``cost_usd``.

    The name and the flag depend on the advertiser alone, so events are summed first (partial sums
    on the map side) and only the per-day rows meet the dimension. No event row is joined, and a
    heavy advertiser reaches the join as one row per day. Spend is summed as a decimal, which is the same
    in whatever order the tasks finish; an amount too large for it is an error.
    """
    spend = F.sum(F.col("cost_usd").cast(EXACT_AMOUNT)).cast("double")
    per_day = events.groupBy(calendar_day("event_time_utc").alias("event_date"), "advertiser_id").agg(
        spend.alias("total_spend_usd"), F.count("event_id").alias("event_count")
    )
    return join_dimension(per_day, dim, on_duplicate=on_duplicate).select(*GOLD_COLUMNS)


def on_days(df: DataFrame, days: DataFrame, day_col: str = "event_date", keep: bool = True) -> DataFrame:
    """Rows whose day is (``keep``) or is not in ``days``.

    ``days`` holds distinct calendar days: at most 3.65 million four-byte values even for every date
    Spark can represent, so broadcasting it is bounded by the calendar and not by the data.
    """
    listed = F.broadcast(days.select(F.col(days.columns[0]).alias("_day")).distinct())
    return df.join(listed, F.col(day_col) == F.col("_day"), "left_semi" if keep else "left_anti")


def refresh_days(gold: DataFrame, events: DataFrame, dim: DataFrame, days: DataFrame, on_duplicate: str = "error") -> DataFrame:
    """``gold`` with the rows of ``days`` recomputed from ``events`` and all others kept as they are."""
    dated = events.withColumns({"_event_date": calendar_day("event_time_utc")})
    fresh = daily_spend(on_days(dated, days, "_event_date").drop("_event_date"), dim, on_duplicate)
    return on_days(gold, days, keep=False).select(*GOLD_COLUMNS).unionByName(fresh)
