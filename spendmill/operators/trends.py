"""Questions over the daily table. A window holds one advertiser's days, so its size is bounded by
the calendar and not by the number of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import pct_change


def rolling_spend(gold: DataFrame, days: int = 7, calendar: bool = False) -> DataFrame:
    """Rolling average and percent change of daily spend per advertiser.

    By default the frame is the last ``days`` *rows* and the change is against the previous row.
    ``calendar=True`` takes the last ``days`` calendar days and compares only with the day before.
    """
    timeline = Window.partitionBy("advertiser_id").orderBy("event_date")
    spend, day = F.col("total_spend_usd"), F.col("event_date")
    before = F.lag("total_spend_usd").over(timeline)
    if calendar:
        by_day_number = Window.partitionBy("advertiser_id").orderBy(F.unix_date("event_date"))
        frame = by_day_number.rangeBetween(1 - days, 0)
        before = F.when(F.date_diff(day, F.lag("event_date").over(timeline)) == 1, before)
    else:
        frame = timeline.rowsBetween(1 - days, 0)
    return gold.select(
        "event_date",
        "advertiser_id",
        "advertiser_name",
        "total_spend_usd",
        F.avg("total_spend_usd").over(frame).alias(f"rolling_{days}day_avg_spend"),
        pct_change(spend, before).alias("pct_change_vs_prior_day"),
    )


def first_days(trend: DataFrame, advertiser: object, n: int = 10) -> DataFrame:
    """The earliest ``n`` days of one advertiser: a top-k report.

    The filter is on the window's partition key, so Spark moves it below the window.
    """
    return trend.where(F.col("advertiser_id") == F.lit(advertiser)).orderBy("event_date").limit(n)


def active_days(gold: DataFrame) -> DataFrame:
    """Distinct (advertiser, day) with at least one event."""
    busy = (F.col("event_count") >= 1) & F.col("event_date").isNotNull()
    return gold.where(busy).select("advertiser_id", "event_date").distinct()


def streaks(gold: DataFrame) -> DataFrame:
    """Every run of consecutive active days, one row each.

    Day minus position is the same for all days of a run. The runs group on a key that contains the
    window's partition key, so they need no further shuffle.
    """
    position = F.row_number().over(Window.partitionBy("advertiser_id").orderBy("event_date"))
    marked = active_days(gold).withColumns({"_run": F.date_sub("event_date", position)})
    return (
        marked.groupBy("advertiser_id", "_run")
        .agg(
            F.count(F.lit(1)).alias("streak_length"),
            F.min("event_date").alias("streak_start"),
            F.max("event_date").alias("streak_end"),
        )
        .drop("_run")
    )


def longest_streak(gold: DataFrame) -> DataFrame:
    """The longest run per advertiser, the earliest one on a tie.

    The best run is a maximum over (length, earlier start), not a second ranking window.
    """
    best = F.max_by(
        F.struct("streak_length", "streak_start", "streak_end"),
        F.struct("streak_length", (-F.unix_date("streak_start")).alias("earlier")),
    )
    return (
        streaks(gold)
        .groupBy("advertiser_id")
        .agg(best.alias("_best"))
        .select(
            "advertiser_id",
            F.col("_best.streak_length").alias("longest_streak_days"),
            F.col("_best.streak_start").alias("streak_start"),
            F.col("_best.streak_end").alias("streak_end"),
        )
    )
