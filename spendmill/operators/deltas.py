"""Keep the daily table and the questions over it current from changes alone.

An upsert yields signed rows: what each replaced event had counted for, with -1, and what the winner counts for, with +1.
Their sums per day and advertiser are added to stored sums, so no event of a touched day is read again. The days whose
sums changed then say which rolling frames and which streaks are out of date; everything else stays as it is stored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import calendar_day
from .dimension import join_dimension
from .rollup import EXACT_AMOUNT, GOLD_COLUMNS
from .trends import rolling_spend

DAY_KEY = ("event_date", "advertiser_id")
STREAK = ("advertiser_id", "streak_length", "streak_start", "streak_end")
TREND_KEY = ("advertiser_id", "event_date")


def signed_events(events: DataFrame, sign: int) -> DataFrame:
    """What ``events`` (with ``cost_usd``) count for: (event_date, advertiser_id, spend, converted, event_count)."""
    spend = F.coalesce(F.col("cost_usd").cast(EXACT_AMOUNT), F.lit(0).cast(EXACT_AMOUNT))
    return events.select(
        calendar_day("event_time_utc").alias("event_date"),
        "advertiser_id",
        (spend * sign).cast(EXACT_AMOUNT).alias("spend"),
        F.when(F.col("cost_usd").isNotNull(), sign).otherwise(0).cast("long").alias("converted"),
        F.when(F.col("event_id").isNotNull(), sign).otherwise(0).cast("long").alias("event_count"),
    )


def _summed(rows: DataFrame) -> DataFrame:
    totals = (F.sum(c).alias(c) for c in ("converted", "event_count"))
    return rows.groupBy(*DAY_KEY).agg(F.sum("spend").cast(EXACT_AMOUNT).alias("spend"), *totals)


def spend_state(events: DataFrame) -> DataFrame:
    """Mergeable sums per day and advertiser: exact spend, number of converted amounts, number of events."""
    return _summed(signed_events(events, 1))


def replaced_rows(target: DataFrame, winners: DataFrame, key: str = "event_id") -> DataFrame:
    """The rows of ``target`` that ``winners`` take the place of; Spark reads just the columns that are used of them."""
    keys = winners.select(F.col(key).alias("_won"))
    return target.join(keys, F.col(key).eqNullSafe(F.col("_won")), "left_semi")


def state_changes(replaced: DataFrame, winners: DataFrame) -> DataFrame:
    """Signed sums per day and advertiser of an upsert: ``replaced`` rows leave, ``winners`` come (both with ``cost_usd``)."""
    return _summed(signed_events(replaced, -1).unionByName(signed_events(winners, 1)))


def merge_state(state: DataFrame, changes: DataFrame) -> DataFrame:
    """``state`` after ``changes``; only days that ``changes`` names are summed, a day without events leaves."""
    days = F.broadcast(changes.select(F.col("event_date").alias("_day")).distinct())  # bounded by the calendar
    same = F.col("event_date").eqNullSafe(F.col("_day"))
    merged = _summed(state.join(days, same, "left_semi").unionByName(changes)).where("event_count <> 0 OR converted <> 0")
    return state.join(days, same, "left_anti").unionByName(merged)


def spend_of_state(state: DataFrame, dim: DataFrame, on_duplicate: str = "error") -> DataFrame:
    """The daily table that ``state`` stands for: equal to ``daily_spend`` of the events behind it."""
    spend = F.when(F.col("converted") > 0, F.col("spend").cast("double")).alias("total_spend_usd")
    rows = state.select(*DAY_KEY, spend, "event_count")
    return join_dimension(rows, dim, on_duplicate=on_duplicate).select(*GOLD_COLUMNS)


# -- rolling frames ---------------------------------------------------------------------------


def stale_frames(gold: DataFrame, changed: DataFrame, days: int = 7, calendar: bool = False) -> DataFrame:
    """The rows of affected advertisers in ``gold`` that a refresh must look at, with ``_stale``: to be computed again.

    ``changed`` names (advertiser_id, event_date) whose daily row changed, appeared or vanished. Such a day makes the
    next ``days`` rows (``calendar``: the next ``days`` calendar days) out of date; those need the rows before them as
    context, which come with ``_stale`` false. Other advertisers are not read further than their id.
    """
    who = changed.select(F.col("advertiser_id").alias("_who")).distinct()
    mine = gold.join(who, F.col("advertiser_id").eqNullSafe(F.col("_who")), "left_semi")
    marks = changed.select(*TREND_KEY, F.lit(True).alias("_mark")).distinct()
    line = mine.withColumn("_real", F.lit(1)).unionByName(marks, allowMissingColumns=True)
    # A mark sorts before the row of its day, so it sees the rows strictly before it.
    by_day = Window.partitionBy("advertiser_id").orderBy("event_date", F.col("_mark").desc_nulls_last())
    if calendar:
        line = line.withColumn("_last", F.max(F.when(F.col("_mark"), F.col("event_date"))).over(by_day))
        stale = F.date_diff("event_date", "_last") < max(days, 2)
    else:
        line = line.withColumn("_at", F.coalesce(F.sum("_real").over(by_day), F.lit(0)))
        line = line.withColumn("_last", F.max(F.when(F.col("_mark"), F.col("_at"))).over(by_day))
        stale = F.col("_at") - F.col("_last") <= max(days, 2)
    rows = line.withColumn("_stale", F.coalesce(stale, F.lit(False))).where("_real = 1").drop("_mark", "_real", "_at", "_last")
    if calendar:
        ahead = Window.partitionBy("advertiser_id").orderBy(F.unix_date("event_date")).rangeBetween(0, max(days - 1, 1))
    else:
        ahead = Window.partitionBy("advertiser_id").orderBy("event_date").rowsBetween(0, max(days - 1, 1))
    return rows.withColumn("_needed", F.max("_stale").over(ahead)).where("_needed").drop("_needed")


def refresh_rolling(trend: DataFrame, gold: DataFrame, changed: DataFrame, days: int = 7, calendar: bool = False) -> DataFrame:
    """``trend`` (``rolling_spend`` of the daily table before) made equal to ``rolling_spend(gold)`` of the one after.

    Only rows whose frame holds a ``changed`` day are computed, from their own frames; vanished days leave.
    """
    looked_at = stale_frames(gold, changed, days, calendar)
    stale = looked_at.where("_stale").select(*TREND_KEY)
    fresh = rolling_spend(looked_at.drop("_stale"), days, calendar)
    fresh = fresh.join(stale.toDF("_sa", "_sd"), _equal(TREND_KEY, ("_sa", "_sd")), "left_semi")
    gone = stale.unionByName(changed.select(*TREND_KEY)).distinct()
    return trend.join(gone.toDF("_ga", "_gd"), _equal(TREND_KEY, ("_ga", "_gd")), "left_anti").unionByName(fresh)


def _equal(left: Sequence[str], right: Sequence[str]) -> Column:
    first, second = (F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right, strict=True))
    return first & second


# -- streaks ----------------------------------------------------------------------------------


def changed_activity(before: DataFrame, after: DataFrame, changed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(appeared, vanished): the ``changed`` days that became, and that ceased to be, days with events.

    ``before`` and ``after`` are daily tables or states; only the changed days are looked up in them.
    """
    days = changed.select(*TREND_KEY).where("event_date IS NOT NULL").distinct()

    def active(table: DataFrame) -> DataFrame:
        return table.where("event_count >= 1").select(*TREND_KEY).toDF("_a", "_d")

    def without(rows: DataFrame, table: DataFrame) -> DataFrame:
        return rows.join(active(table), _equal(TREND_KEY, ("_a", "_d")), "left_anti")

    def within(rows: DataFrame, table: DataFrame) -> DataFrame:
        return rows.join(active(table), _equal(TREND_KEY, ("_a", "_d")), "left_semi")

    return within(without(days, before), after), without(within(days, before), after)


def refresh_streaks(streaks: DataFrame, appeared: DataFrame, vanished: DataFrame) -> DataFrame:
    """Stored ``streaks`` after days (advertiser_id, event_date) appeared and vanished, by cutting and joining intervals.

    Only streaks that hold or touch a changed day are worked on: they are cut at vanished days, then joined with each
    other and with appeared days where they meet. No day of a streak is listed, so long ones cost as much as short ones.
    """
    changes = appeared.unionByName(vanished).select(F.col("advertiser_id").alias("_a"), F.col("event_date").alias("_d")).distinct()
    touches = F.col("advertiser_id").eqNullSafe(F.col("_a")) & F.col("_d").between(F.date_sub("streak_start", 1), F.date_add("streak_end", 1))
    hit = streaks.join(changes, touches, "left_semi")
    cuts = hit.join(
        vanished.select(F.col("advertiser_id").alias("_a"), F.col("event_date").alias("_d")).distinct(),
        F.col("advertiser_id").eqNullSafe(F.col("_a")) & F.col("_d").between(F.col("streak_start"), F.col("streak_end")),
    ).select("advertiser_id", "streak_start", F.col("_d").alias("_cut"))
    ends = hit.select("advertiser_id", "streak_start", F.date_add("streak_end", 1).alias("_cut"))
    in_streak = Window.partitionBy("advertiser_id", "streak_start").orderBy("_cut")
    start = F.coalesce(F.date_add(F.lag("_cut").over(in_streak), 1), F.col("streak_start"))
    pieces = cuts.unionByName(ends).select("advertiser_id", start.alias("_from"), F.date_sub("_cut", 1).alias("_to")).where("_from <= _to")
    new = appeared.select("advertiser_id", F.col("event_date").alias("_from"), F.col("event_date").alias("_to")).distinct()
    line = Window.partitionBy("advertiser_id").orderBy("_from")
    apart = F.coalesce(F.date_diff("_from", F.lag("_to").over(line)) > 1, F.lit(True)).cast("int")
    joined = pieces.unionByName(new).withColumn("_new", apart).withColumn("_run", F.sum("_new").over(line))
    runs = joined.groupBy("advertiser_id", "_run").agg(F.min("_from").alias("streak_start"), F.max("_to").alias("streak_end"))
    length = (F.date_diff("streak_end", "streak_start") + 1).cast("long").alias("streak_length")
    return streaks.join(changes, touches, "left_anti").select(*STREAK).unionByName(runs.select("advertiser_id", length, "streak_start", "streak_end"))
