"""Currency conversion: at fixed rates, or at the rate in force on the day of the event."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import FIXED_USD_RATES
from ..functions import calendar_day, in_usd


def to_usd(
    df: DataFrame, rates: Mapping[str, float] = FIXED_USD_RATES, amount: str = "cost_raw", into: str = "cost_usd"
) -> DataFrame:
    """Convert with fixed rates (USD per unit); a currency without a rate gives NULL, not zero."""
    return df.withColumns({into: in_usd(amount, "currency", rates)})


def fill_daily(rates: DataFrame) -> DataFrame:
    """(currency, rate_date, rate) with a row for every day from a currency's first rate to the
    table's last day, each holding the latest rate at or before that day.

    Its size is bounded by currencies x calendar days of the rates table, whatever the facts hold.
    """
    once = rates.groupBy("currency", "rate_date").agg(F.max("rate").alias("rate"))
    last_day = rates.agg(F.max("rate_date").alias("last_day")).scalar()
    following = F.lead("rate_date").over(Window.partitionBy("currency").orderBy("rate_date"))
    spans = once.select("currency", "rate_date", "rate", F.coalesce(F.date_sub(following, 1), last_day).alias("until"))
    days = F.explode(F.sequence("rate_date", "until"))
    return spans.select("currency", days.alias("rate_date"), "rate")


def to_usd_daily(
    df: DataFrame,
    rates: DataFrame,
    amount: str = "cost_raw",
    instant: str = "event_time_utc",
    base: str = "USD",
    into: str = "cost_usd",
) -> DataFrame:
    """Convert with a rates table ``(currency, rate_date, rate)``, ``rate`` = units per ``base``.

    The as-of lookup (latest rate at or before the event's day) becomes an equi-join: the rates are
    filled to one row per day and later events are matched on the table's last day. The facts are
    read once and are only shuffled if the rates outgrow the broadcast threshold.
    """
    last_day = rates.agg(F.max("rate_date").alias("last_day")).scalar()
    day = calendar_day(instant)
    lookup = fill_daily(rates).select(
        F.col("currency").alias("_rate_currency"), F.col("rate_date").alias("_rate_day"), F.col("rate").alias("_rate")
    )
    keyed = df.withColumns({"_day": F.when(day.isNotNull(), F.least(day, last_day))})
    matched = keyed.join(
        lookup, (F.col("currency") == F.col("_rate_currency")) & (F.col("_day") == F.col("_rate_day")), "left"
    )
    converted = F.when(F.col("currency") == base, F.col(amount)).otherwise(F.col(amount) / F.col("_rate"))
    return matched.select(*df.columns, converted.alias(into))
