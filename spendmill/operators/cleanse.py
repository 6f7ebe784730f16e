"""Normalise rows and set the irreparable ones aside with a reason."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import COST_ALIASES
from ..functions import first_populated, parse_instant, reason_of


class Rejection(NamedTuple):
    """Why a row is set aside: a reason and the SQL predicate that triggers it."""

    reason: str
    test: str


# Reason names and their priority. The time test looks at the *parsed* value, so text
# such as "N/A" is caught; the rule on cost makes the split total, and rows
# without a key are set aside because they would count as copies of one event.
DEFAULT_REJECTIONS = (
    Rejection("malformed_timestamp", "event_time_utc IS NULL"),
    Rejection("negative_cost", "cost_raw < 0"),
    Rejection("missing_currency", "currency IS NULL"),
    Rejection("missing_cost", "cost_raw IS NULL"),
    Rejection("missing_event_id", "event_id IS NULL"),
)


def unify_columns(df: DataFrame, aliases: Mapping[str, Sequence[str]] = COST_ALIASES) -> DataFrame:
    """Give renamed metrics one canonical column each: ``{canonical: names in order of preference}``."""
    return df.withColumns({name: first_populated(df.columns, olds) for name, olds in aliases.items()})


def parse_event_time(
    df: DataFrame,
    col: str = "event_time",
    into: str = "event_time_utc",
    strict_offset: bool = False,
    on_error: str = "null",
) -> DataFrame:
    return df.withColumns({into: parse_instant(col, strict_offset, on_error)})


def normalise(df: DataFrame, aliases: Mapping[str, Sequence[str]] = COST_ALIASES, strict_offset: bool = False) -> DataFrame:
    return parse_event_time(unify_columns(df, aliases), strict_offset=strict_offset)


def label_quarantine(df: DataFrame, rules: Sequence[Rejection] = DEFAULT_REJECTIONS) -> DataFrame:
    """Add ``quarantine_reason``: the first rule that rejects the row, NULL for a good row."""
    return df.withColumns({"quarantine_reason": reason_of(rules)})


def split(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the reason column, quarantined rows with it); disjoint and complete."""
    reason = F.col("quarantine_reason")
    return labelled.where(reason.isNull()).drop("quarantine_reason"), labelled.where(reason.isNotNull())


def with_offset(df: DataFrame, offset: str = "+05:30", col: str = "event_time") -> DataFrame:
    """Rows whose time string carries ``offset``, for checking the conversion by eye."""
    return df.where(F.contains(F.col(col), F.lit(offset)))
