"""Column expressions. All are built-in Spark functions, so they stay inside generated code."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: an ISO-8601 date and time that names its own offset (Z or +hh:mm / -hh:mm).
ISO_WITH_OFFSET = r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?(Z|[+-]\d{2}:?\d{2})$"


def first_populated(available: Iterable[str], names: Sequence[str]) -> Column:
    """The first non-null of ``names``, ignoring names the frame does not have."""
    have = set(available)
    present = [F.col(n) for n in names if n in have]
    if not present:
        raise ValueError(f"none of {list(names)} is a column")
    return F.coalesce(*present) if len(present) > 1 else present[0]


def parse_instant(text: Column | str, strict_offset: bool = False, on_error: str = "null") -> Column:
    """An event-time string as an instant.

    An offset inside the string is honoured. ``on_error='null'`` yields NULL for text that is no
    timestamp and ``'raise'`` fails the job. ``strict_offset`` also rejects strings that parse but
    leave the offset (or the date) to the session.
    """
    text = F.col(text) if isinstance(text, str) else text
    if on_error == "raise":
        parsed = F.to_timestamp(text)
    elif on_error == "null":
        parsed = F.try_to_timestamp(text)
    else:
        raise ValueError(f"on_error must be 'null' or 'raise', not {on_error!r}")
    return F.when(text.rlike(ISO_WITH_OFFSET), parsed) if strict_offset else parsed


def calendar_day(instant: Column | str) -> Column:
    return F.to_date(instant)


def in_usd(amount: Column | str, currency: Column | str, rates: Mapping[str, float]) -> Column:
    """``amount`` times its currency's rate; NULL where the currency has no rate."""
    amount = F.col(amount) if isinstance(amount, str) else amount
    currency = F.col(currency) if isinstance(currency, str) else currency
    per_currency = [F.when(currency == code, amount * F.lit(float(rate))) for code, rate in rates.items()]
    return F.coalesce(*per_currency)


def reason_of(tests: Sequence[tuple[str, str]]) -> Column:
    """The name of the first (name, SQL predicate) that holds, else NULL.

    A predicate that is NULL counts as not holding, so labelling is total: each row has one
    reason or none, and splitting on the reason neither loses nor repeats a row.
    """
    return F.coalesce(*(F.when(F.expr(test), F.lit(name)) for name, test in tests))


def version_of(available: Iterable[str], markers: Mapping[str, Sequence[str]], default: str) -> Column:
    """Schema version told from which marker columns hold a value, newest listed version first."""
    have = set(available)
    picks = []
    for version, columns in markers.items():
        present = [F.col(c) for c in columns if c in have]
        if present:
            picks.append(F.when(F.coalesce(*(c.cast("string") for c in present)).isNotNull(), F.lit(version)))
    return F.coalesce(*picks, F.lit(default))


def pct_change(now: Column, before: Column, digits: int = 2) -> Column:
    """Percent change, NULL when there is no earlier value or it is zero."""
    return F.round((now - before) / F.nullif(before, F.lit(0.0)) * 100, digits)


def unix_hours_between(earlier: Column, later: Column) -> Column:
    """Hours from one instant to a later one, with sub-second precision."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(3_600_000_000.0)
