from .columns import (
    calendar_day,
    first_populated,
    in_usd,
    parse_instant,
    pct_change,
    reason_of,
    unix_hours_between,
    version_of,
)

__all__ = [
    "calendar_day",
    "first_populated",
    "in_usd",
    "parse_instant",
    "pct_change",
    "reason_of",
    "unix_hours_between",
    "version_of",
]
