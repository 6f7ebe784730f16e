"""Daily spend tables from drifting vendor event files, as DataFrame-to-DataFrame operators."""

from .config import MillConfig, assert_utc, build_session, pin_utc
from .operators import *  # noqa: F401,F403
from .operators import __all__ as _operators
from .sources import EVENTS_ANY, EVENTS_V1, EVENTS_V2, LayerTables, clean_events, load_drifting, load_events

__all__ = [
    *_operators,
    "EVENTS_ANY",
    "EVENTS_V1",
    "EVENTS_V2",
    "LayerTables",
    "MillConfig",
    "assert_utc",
    "build_session",
    "clean_events",
    "load_drifting",
    "load_events",
    "pin_utc",
]
