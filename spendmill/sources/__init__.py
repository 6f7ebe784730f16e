from .readers import clean_events, load_drifting, load_events
from .schemas import ADVERTISERS, EVENTS_ANY, EVENTS_V1, EVENTS_V2
from .tables import LayerTables
from .vendor import advertisers, inr_rates, vendor_feeds

__all__ = [
    "ADVERTISERS",
    "EVENTS_ANY",
    "EVENTS_V1",
    "EVENTS_V2",
    "LayerTables",
    "advertisers",
    "clean_events",
    "inr_rates",
    "load_drifting",
    "load_events",
    "vendor_feeds",
]
