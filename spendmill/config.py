"""Settings shared by every layer, and the few session facts the results depend on."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# They must equal what existing users of the tables expect.
FIXED_USD_RATES = {"INR": 1 / 83.00, "USD": 1.0}
COST_ALIASES = {"cost_raw": ("spend", "media_cost")}
VERSION_MARKERS = {"v2": ("media_cost", "viewability")}
UNKNOWN_NAME = "UNKNOWN"
RAW_EVENTS = "raw_events"
ADVERTISER_DIM = "advertiser_dim"
CLEAN_EVENTS = "events"
QUARANTINE_EVENTS = "quarantine_events"
DAILY_SPEND = "daily_advertiser_spend"


FILE_FORMATS = ("parquet", "orc")


@dataclass(frozen=True)
class MillConfig:
    """Where the layer tables live and how rows are normalised.

    ``fmt`` is a file format: layers are rewritten and dropped partition by partition, which transactional table
    formats refuse. For those, ``merge_statement`` renders the upsert.
    """

    fmt: str = "parquet"
    catalog: str | None = None
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    usd_rates: Mapping[str, float] = field(default_factory=lambda: dict(FIXED_USD_RATES))
    cost_aliases: Mapping[str, Sequence[str]] = field(default_factory=lambda: dict(COST_ALIASES))
    strict_offset: bool = False
    key: str = "event_id"
    order: str = "ingest_time"
    tie_breakers: Sequence[str] = ("cost_raw", "currency", "advertiser_id", "event_time_utc")
    key_buckets: int | None = None  # keep an index of the clean events' keys, in so many buckets
    load_log: str | None = None  # folder of the load log; by default in the location of the raw layer's namespace

    def __post_init__(self) -> None:
        if self.fmt not in FILE_FORMATS:
            raise ValueError(f"fmt must be one of {FILE_FORMATS}, not {self.fmt!r}")

    def table(self, layer: str, name: str) -> str:
        parts = [self.catalog, getattr(self, layer), name]
        return ".".join(p for p in parts if p)


def build_session(app: str = "spendmill", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the settings the operators rely on; a cluster may override any of them.

    Adaptive execution sizes the shuffle partitions, splits skewed join partitions and picks a
    broadcast join only for a side whose size was measured to be under the threshold.
    """
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        # Recording the Python call site of every column expression costs more than planning.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def pin_utc(spark: SparkSession) -> None:
    """Calendar days are UTC days: make the session say so."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")


def assert_utc(spark: SparkSession) -> None:
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "GMT", "Z", "+00:00"):
        raise ValueError(f"session time zone is {zone!r}; event dates need UTC")


def checkpoint_root(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for checkpoints: the cluster's own setting, else ``fallback``."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not fallback:
        raise ValueError("spark.checkpoint.dir is not set and no checkpoint folder was given")
    return fallback.rstrip("/")
