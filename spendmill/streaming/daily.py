"""Whole days out of a stream: events wait in Spark's state until their UTC day is closed, late ones are not lost.

``start_incremental`` rewrites a day for every micro-batch that touches it. Here a day's events are held by a windowed
aggregation with a watermark and reach the layers together once the day is closed, so a day is written once, and again
only for what comes late. A stateful operator drops rows that are behind the watermark; those rows are told apart
from the same arrivals and go to the upsert at once, as do rows that the quarantine takes.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..config import MillConfig, assert_utc, checkpoint_root
from ..operators import Rule, union_versions
from ..plans.incremental import IncrementalLoad
from ..plans.layers import build_labelled
from .ingest import VendorFolder, folder_stream, ingest


def held_until_closed(rows: DataFrame, config: MillConfig, delay: str) -> DataFrame:
    """Arrivals (``_waited`` false) and, once their day is closed, good rows again (``_waited`` true) with ``_copies``.

    A day is closed when the newest event time seen, less ``delay``, has passed its end. The state holds each distinct
    row of the open days once, with its number of copies; no key of it gathers rows that differ.
    """
    names = rows.columns
    labelled = build_labelled(rows, config)
    good = F.col("quarantine_reason").isNull()
    arrivals = labelled.select(*names, F.lit(1).cast("long").alias("_copies"), F.lit(False).alias("_waited"))
    day = F.window("event_time_utc", "1 day")
    open_days = labelled.where(good).withWatermark("event_time_utc", delay).groupBy(day, *names)
    closed = open_days.agg(F.count("*").alias("_copies")).select(*names, "_copies", F.lit(True).alias("_waited"))
    return arrivals.unionByName(closed)


def day_end(instant: str) -> Column:
    return F.date_trunc("day", instant) + F.expr("INTERVAL 1 DAY")


class DayGate:
    """Picks what a micro-batch of ``held_until_closed`` applies. ``folder`` keeps the newest event time of each batch.

    It is read for the batches *before* the one at hand, which is what the engine's watermark knows then; a batch that
    is run again therefore takes the same decisions.
    """

    def __init__(self, spark: SparkSession, config: MillConfig, delay: str, folder: str) -> None:
        self.spark, self.config, self.delay, self.folder = spark, config, delay, folder

    def newest_before(self, batch_id: int):
        """The newest good event time of all batches before ``batch_id``; one row per batch is read."""
        if batch_id == 0:
            return None
        marks = self.spark.read.schema("newest timestamp, batch long").parquet(f"{self.folder}/newest")
        return marks.where(F.col("batch") < batch_id).agg(F.max("newest")).first()[0]

    def __call__(self, batch: DataFrame, batch_id: int) -> DataFrame | None:
        # Stored once: a second look at a lazy batch would run the stateful part again.
        batch.write.mode("overwrite").parquet(f"{self.folder}/batch")
        rows = self.spark.read.schema(batch.schema).parquet(f"{self.folder}/batch")
        names = [c for c in batch.columns if c not in ("_copies", "_waited")]
        seen = self.newest_before(batch_id)
        arrived = build_labelled(rows.where("NOT _waited"), self.config)
        good = F.col("quarantine_reason").isNull()
        newest = arrived.where(good).agg(F.max("event_time_utc").alias("newest"))
        newest.coalesce(1).write.mode("overwrite").parquet(f"{self.folder}/newest/batch={batch_id}")

        closed = rows.where("_waited")
        late = arrived.where(good & (day_end("event_time_utc") <= F.lit(seen) - F.expr(f"INTERVAL {self.delay}"))) if seen else arrived.where("false")
        # A day that closes with this very batch has taken its rows in: what waited is not late as well.
        taken = closed.select(*(F.col(c).alias(f"_t{k}") for k, c in enumerate(names)))
        same = [F.col(c).eqNullSafe(F.col(f"_t{k}")) for k, c in enumerate(names)]
        late = late.select(*names).join(taken, same, "left_anti")
        each = closed.select(*names, F.explode(F.sequence(F.lit(1).cast("long"), "_copies")).alias("_copy")).drop("_copy")
        out = each.unionByName(late).unionByName(arrived.where(~good).select(*names))
        return None if out.isEmpty() else out


def start_daily(
    spark: SparkSession,
    folders: Sequence[VendorFolder],
    config: MillConfig | None = None,
    name: str = "vendor_daily",
    checkpoint: str | None = None,
    every: str | None = None,
    rules: Sequence[Rule | Mapping] = (),
    delay: str = "1 day",
) -> StreamingQuery:
    """Like ``start_incremental``, but a day reaches the layers as a whole, ``delay`` after its end.

    ``delay`` is an interval such as ``'1 day'`` or ``'6 hours'``, counted in event time. Rows that come later still are
    upserted with the micro-batch that brings them. Days that are not closed stay in the stream's state: a cluster keeps it off
    the heap with Spark's RocksDB state store.
    """
    assert_utc(spark)
    load = IncrementalLoad(spark, config, rules)
    rows = union_versions(*(folder_stream(spark, f) for f in folders))
    gate = DayGate(spark, load.config, delay, f"{checkpoint_root(spark, checkpoint)}/{name}-days")
    return ingest(spark, held_until_closed(rows, load.config, delay), gate, load, name, checkpoint, every)
