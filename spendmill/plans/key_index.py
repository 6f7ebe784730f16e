"""An index of the clean events' keys, so that a late batch finds what it corrects without a scan of the clean events.

The index holds (key, order, day) of every version of an event that was ever current, partitioned by a bucket of the key
and by the load that brought it. A batch reads only the buckets its keys fall into, and of a key the newest entry counts,
so loads only ever add partitions and repeating one changes nothing. It changes with the commit of the load it belongs
to; a load that does not bring it along drops it, and the next one builds it again with one scan.
"""

from __future__ import annotations

from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.commits import Change

if TYPE_CHECKING:
    from ..sources.layers import StoredLayers

#: Beyond so many loads the entries of each bucket are put together, the newest of each key only.
LOADS_KEPT = 24
PARTITIONED_BY = "key_bucket,load"


class KeyIndex:
    def __init__(self, layers: StoredLayers):
        self.layers, self.tables, self.config = layers, layers.tables, layers.config
        self.buckets = layers.config.key_buckets

    def _bucket(self, key: str) -> Column:
        return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(self.buckets)).cast("int")

    def _newest(self, entries: DataFrame) -> DataFrame:
        newest = entries.groupBy("_key").agg(F.max(F.struct("_held", "_day")).alias("_newest"))
        return newest.select("_key", F.col("_newest._held").alias("_held"), F.col("_newest._day").alias("_day"))

    def make_ready(self) -> None:
        """Build the index where there is none, for other buckets, or put many loads' entries together, as a commit of its own."""
        tables, keys, c = self.tables, self.layers.keys, self.config
        if tables.exists(keys):
            # A full set of loads fills every bucket; partitions come from the catalog, no entry is read.
            entries = tables.read(keys)
            if tables.partitions(keys) <= LOADS_KEPT * self.buckets and dict(entries.dtypes).get(f"of_{self.buckets}") == "boolean":
                return
            rows = self._newest(entries)
        else:
            silver = tables.read(self.layers.silver)
            rows = silver.select(F.col(c.key).alias("_key"), F.col(c.order).alias("_held"), F.col("event_date").alias("_day"))
        staged = tables.stage(self._laid_out(rows, "base"), keys, "base", PARTITIONED_BY.split(","))
        self.layers.publish("key index", [*self._dropped(), Change(keys, staged, PARTITIONED_BY, whole=True)])

    def _dropped(self) -> list[Change]:
        return [Change(self.layers.keys, None, None, whole=True)] if self.tables.exists(self.layers.keys) else []

    def _laid_out(self, rows: DataFrame, load: str) -> DataFrame:
        """Entries with their partition; a column named after the number of buckets says what they were dealt by."""
        marked = rows.withColumns({f"of_{self.buckets}": F.lit(True), "key_bucket": self._bucket("_key"), "load": F.lit(load)})
        return marked.hint("rebalance", F.col("key_bucket"))

    def held(self, incoming: DataFrame) -> DataFrame:
        """(_key, _held, _day) of the clean events whose key is incoming: what ``held_rows`` finds by a scan."""
        key = self.config.key
        # At most as many values as there are buckets; they become partition filters.
        buckets = [r[0] for r in incoming.select(self._bucket(key)).distinct().collect()]
        entries = self.tables.read(self.layers.keys).where(F.col("key_bucket").isin(buckets))
        keys = incoming.select(F.col(key).alias("_in_key"))
        return self._newest(entries.join(keys, F.col("_key") == F.col("_in_key"), "left_semi"))

    def entries(self, winners: DataFrame, load: str) -> Change:
        """The staged entries of rows that become current."""
        c = self.config
        rows = winners.select(F.col(c.key).alias("_key"), F.col(c.order).alias("_held"), F.col("event_date").alias("_day"))
        staged = self.tables.stage(self._laid_out(rows, load), self.layers.keys, f"{load}_keys", PARTITIONED_BY.split(","))
        return Change(self.layers.keys, staged, PARTITIONED_BY)
