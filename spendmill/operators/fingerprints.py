"""Where do two layers differ? A tree of order-free fingerprints says so without joining them.

A leaf covers the rows of one day whose keys share a hash bucket: their number and the sums of two hashes of each row.
Sums do not depend on order or partitions, and leaves add up to days and days to the whole. Two layers are compared
leaf by leaf, day totals first; only rows under unequal leaves are looked at again, key by key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 64
#: Sums of 64-bit hashes; exact for 10**19 rows of a node.
EXACT_SUM = "decimal(38,0)"


def _measures(columns: Sequence[str]) -> list[Column]:
    """Number of rows, and the sums of two hashes of a row, in which a null differs from every value."""
    values = [x for c in columns for x in (F.col(c).isNull(), F.col(c))]
    hashes = (F.xxhash64(F.lit(seed), *values) for seed in (0, 1))
    return [F.count(F.lit(1)).alias("n"), *(F.sum(h.cast("decimal(20,0)")).cast(EXACT_SUM).alias(f"h{i}") for i, h in enumerate(hashes))]


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(2), F.col(key)), F.lit(buckets)).cast("int")


def fingerprints(rows: DataFrame, columns: Sequence[str], key: str = "event_id", day: Column | None = None, buckets: int = BUCKETS) -> DataFrame:
    """The leaves of a layer: (day, bucket, n, h0, h1) over ``columns``. They may be stored and compared later."""
    day = F.to_date("event_time_utc") if day is None else day
    return rows.groupBy(day.alias("day"), bucket_of(key, buckets).alias("bucket")).agg(*_measures(columns))


def unequal(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """The nodes (``by``) at which two sets of leaves, added up, differ; a node that only one side has differs."""

    def signed(leaves: DataFrame, sign: int) -> DataFrame:
        return leaves.select(*by, *((F.col(c) * sign).cast(EXACT_SUM).alias(c) for c in ("n", "h0", "h1")))

    sums = signed(left, 1).unionByName(signed(right, -1)).groupBy(*by).agg(*(F.sum(c).alias(c) for c in ("n", "h0", "h1")))
    return sums.where("n <> 0 OR h0 <> 0 OR h1 <> 0").select(*by)


def differing_nodes(left: DataFrame, right: DataFrame) -> DataFrame:
    """(day, bucket) of unequal leaves, sought only under unequal days."""
    days = F.broadcast(unequal(left, right, ["day"]).toDF("_day"))  # bounded by the calendar
    under = F.col("day").eqNullSafe(F.col("_day"))
    return unequal(left.join(days, under, "left_semi"), right.join(days, under, "left_semi"), ["day", "bucket"])


def layer_differences(
    left: DataFrame, right: DataFrame, columns: Sequence[str], key: str = "event_id", day: Column | None = None, buckets: int = BUCKETS
) -> DataFrame:
    """One row per key that differs between two layers: key, left_rows, right_rows, status.

    ``status``: ``missing`` (only left has the key), ``extra`` (only right has it), ``copies`` (other numbers of rows) or
    ``changed`` (as many rows, other values in ``columns``). Layers may repeat keys, hold nulls and be empty. Rows of
    equal leaves are read for the fingerprints only. Each side is scanned twice: for its leaves, and for the rows under
    unequal ones; the second scan leaves all other rows out before anything is shuffled.
    """
    day = F.to_date("event_time_utc") if day is None else day
    nodes = differing_nodes(*(fingerprints(x, columns, key, day, buckets) for x in (left, right)))
    nodes = nodes.toDF("_node_day", "_node_bucket")

    def under(rows: DataFrame, name: str) -> DataFrame:
        at = day.eqNullSafe(F.col("_node_day")) & (bucket_of(key, buckets) == F.col("_node_bucket"))
        measures = (m.alias(f"_{name}_{i}") for i, m in enumerate(_measures(columns)))
        return rows.join(nodes, at, "left_semi").groupBy(F.col(key).alias(f"_{name}_key")).agg(*measures)

    both = under(left, "l").join(under(right, "r"), F.col("_l_key").eqNullSafe(F.col("_r_key")), "full_outer")
    rows = [F.coalesce(f"_{n}_0", F.lit(0)).cast("long") for n in "lr"]
    same = F.col("_l_1").eqNullSafe(F.col("_r_1")) & F.col("_l_2").eqNullSafe(F.col("_r_2"))
    status = F.when(rows[1] == 0, "missing").when(rows[0] == 0, "extra").when(rows[0] != rows[1], "copies").otherwise("changed")
    differs = both.where((rows[0] != rows[1]) | ~same)
    return differs.select(F.coalesce("_l_key", "_r_key").alias(key), rows[0].alias("left_rows"), rows[1].alias("right_rows"), status.alias("status"))

