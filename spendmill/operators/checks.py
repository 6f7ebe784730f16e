"""Do the layers still add up? Each layer is aggregated once; checks compare the measures."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dedup import duplicate_keys
from .dimension import orphans, unknown_names


class Check(NamedTuple):
    """Two SQL expressions over measure names that must agree within ``tolerance``."""

    name: str
    expected: str
    actual: str
    tolerance: float = 0.0


# Fixed value: spend may differ by less than one cent between layers.
SPEND_TOLERANCE = 0.01

CHECKS = (
    Check("bronze_rows", "source_rows", "bronze_rows"),
    Check("quarantine_split", "bronze_rows", "quarantine_rows + good_rows"),
    Check("dedup_arithmetic", "surplus_rows", "good_rows - silver_rows"),
    Check("na_rows_in_silver", "0", "silver_na_rows"),
    Check("null_currency_in_silver", "0", "silver_null_currency"),
    Check("duplicate_dimension_keys", "0", "dim_duplicate_keys"),
    Check("unmapped_equals_orphans", "orphan_advertisers", "gold_unmapped_advertisers"),
    Check("undated_gold_rows", "0", "gold_undated_rows"),
    Check("spend_conservation", "silver_spend", "gold_spend", SPEND_TOLERANCE),
    Check("event_conservation", "silver_rows", "gold_events"),
)


def measure(df: DataFrame, **measures: Column) -> DataFrame:
    """(measure, value) rows from one aggregation over ``df``."""
    one = df.agg(*(m.cast("double").alias(n) for n, m in measures.items()))
    return one.select(F.inline(F.array(*(F.struct(F.lit(n).alias("measure"), F.col(n).alias("value")) for n in measures))))


def compare(measures: Sequence[DataFrame], checks: Sequence[Check], **known: float) -> DataFrame:
    """(check_name, expected, actual, passed) for each check whose measures are all present."""
    rows = reduce(DataFrame.unionByName, measures)
    names = {n for c in checks for n in _names_in(c)}
    wide = rows.agg(*(F.max(F.when(F.col("measure") == n, F.col("value"))).alias(n) for n in sorted(names)))
    lines = []
    for c in checks:
        want, got = F.expr(c.expected).cast("double"), F.expr(c.actual).cast("double")
        gap = F.abs(want - got)
        ok = gap < c.tolerance if c.tolerance else gap == 0
        lines.append(
            F.struct(
                F.lit(c.name).alias("check_name"),
                want.alias("expected"),
                got.alias("actual"),
                F.coalesce(ok, F.lit(False)).alias("passed"),
            )
        )
    return wide.select(F.inline(F.array(*lines)))


def _names_in(check: Check) -> set[str]:
    words = f"{check.expected} {check.actual}".replace("+", " ").replace("-", " ").split()
    return {w for w in words if not w.replace(".", "").isdigit()}


def pick(*names: str) -> list[Check]:
    by_name = {c.name: c for c in CHECKS}
    return [by_name[n] for n in names]


def rows_of(name: str, df: DataFrame) -> DataFrame:
    return measure(df, **{name: F.count(F.lit(1))})


def source_measures(feeds: Sequence[DataFrame]) -> DataFrame:
    counts = [f.agg(F.count(F.lit(1)).alias("n")) for f in feeds]
    return measure(reduce(DataFrame.unionByName, counts), source_rows=F.sum("n"))


def quarantine_measures(quarantine: DataFrame) -> DataFrame:
    return measure(
        quarantine,
        quarantine_rows=F.count(F.lit(1)),
        quarantine_na_rows=F.count_if(F.col("event_time") == "N/A"),
    )


def good_measures(good: DataFrame, key: str = "event_id") -> DataFrame:
    """Row count, and how many rows exceed one per key (0 when there are none)."""
    per_key = good.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return measure(
        per_key, good_rows=F.coalesce(F.sum("n"), F.lit(0)), surplus_rows=F.coalesce(F.sum(F.col("n") - 1), F.lit(0))
    )


def silver_measures(silver_usd: DataFrame) -> DataFrame:
    """``silver_usd`` carries ``cost_usd``; rows whose currency has no rate are counted apart."""
    return measure(
        silver_usd,
        silver_rows=F.count(F.lit(1)),
        silver_na_rows=F.count_if(F.col("event_time") == "N/A"),
        silver_null_currency=F.count_if(F.col("currency").isNull()),
        silver_unconverted=F.count_if(F.col("cost_usd").isNull()),
        silver_spend=F.coalesce(F.sum("cost_usd"), F.lit(0.0)),
    )


def spend_measures(events_usd: DataFrame) -> DataFrame:
    """The totals that must reappear in the daily table."""
    return measure(
        events_usd, silver_rows=F.count(F.lit(1)), silver_spend=F.coalesce(F.sum("cost_usd"), F.lit(0.0))
    )


def gold_measures(gold: DataFrame) -> DataFrame:
    unmapped, who = F.col("is_unmapped_advertiser"), F.col("advertiser_id")
    nameless = F.coalesce(F.max((unmapped & who.isNull()).cast("int")), F.lit(0))
    return measure(
        gold,
        gold_unmapped_advertisers=F.count_distinct(F.when(unmapped, who)) + nameless,
        gold_spend=F.coalesce(F.sum("total_spend_usd"), F.lit(0.0)),
        gold_events=F.coalesce(F.sum("event_count"), F.lit(0)),
        gold_unmapped_rows=F.count_if("is_unmapped_advertiser"),
        gold_undated_rows=F.count_if(F.col("event_date").isNull()),
    )


def dimension_measures(dim: DataFrame, silver: DataFrame, key: str = "advertiser_id") -> list[DataFrame]:
    return [
        rows_of("dim_duplicate_keys", duplicate_keys(dim, key)),
        rows_of("dim_unknown_names", unknown_names(dim, key)),
        rows_of("orphan_advertisers", orphans(silver, dim, key)),
    ]


def reconcile(
    feeds: Sequence[DataFrame],
    bronze: DataFrame,
    quarantine: DataFrame,
    good: DataFrame,
    silver_usd: DataFrame,
    gold: DataFrame,
    dim: DataFrame,
) -> DataFrame:
    """All checks as one report. Pass stored tables, so that each layer is read and not recomputed."""
    measures = [
        source_measures(feeds),
        rows_of("bronze_rows", bronze),
        quarantine_measures(quarantine),
        good_measures(good),
        silver_measures(silver_usd),
        gold_measures(gold),
        *dimension_measures(dim, silver_usd),
    ]
    return compare(measures, CHECKS)


def version_population(bronze: DataFrame, columns: Sequence[str] = ("spend", "media_cost", "viewability")) -> DataFrame:
    """How many rows of each schema version fill each drifting column."""
    return bronze.groupBy("schema_version").agg(*(F.count(c).alias(f"{c}_populated") for c in columns))


def rows_by(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))


def time_range(silver: DataFrame) -> DataFrame:
    return silver.agg(F.min("event_time_utc").alias("first_event"), F.max("event_time_utc").alias("last_event"))


def distinct_sample(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """The first ``n`` distinct combinations, NULLs last: a peek at what a feed holds.

    Ranked within its own partition first, a row beyond a partition's ``n`` smallest combinations can be in no sample:
    Spark drops such rows before the sort (``WindowGroupLimit``), so nearly unique columns are not shuffled for ten rows.
    """
    order = [F.col(c).asc_nulls_last() for c in columns]
    rank = F.dense_rank().over(Window.partitionBy("_part").orderBy(*order))
    first = df.select(*columns, F.spark_partition_id().alias("_part")).withColumn("_rank", rank).where(F.col("_rank") <= n)
    return first.select(*columns).distinct().orderBy(*order).limit(n)
