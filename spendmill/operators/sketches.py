"""Uniqueness at a glance: a mergeable sketch of distinct values for each day, so the exact count runs only when needed."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: 2**12 registers: a standard error of 1.6 %.
PRECISION = 12
#: An estimate is trusted to this share either way, a dozen standard errors.
MARGIN = 0.2


def value_sketches(df: DataFrame, columns: Sequence[str], day: Column) -> DataFrame:
    """(day, column, rows, has_null, sketch): one row for each day and column, from one aggregation. Null is a value apart."""
    sketched = [F.hll_sketch_agg(F.col(c).cast("string"), F.lit(PRECISION)).alias(f"s{i}") for i, c in enumerate(columns)]
    nulls = [F.max(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(columns)]
    wide = df.groupBy(day.alias("day")).agg(F.count(F.lit(1)).alias("rows"), *sketched, *nulls)
    one = [F.struct(F.lit(c).alias("column"), F.col("rows"), F.col(f"n{i}").alias("has_null"), F.col(f"s{i}").alias("sketch")) for i, c in enumerate(columns)]
    return wide.select("day", F.inline(F.array(*one)))


def distinct_bounds(sketches: DataFrame) -> DataFrame:
    """(column, rows, estimate, at_least, at_most) over all days of stored sketches; no row of the data is read."""
    whole = sketches.groupBy("column").agg(
        F.sum("rows").alias("rows"),
        (F.hll_sketch_estimate(F.hll_union_agg("sketch")) + F.max(F.col("has_null").cast("long"))).alias("estimate"),
    )
    low, high = F.floor(F.col("estimate") * (1 - MARGIN)), F.ceil(F.col("estimate") * (1 + MARGIN))
    return whole.select("column", "rows", "estimate", low.alias("at_least"), F.least(high, "rows").alias("at_most"))


def uniqueness(df: DataFrame, sketches: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(column, rows, passed, decided_by): are the values of each column distinct, null counted as one value?

    A column whose ``at_most`` lies below its rows is not unique and is settled by its ``sketch``. Only the others are
    made distinct by a scan of that column (``exact``); the driver sees one row for each column. Empty data is unique.
    """
    bounds = {r["column"]: r for r in distinct_bounds(sketches).collect()}
    open_columns = [c for c in columns if c not in bounds or bounds[c]["at_most"] >= bounds[c]["rows"]]
    settled = [(c, bounds[c]["rows"], False, "sketch") for c in columns if c not in open_columns]
    parts = [df.sparkSession.createDataFrame(settled, "column string, rows long, passed boolean, decided_by string")]
    for c in open_columns:
        counts = df.groupBy(F.col(c).alias("_value")).agg(F.count(F.lit(1)).alias("n"))
        rows = F.coalesce(F.sum("n"), F.lit(0))
        parts.append(counts.agg(F.lit(c).alias("column"), rows.alias("rows"), (rows == F.count(F.lit(1))).alias("passed"), F.lit("exact").alias("decided_by")))
    return reduce(DataFrame.unionByName, parts)
