"""Choose one row per key, or drop keys, without gathering a key's copies in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _names(value: str | Sequence[str]) -> list[str]:
    return [value] if isinstance(value, str) else list(value)


def _orderable(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_orderable(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _orderable(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def dedup_latest(
    df: DataFrame,
    key: str | Sequence[str] = "event_id",
    order: str | Sequence[str] = "ingest_time",
    tie_breakers: Sequence[str] = ("cost_raw",),
) -> DataFrame:
    """Keep, per key, the row with the greatest ``order``, then ``tie_breakers``, then the rest of the row.

    The newest row is the maximum of a struct that starts with the ordering columns. A maximum is
    combined on the map side, so each task ships at most one row per key and a key with a third of
    all rows costs no more than any other. NULL sorts lowest. Comparing every column makes the
    survivor the same on every run, and exact copies are simply equal.
    """
    keys = _names(key)
    lead = [c for c in dict.fromkeys(_names(order) + list(tie_breakers)) if c in df.columns and c not in keys]
    missing = [c for c in _names(order) if c not in df.columns]
    if missing:
        raise ValueError(f"ordering columns not found: {missing}")
    rest = [f.name for f in df.schema.fields if f.name not in keys and f.name not in lead]
    comparable = [f.name for f in df.schema.fields if f.name in rest and _orderable(f.dataType)]
    newest: Column
    if len(comparable) == len(rest):
        newest = F.max(F.struct(*lead, *rest))
    else:
        newest = F.max_by(F.struct(*lead, *rest), F.struct(*lead, *comparable))
    picked = df.groupBy(*keys).agg(newest.alias("_newest"))
    return picked.selectExpr(*(f"`{c}`" if c in keys else f"_newest.`{c}` AS `{c}`" for c in df.columns))


def exact_dedup(df: DataFrame) -> DataFrame:
    """Drop full-row copies. Re-sent keys with other values stay: see ``dedup_latest``."""
    return df.dropDuplicates()


def purge_keys(df: DataFrame, key: str, condition: str | Column) -> DataFrame:
    """Remove *every* row of a key that has at least one row meeting ``condition``.

    The condemned keys are reduced to one row each before the anti join.
    """
    test = F.expr(condition) if isinstance(condition, str) else condition
    condemned = df.where(test).select(key).distinct()
    return df.join(condemned, key, "left_anti")


def duplicate_keys(df: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their number of rows ``n``."""
    return df.groupBy(*_names(key)).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
