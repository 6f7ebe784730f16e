"""Join facts to a dimension without losing or multiplying a fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import UNKNOWN_NAME


def unique_dimension(
    dim: DataFrame, key: str = "advertiser_id", name_col: str = "advertiser_name", on_duplicate: str = "error"
) -> DataFrame:
    """(key, name) with one row per key, so that a join on it cannot fan out.

    A repeated key fails the job (``'error'``) or resolves to its smallest non-null name
    (``'smallest'``). Only the two columns are kept, so no fact column can become ambiguous.
    """
    if on_duplicate not in ("error", "smallest"):
        raise ValueError(f"on_duplicate must be 'error' or 'smallest', not {on_duplicate!r}")
    one = dim.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(name_col).alias(name_col), F.count(F.lit(1)).alias("_n"))
    name = F.col(name_col)
    if on_duplicate == "error":
        complaint = F.concat(F.lit(f"dimension key {key} is not unique: "), F.col(key).cast("string"))
        name = F.when(F.col("_n") > 1, F.raise_error(complaint).cast("string")).otherwise(name)
    return one.select(key, name.alias(name_col))


def join_dimension(
    fact: DataFrame,
    dim: DataFrame,
    key: str = "advertiser_id",
    name_col: str = "advertiser_name",
    default: str = UNKNOWN_NAME,
    on_duplicate: str = "error",
) -> DataFrame:
    """Left join that names every fact and flags the ones the dimension does not know.

    The flag comes from a marker on the dimension side, not from the name: a known key with a NULL
    name is named ``default`` but is not flagged. No broadcast is forced. Spark broadcasts the
    dimension when its size is known to be under ``spark.sql.autoBroadcastJoinThreshold``; beyond
    that it is a sort-merge join whose skewed fact partitions adaptive execution splits.
    """
    side = unique_dimension(dim, key, name_col, on_duplicate).select(
        key, F.col(name_col).alias("_dim_name"), F.lit(True).alias("_known")
    )
    kept = [c for c in fact.columns if c != name_col]
    return fact.join(side, key, "left").select(
        *kept,
        F.coalesce(F.col("_dim_name"), F.lit(default)).alias(name_col),
        F.col("_known").isNull().alias("is_unmapped_advertiser"),
    )


def orphans(fact: DataFrame, dim: DataFrame, key: str = "advertiser_id") -> DataFrame:
    """Distinct fact keys that the dimension lacks; reduced to distinct keys before joining."""
    return fact.select(key).distinct().join(dim.select(key), key, "left_anti")


def unknown_names(
    dim: DataFrame, key: str = "advertiser_id", name_col: str = "advertiser_name", default: str = UNKNOWN_NAME
) -> DataFrame:
    """Dimension keys whose name is NULL or is literally the default name."""
    name = F.col(name_col)
    return dim.where(name.isNull() | (name == default)).select(key)
