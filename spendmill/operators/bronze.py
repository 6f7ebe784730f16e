"""Raw layer: keep every vendor row, say where it came from, merge file versions by name."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import VERSION_MARKERS
from ..functions import version_of


# JSON text keeps NULL fields and microseconds, so nothing of the row is lost.
WHOLE_ROW_JSON = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}


def tag_provenance(
    df: DataFrame, version: str | Column, source_name: str | Column, ingested_at: Column | None = None
) -> DataFrame:
    """Add the never-null ``schema_version``, ``source_file`` and ``ingested_at`` columns.

    ``source_name`` may be a column such as ``_metadata.file_path``.
    """
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    return df.withColumns(
        {
            "schema_version": as_column(version),
            "source_file": as_column(source_name),
            "ingested_at": F.current_timestamp() if ingested_at is None else ingested_at,
        }
    )


def stamp_ingest(df: DataFrame, ingested_at: Column | None = None) -> DataFrame:
    """Add only ``ingested_at``, for tables that do not drift (dimensions)."""
    return df.withColumns({"ingested_at": F.current_timestamp() if ingested_at is None else ingested_at})


def detect_version(
    df: DataFrame, markers: Mapping[str, Sequence[str]] = VERSION_MARKERS, default: str = "v1"
) -> DataFrame:
    """Derive ``schema_version`` per row from which version-specific columns are populated."""
    return df.withColumns({"schema_version": version_of(df.columns, markers, default)})


def file_version(
    columns: Iterable[str], markers: Mapping[str, Sequence[str]] = VERSION_MARKERS, default: str = "v1"
) -> str:
    """The schema version of a whole file, told from which columns it has."""
    have = set(columns)
    return next((version for version, names in markers.items() if have.intersection(names)), default)


def union_versions(*feeds: DataFrame) -> DataFrame:
    """One superset table from any number of feeds; a column a feed lacks is NULL there."""
    if not feeds:
        raise ValueError("union_versions needs at least one feed")
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), feeds)


def rescue_unknown(df: DataFrame, known: Iterable[str], into: str = "_rescued_data") -> DataFrame:
    """Move columns outside ``known`` into one JSON string instead of failing on them.

    The string is NULL when the feed has no such column, or a row fills none of them.
    """
    declared = set(known)
    extra = [c for c in df.columns if c not in declared]
    kept = [F.col(c) for c in df.columns if c in declared]
    if not extra:
        return df.select(*kept, F.lit(None).cast("string").alias(into))
    filled = F.coalesce(*(F.col(c).cast("string") for c in extra)).isNotNull()
    return df.select(*kept, F.when(filled, F.to_json(F.struct(*extra), WHOLE_ROW_JSON)).alias(into))


def keep_payload(df: DataFrame, into: str = "_payload") -> DataFrame:
    """Add the complete row, NULL fields included, as one JSON string."""
    return df.withColumns({into: F.to_json(F.struct(*df.columns), WHOLE_ROW_JSON)})


def payload_fields(df: DataFrame, payload: str = "_payload", known: Iterable[str] = (), prefix: str = "") -> DataFrame:
    """(field, type, n): which fields outside ``known`` the JSON objects in ``payload`` hold, of which type, in how many rows.

    Spark parses the text as VARIANT and unnests its top level, so no schema is declared; text that is no JSON and NULL
    have no fields. A field that comes with several types has a row for each; JSON null has type ``VOID``.
    """
    # The parsed column's name is chosen so that unnesting it cannot clash.
    parsed = df.select(F.try_parse_json(F.col(payload)).alias("_parsed"))
    fields = parsed.lateralJoin(df.sparkSession.tvf.variant_explode(F.col("_parsed").outer()))
    typed = fields.where("key IS NOT NULL").select(F.col("key"), F.schema_of_variant("value").alias("type"))
    new = typed.where(~F.col("key").isin(*known)) if known else typed
    return new.groupBy(F.concat(F.lit(prefix), "key").alias("field"), "type").agg(F.count(F.lit(1)).alias("n"))


def payload_schema(df: DataFrame, payload: str = "_payload") -> DataFrame:
    """One row: the merged schema of all JSON values in ``payload`` (``OBJECT<...>``), nested fields included."""
    return df.agg(F.schema_of_variant_agg(F.try_parse_json(F.col(payload))).alias("payload_schema"))
