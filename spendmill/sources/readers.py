"""Readers for vendor files and tables."""

from __future__ import annotations

import csv
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.bronze import file_version, keep_payload, rescue_unknown, union_versions
from ..operators.dedup import exact_dedup, purge_keys

CORRUPT = "_corrupt_record"


def csv_options(schema: T.StructType) -> dict[str, str]:
    """Named columns are checked against the header; a malformed line is kept, not dropped."""
    options = {"header": "true", "enforceSchema": "false", "mode": "PERMISSIVE"}
    if CORRUPT in schema.names:
        options["columnNameOfCorruptRecord"] = CORRUPT
    return options


def load_events(spark: SparkSession, path: str | list[str], schema: T.StructType, fmt: str = "csv") -> DataFrame:
    """Vendor files with an explicit schema.

    Add a string field ``_corrupt_record`` to ``schema`` to keep the text of malformed lines. The
    file each row came from is available as ``_metadata.file_path``.
    """
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.options(**csv_options(schema))
    return reader.format(fmt).load(path)


def file_headers(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files under ``path`` by the column names in their first line; empty files have none and are left out.

    Spark reads the lines on the executors; a first line and a path for each file reach the driver, which has to list
    them for the scans that follow.
    """
    place = (F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    lines = spark.read.text(path).select("value", *place).where("start = 0").withColumn("at", F.monotonically_increasing_id())
    opening = lines.groupBy("file").agg(F.min_by("value", "at").alias("line"))
    found: dict[tuple[str, ...], list[str]] = {}
    for row in opening.toLocalIterator():
        names = next(csv.reader([row.line.removeprefix("\ufeff")]), [])
        found.setdefault(tuple(name.strip() for name in names), []).append(unquote(row.file))
    return found


def load_drifting(spark: SparkSession, path: str | list[str], schema: T.StructType, payload: bool = False) -> DataFrame:
    """CSV files whose columns drift, with nothing lost; files of one folder may have different headers.

    Columns are found by header name, in any order. Declared ones that a file lacks are NULL; what ``schema``
    does not declare goes to ``_rescued_data`` as JSON; the text of a line with a malformed value is kept in
    ``_corrupt_record``. ``schema_version`` comes from the file's columns and ``source_file`` is its path.
    Files with one header are one scan. ``payload`` adds ``_payload``: the whole line as sent, as JSON by column name.
    """
    by_header = file_headers(spark, path)
    kinds = {f.name: f.dataType for f in schema.fields}
    added = (CORRUPT, *(["_payload"] if payload else []), "source_file", "schema_version", "_rescued_data")
    parts = []
    for header, same in by_header.items():
        fields = [T.StructField(name, kinds.get(name, T.StringType())) for name in header]
        own = T.StructType([*fields, T.StructField(CORRUPT, T.StringType())])
        rows = spark.read.schema(own).options(**csv_options(own)).csv(same)
        if payload:
            rows = keep_payload(rows)
        rows = rows.withColumns({"source_file": F.col("_metadata.file_path"), "schema_version": F.lit(file_version(header))})
        parts.append(rescue_unknown(rows, {*kinds, *added[:-1]}))
    if not parts:
        names = [T.StructField(c, T.StringType()) for c in added]
        return spark.createDataFrame([], T.StructType([*schema.fields, *names]))
    rows = union_versions(*parts)
    missing = {c: F.lit(None).cast(k) for c, k in kinds.items() if c not in rows.columns}
    return rows.withColumns(missing).select(*kinds, *added)


def clean_events(df: DataFrame, metric: str = "spend", key: str = "event_id") -> DataFrame:
    """Full-row copies, rows without the metric, and all rows of a key with a negative metric go."""
    filled = exact_dedup(df.where(F.col(metric).isNotNull()))
    return purge_keys(filled, key, F.col(metric) < 0)
