"""Incremental file-by-file ingest: a file stream per vendor feed, one upsert per micro-batch.

``dropDuplicates`` on a stream keeps the first arrival; here the *latest* version of an event must
win, so each micro-batch is applied to the stored tables instead. A replayed micro-batch carries the
same label and leaves the tables as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..config import MillConfig, checkpoint_root
from ..operators import Rule, tag_provenance, union_versions
from ..plans.incremental import IncrementalLoad
from ..sources.readers import csv_options, load_drifting
from ..sources.schemas import EVENTS_ANY


# What Spark's reader of whole files gives.
FILES = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


@dataclass(frozen=True)
class VendorFolder:
    """A folder that receives files of one schema version."""

    path: str
    schema: T.StructType
    version: str
    fmt: str = "csv"
    max_files_per_batch: int | None = None


def folder_stream(spark: SparkSession, folder: VendorFolder) -> DataFrame:
    reader = spark.readStream.schema(folder.schema).format(folder.fmt)
    if folder.fmt == "csv":
        reader = reader.options(**csv_options(folder.schema))
    if folder.max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", folder.max_files_per_batch)
    return tag_provenance(reader.load(folder.path), folder.version, F.col("_metadata.file_path"))


def start_incremental(
    spark: SparkSession,
    folders: Sequence[VendorFolder],
    config: MillConfig | None = None,
    name: str = "vendor_ingest",
    checkpoint: str | None = None,
    every: str | None = None,
    rules: Sequence[Rule | Mapping] = (),
) -> StreamingQuery:
    """Start ingesting new files of ``folders`` into the layer tables.

    Without ``every`` the query takes what is there and stops; ``every='1 hour'`` keeps it running.
    A batch that breaks one of ``rules`` stops the query before anything is published. The checkpoint
    lies under ``spark.checkpoint.dir``; ``checkpoint`` is used where that is unset.
    """
    rows = union_versions(*(folder_stream(spark, f) for f in folders))
    return ingest(spark, rows, lambda batch, _: _unless_empty(batch), IncrementalLoad(spark, config, rules), name, checkpoint, every)


def start_drifting(
    spark: SparkSession,
    paths: Sequence[str],
    schema: T.StructType = EVENTS_ANY,
    config: MillConfig | None = None,
    name: str = "vendor_drift",
    checkpoint: str | None = None,
    every: str | None = None,
    rules: Sequence[Rule | Mapping] = (),
    max_files_per_batch: int | None = None,
    payload: bool = False,
) -> StreamingQuery:
    """Like ``start_incremental``, for folders of CSV files whose columns drift from file to file.

    The stream carries the names of new files only; each micro-batch reads its files by their own headers
    (``load_drifting``): any order of columns, missing ones NULL, undeclared ones in ``_rescued_data``, malformed lines
    in ``_corrupt_record``, the version told from the columns. ``payload`` keeps every line whole in ``_payload``.
    """

    def files(path: str) -> DataFrame:
        reader = spark.readStream.format("binaryFile").schema(FILES)
        if max_files_per_batch:
            reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
        return reader.load(path).select("path")  # no content is read

    def rows(batch: DataFrame, _: int) -> DataFrame | None:
        listed = [r.path for r in batch.toLocalIterator()]
        if not listed:
            return None
        found = load_drifting(spark, listed, schema, payload)
        return found.withColumns({"ingested_at": F.current_timestamp()})

    return ingest(spark, reduce(DataFrame.union, map(files, paths)), rows, IncrementalLoad(spark, config, rules), name, checkpoint, every)


def _unless_empty(batch: DataFrame) -> DataFrame | None:
    return None if batch.isEmpty() else batch


def ingest(
    spark: SparkSession,
    stream: DataFrame,
    rows_of: Callable[[DataFrame, int], DataFrame | None],
    load: IncrementalLoad,
    name: str,
    checkpoint: str | None,
    every: str | None,
) -> StreamingQuery:
    """Apply ``rows_of(batch, batch id)`` of every micro-batch to the layers; None applies nothing."""
    location = f"{checkpoint_root(spark, checkpoint)}/{name}"

    def take(batch: DataFrame, batch_id: int) -> None:
        # The query id is kept in the checkpoint: a new checkpoint never reuses an old batch's label.
        query_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or name
        rows = rows_of(batch, batch_id)
        if rows is not None:
            load.apply(rows, f"{query_id}-{batch_id:09d}")

    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (
        stream.writeStream.queryName(name)
        .option("checkpointLocation", location)
        .trigger(**trigger)
        .foreachBatch(take)
        .start()
    )
