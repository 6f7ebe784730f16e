"""The load log: one small file says which version of all layers counts.

A load stages every layer it changes, then commits by renaming one file into the log: that rename is the only moment at
which anything changes. From then on the staged tables are the truth (``Snapshot`` reads them), and putting them in
place is a step that may be killed and repeated. Before the rename nothing of the load counts, and its stages are dropped.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence
from dataclasses import asdict, dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import LayerTables

KEPT_RECORDS = 50


@dataclass(frozen=True)
class Change:
    """What a load does to one table: ``staged`` replaces it whole, or just the partitions that ``staged`` holds, and
    partitions of ``dropped`` (values of ``column``, as text) go. A whole change without ``staged`` drops the table.
    ``column`` is the partition column, or several with commas between."""

    table: str
    staged: str | None
    column: str | None
    whole: bool = False
    dropped: list[str] = field(default_factory=list)


@dataclass(frozen=True)
class Record:
    version: int
    label: str
    changes: list[Change]
    days: list[str] = field(default_factory=list)


class LoadLog:
    """Records ``<version>.json`` in one folder, and ``<version>.done`` once a record's tables are in place."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")
        self._Path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path().getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str = ""):
        return self._Path(f"{self.folder}/{name}" if name else self.folder)

    def _names(self) -> list[str]:
        if not self._fs.exists(self._path()):
            return []
        return [s.getPath().getName() for s in self._fs.listStatus(self._path())]

    def _versions(self, suffix: str) -> list[int]:
        return sorted(int(n.removesuffix(suffix)) for n in self._names() if n.endswith(suffix) and n[:1].isdigit())

    def version(self) -> int:
        """The version that counts; 0 before the first load."""
        return max(self._versions(".json"), default=0)

    def record(self, version: int) -> Record:
        stream = self._fs.open(self._path(f"{version:012d}.json"))
        reader = self.spark._jvm.java.io.BufferedReader(self.spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        try:
            found = json.loads(reader.readLine())
        finally:
            reader.close()
        return Record(found["version"], found["label"], [Change(**c) for c in found["changes"]], found["days"])

    def pending(self) -> Record | None:
        """The last record, if its tables are not all in place yet. Loads run one at a time, so there is one at most."""
        version = self.version()
        return self.record(version) if version and version not in self._versions(".done") else None

    def commit(self, label: str, changes: Sequence[Change], days: Sequence[str] = ()) -> Record:
        """Make the staged changes count, all at once. Fails if another load has committed this version meanwhile."""
        record = Record(self.version() + 1, label, list(changes), list(days))
        self._create(f"{record.version:012d}.json", json.dumps(asdict(record)))
        return record

    def finished(self, record: Record) -> None:
        self._create(f"{record.version:012d}.done", "")
        for old in self._versions(".json"):
            if old <= record.version - KEPT_RECORDS:
                for suffix in (".json", ".done"):
                    self._fs.delete(self._path(f"{old:012d}{suffix}"), False)

    def _create(self, name: str, text: str) -> None:
        """The file appears with its whole content or not at all, and never over another one."""
        jvm, draft = self.spark._jvm, self._path(f"_{uuid.uuid4().hex}")
        self._fs.mkdirs(self._path())
        out = self._fs.create(draft, False)
        try:
            out.write(bytearray(text.encode()))
        finally:
            out.close()
        files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self.spark._jsc.hadoopConfiguration())
        never_over = self.spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        never_over[0] = jvm.org.apache.hadoop.fs.Options.Rename.NONE
        files.rename(self._fs.makeQualified(draft), self._fs.makeQualified(self._path(name)), never_over)


def log_folder(spark: SparkSession, tables: LayerTables) -> str:
    """The configured folder, else one in the raw layer's namespace."""
    config = tables.config
    if config.load_log:
        return config.load_log
    namespace = f"{config.catalog}.{config.bronze}" if config.catalog else config.bronze
    rows = spark.sql(f"DESCRIBE NAMESPACE {namespace}").collect()
    location = next((r[1] for r in rows if r[0].lower() == "location" and r[1]), None)
    if not location:
        raise ValueError(f"namespace {namespace} names no location: set load_log in the configuration")
    return f"{location.rstrip('/')}/_loads"


def put_in_place(tables: LayerTables, change: Change) -> None:
    """Make the table what the change says. Repeating it changes nothing."""
    columns = change.column.split(",") if change.column else []
    if change.whole and not change.staged:
        tables.spark.sql(f"DROP TABLE IF EXISTS {change.table}")
        return
    if change.whole and len(columns) > 1:
        tables.replace_all(tables.read(change.staged), change.table, columns)
        return
    if change.whole:
        tables.publish(change.staged, change.table, change.column)
        return
    if change.staged:
        rows = tables.read(change.staged)
        tables.ensure(change.table, rows.schema, columns)
        tables.replace_partitions(rows, change.table)
    if change.dropped:
        kind = tables.read(change.table).schema[change.column].dataType.simpleString()
        tables.drop_partitions(change.table, change.column, change.dropped, kind)


def as_changed(tables: LayerTables, change: Change) -> DataFrame:
    """The table as it will be once the change is in place, read from where the rows are now."""
    if change.whole or not tables.exists(change.table):
        return tables.read(change.staged)
    held = tables.read(change.table)
    parts = tables.read(change.staged).select(change.column).distinct() if change.staged else None
    if change.dropped:
        kind = held.schema[change.column].dataType.simpleString()
        gone = held.sparkSession.createDataFrame([(v,) for v in change.dropped], "v string").select(F.col("v").cast(kind).alias(change.column))
        parts = gone if parts is None else parts.unionByName(gone)
    if parts is None:
        return held
    # One value per partition, that is per calendar day or batch.
    kept = held.join(F.broadcast(parts.withColumnRenamed(change.column, "_part")), F.col(change.column).eqNullSafe(F.col("_part")), "left_anti")
    return kept.unionByName(tables.read(change.staged), allowMissingColumns=True) if change.staged else kept
