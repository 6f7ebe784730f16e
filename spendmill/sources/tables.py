"""The layer tables in the catalog: replacing them, rewriting single partitions, staging results."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import ADVERTISER_DIM, CLEAN_EVENTS, DAILY_SPEND, QUARANTINE_EVENTS, RAW_EVENTS, MillConfig


class LayerTables:
    def __init__(self, spark: SparkSession, config: MillConfig | None = None):
        self.spark = spark
        self.config = config or MillConfig()

    def ensure_namespaces(self) -> None:
        c = self.config
        for layer in (c.bronze, c.silver, c.gold):
            name = f"{c.catalog}.{layer}" if c.catalog else layer
            self.spark.sql(f"CREATE NAMESPACE IF NOT EXISTS {name}")

    def exists(self, table: str) -> bool:
        return self.spark.catalog.tableExists(table)

    def read(self, table: str) -> DataFrame:
        return self.spark.table(table)

    def overwrite(self, df: DataFrame, table: str, partition_by: Sequence[str] = ()) -> None:
        """Replace the table."""
        writer = df.write.format(self.config.fmt).mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.saveAsTable(table)

    def conform(self, df: DataFrame, table: str) -> DataFrame:
        """``df`` with all columns of ``table``, in its types: what ``df`` lacks is NULL, what is new comes after."""
        if not self.exists(table):
            return df
        fields = {f.name: f.dataType for f in self.read(table).schema.fields}
        known = [(F.col(n) if n in df.columns else F.lit(None)).cast(k).alias(n) for n, k in fields.items()]
        return df.select(*known, *(c for c in df.columns if c not in fields))

    def ensure(self, table: str, schema: T.StructType, partition_by: Sequence[str]) -> None:
        """Create the table, without rows, if it does not exist yet."""
        if not self.exists(table):
            self.overwrite(self.spark.createDataFrame([], schema), table, partition_by)

    def add_columns(self, table: str, schema: T.StructType) -> None:
        """Columns of ``schema`` that the table lacks become part of it; old rows read NULL there."""
        known = set(self.read(table).columns)
        new = [f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields if f.name not in known]
        if new:
            self.spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({', '.join(new)})")

    def replace_partitions(self, df: DataFrame, table: str) -> None:
        """Overwrite just the partitions that ``df`` holds, adding columns that are new. Safe to repeat."""
        self.add_columns(table, df.schema)
        fields = self.read(table).schema.fields
        have = set(df.columns)
        aligned = df.select(*(F.col(f.name) if f.name in have else F.lit(None).cast(f.dataType).alias(f.name) for f in fields))
        # insertInto reads this only from the session that owns the frame, which for a micro-batch is
        # the stream's own copy. Under "static" the write would empty every other partition.
        conf, setting = df.sparkSession.conf, "spark.sql.sources.partitionOverwriteMode"
        before = conf.get(setting)
        conf.set(setting, "dynamic")
        try:
            aligned.write.insertInto(table, overwrite=True)
        finally:
            conf.set(setting, before)

    def replace_all(self, df: DataFrame, table: str, partition_by: Sequence[str]) -> None:
        """Make ``table`` hold just ``df``, creating it if need be. Safe to repeat."""
        if self.exists(table):
            df.select(*self.read(table).columns).write.insertInto(table, overwrite=True)
        else:
            self.overwrite(df, table, partition_by)

    def partitions(self, table: str) -> int:
        """Number of partitions of ``table``, from the catalog alone."""
        return self.spark.sql(f"SHOW PARTITIONS {table}").count()

    def drop_partitions(self, table: str, column: str, values: Iterable[str], kind: str) -> None:
        """Remove whole partitions, for values (as text) that no longer have any row. Safe to repeat."""

        def literal(value: str) -> str:
            escaped = value.replace("\\", "\\\\").replace("'", "\\'")
            return f"DATE '{value}'" if kind == "date" else f"'{escaped}'"

        specs = ", ".join(f"PARTITION ({column} = {literal(v)})" for v in values)
        if specs:
            self.spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")

    def stage(self, df: DataFrame, table: str, label: str, partition_by: Sequence[str] = ()) -> str:
        """Write ``df`` beside ``table``. The name enters the catalog only once the data is complete,
        and each attempt has its own name, so a crashed attempt neither counts nor gets in the way."""
        name = f"{table}__{label}_{uuid.uuid4().hex[:8]}"
        self.overwrite(df, name, partition_by)
        return name

    def staged(self, table: str) -> list[str]:
        """Names of all completed staged tables of ``table`` (as many as unfinished loads)."""
        namespace, base = table.rsplit(".", 1)
        found = self.spark.sql(f"SHOW TABLES IN {namespace} LIKE '{base}__*'").select("tableName").collect()
        return [f"{namespace}.{r.tableName}" for r in found]

    def drop_staged(self, table: str) -> None:
        for staged in self.staged(table):
            self.spark.sql(f"DROP TABLE IF EXISTS {staged}")

    def publish(self, staged: str, table: str, day: str | None = "event_date") -> None:
        """Make ``table`` equal to a finished staged table, partition by partition (or whole without ``day``).

        Readers keep the table throughout, but for one with other columns or types, which is replaced whole. Safe to
        repeat; the staged table stays.
        """
        new = self.read(staged)
        kinds = {f.name: f.dataType for f in new.schema.fields}
        held = {f.name: f.dataType for f in self.read(table).schema.fields} if self.exists(table) else None
        if held != kinds:
            self.overwrite(new, table, [day] if day else [])
        elif day is None:
            new.select(*self.read(table).columns).write.insertInto(table, overwrite=True)
        else:
            # One value per calendar day on either side.
            gone = self.read(table).select(day).distinct().join(new.select(day).distinct(), day, "left_anti")
            days = [str(r[0]) for r in gone.collect()]
            self.replace_partitions(new, table)
            self.drop_partitions(table, day, days, kinds[day].simpleString())
