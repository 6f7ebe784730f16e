"""Results that an operator reads more than once, written to the folder all executors share."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CLEAN_UP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_OPEN: list[tuple[SparkSession, str]] = []


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; where it is unset (tests on one machine) a temporary folder is set as such."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="spendmill-shared-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, what: str) -> str:
    """A new path in the shared folder; it is deleted when this Python process ends."""
    path = f"{shared_folder(spark)}/spendmill-{what}-{uuid.uuid4().hex}"
    _OPEN.append((spark, path))
    return path


def stored(df: DataFrame, what: str, *, codec: str = "zstd", release: bool = False) -> DataFrame:
    """``df`` written once and read back: a cut lineage that survives lost executors.

    With ``release`` Spark deletes the shuffle files behind ``df`` as soon as it is written.
    """
    spark = df.sparkSession
    path = new_folder(spark, what)
    before = spark.conf.get(CLEAN_UP)
    spark.conf.set(CLEAN_UP, str(release or before == "true").lower())
    try:
        df.write.option("compression", codec).parquet(path)
    finally:
        spark.conf.set(CLEAN_UP, before)
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _delete_all() -> None:
    for spark, path in _OPEN:
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session has already ended: its files stay, as a killed job's would
            return
