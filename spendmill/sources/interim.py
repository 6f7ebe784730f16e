"""Results that a plan uses several times, computed once."""

from __future__ import annotations

import atexit
import uuid
import warnings

from pyspark.sql import DataFrame, SparkSession

_OPEN: list[tuple[SparkSession, str]] = []


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder named by ``spark.checkpoint.dir`` and read it back.

    This cuts the lineage, survives a lost executor, and tells Spark the true size, so a join with it
    is broadcast only if it really is small. Where the cluster names no folder the frame stays lazy, with
    a warning. The files are deleted when the process ends.
    """
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        warnings.warn("spark.checkpoint.dir is not set: interim results are derived again wherever they are used", stacklevel=2)
        return df
    path = f"{root.rstrip('/')}/spendmill-{uuid.uuid4().hex}"
    _OPEN.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@atexit.register
def _delete_all() -> None:
    for spark, path in _OPEN:
        try:
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
        except Exception:  # the session has already ended: its files stay, as a killed job's would
            return
