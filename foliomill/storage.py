"""Tables in the folder that driver and executors share."""

from __future__ import annotations

import atexit
import contextlib
import uuid

from pyspark.sql import DataFrame, SparkSession

_cleared: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder in spark.checkpoint.dir. Where none is set: a default in local mode, as in tests; on a cluster an error, as executors don't see the driver's folders."""
    sc = spark.sparkContext
    at = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not at:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = "file:///tmp/checkpoints"
        sc.setCheckpointDir(at)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def _delete(spark: SparkSession, path: str) -> None:
    """Spark's API can write files but not delete them, so Hadoop's is asked."""
    sc = spark.sparkContext
    at = sc._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(sc._jsc.hadoopConfiguration()).delete(at, True)


def _at_exit(spark: SparkSession, path: str) -> None:
    with contextlib.suppress(Exception):  # the JVM may be gone; then the folder stays, with the application's id as its name
        _delete(spark, path)


def stored(df: DataFrame, what: str) -> DataFrame:
    """Write once to the shared folder and read again: cuts lineage, survives lost executors.

    An application's tables are in one folder, foliomill-<application id>, that goes when the driver ends.
    """
    spark = df.sparkSession
    root = f"{shared_dir(spark)}/foliomill-{spark.sparkContext.applicationId}"
    if root not in _cleared:
        _cleared.add(root)
        atexit.register(_at_exit, spark, root)
    path = f"{root}/{what}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete the files of tables that stored() made and nothing needs any more."""
    for df in tables:
        _delete(df.sparkSession, df._stored_at)
