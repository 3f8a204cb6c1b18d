"""Session helpers: tables, scratch space in the cluster's shared folder, lineage cuts."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet table ``name`` under ``sf_dir``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that every executor can reach: the session's ``spark.checkpoint.dir``.

    Where that is unset and all runs in one process (tests), a temporary folder takes its place, remembered in the session. On a cluster it must be set.
    """
    found = spark.conf.get(CHECKPOINT_SETTING, None)
    if not found:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError(f"{CHECKPOINT_SETTING} must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="debtloom-")
        spark.conf.set(CHECKPOINT_SETTING, found)
    return found


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    where, fs = _file_system(spark, path)
    fs.deleteOnExit(where)
    return path


def _file_system(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark._jsc.hadoopConfiguration())


def settle(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    The lineage ends at files that outlive any executor; what follows reads columns, not a recomputation.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._settled_at = path
    return out


def forget(df: DataFrame) -> None:
    """Remove the files of a settled table that nothing reads any more, as the last round of a loop."""
    where, fs = _file_system(df.sparkSession, df._settled_at)
    fs.delete(where, True)
