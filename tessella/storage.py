"""Shared scratch storage: where lineage is cut so that a lost executor costs a re-read, not a recompute."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


_ROOTS: dict[str, str] = {}


def _filesystem(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir; a local one only in local mode where none is set (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError(f"{master}: set spark.checkpoint.dir to a folder that driver and executors share")
        named = "file://" + tempfile.mkdtemp(prefix="tessella-shared-")
        spark.sparkContext.setCheckpointDir(named)
    files, p = _filesystem(spark, named)
    full = files.makeQualified(p).toString().rstrip("/")
    return full.replace("file:/", "file:///", 1) if full.startswith("file:/") and not full.startswith("file://") else full


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path for one intermediate table or file set; all of an application's are deleted when it ends."""
    app = spark.sparkContext.applicationId
    if app not in _ROOTS:
        root = f"{shared_dir(spark)}/tessella-{uuid.uuid4().hex}"
        files, p = _filesystem(spark, root)
        files.mkdirs(p)
        files.deleteOnExit(p)
        _ROOTS[app] = root
    return f"{_ROOTS[app]}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: materialised once, lineage cut."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
