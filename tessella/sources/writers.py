"""Writers: fixed schemas, all-or-none table sets, swaps with recovery, partitions replaced as a whole."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm.org.apache.hadoop.fs.Path


def csv(df: DataFrame, path: str, columns: list[str]) -> None:
    """The columns of a fixed schema, others dropped, missing ones blank, lines ended by CRLF."""
    out = df.select(*[F.col(c).cast("string").alias(c) if c in df.columns else F.lit("").alias(c) for c in columns])
    out.write.mode("overwrite").option("lineSep", "\r\n").option("emptyValue", "").option("escape", '"').csv(path, header=True)


def exists(spark: SparkSession, path: str) -> bool:
    fs, p, _ = _fs(spark, path)
    return fs.exists(p)


def swap(spark: SparkSession, staging: str, target: str) -> None:
    """Put a finished folder in the place of another; the old one is set aside until the new one stands.

    What an interrupted swap has set aside is brought back first, never deleted while it is the only copy.
    """
    recover(spark, target)
    fs, s, path = _fs(spark, staging)
    t, old = path(target), path(target + ".old")
    if fs.exists(t) and not fs.rename(t, old):
        raise OSError(f"cannot set {target} aside")
    if not fs.rename(s, t):
        if fs.exists(old):
            fs.rename(old, t)
        raise OSError(f"cannot move {staging} to {target}")
    fs.delete(old, True)


def recover(spark: SparkSession, target: str) -> bool:
    """After an interruption: bring back the old folder if the target is gone. True if something was done."""
    fs, t, path = _fs(spark, target)
    old = path(target + ".old")
    if fs.exists(old):
        if fs.exists(t):
            return fs.delete(old, True)
        return fs.rename(old, t)
    return False


def tables(spark: SparkSession, parts: dict[str, DataFrame]) -> None:
    """Write several tables (path to DataFrame): all are staged before the first is swapped in, so a failure leaves none."""
    mark, staged = uuid.uuid4().hex, {}
    try:
        for path, df in parts.items():
            staged[path] = f"{path}.{mark}.part"
            df.write.parquet(staged[path])
    except Exception:
        for s in staged.values():
            fs, p, _ = _fs(spark, s)
            fs.delete(p, True)
        raise
    for path, s in staged.items():
        swap(spark, s, path)


def append(df: DataFrame, path: str, run_id: int) -> None:
    """Rows of one run, in a partition of their own."""
    df.withColumn("run_id", F.lit(run_id)).write.mode("append").partitionBy("run_id").parquet(path)


def replace(df: DataFrame, path: str, keys: list[str]) -> None:
    """Only the partitions that df has rows for are replaced."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*keys).parquet(path)


def report(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of a Markdown table, head first, as numbered lines."""
    line = F.concat(F.lit("| "), F.concat_ws(" | ", *[F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")) for c in columns]), F.lit(" |"))
    spark = rows.sparkSession
    head = spark.createDataFrame([(0, "| " + " | ".join(columns) + " |"), (1, "|" + " --- |" * len(columns))], "n int, line string")
    return head.unionByName(rows.select(F.lit(2).alias("n"), line.alias("line")))
