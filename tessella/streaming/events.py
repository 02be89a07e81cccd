"""Stage events as a stream: the last success and failure of each stage, kept current."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from tessella.sources.writers import exists, recover, swap


def stage_log(events: DataFrame) -> DataFrame:
    """slug, version, stage with the times of the last ok and failed event; for batch and for streams in update mode."""
    at = lambda o: F.max(F.when(F.col("outcome") == o, F.col("happened"))).alias(f"{o}_at")
    return events.groupBy("slug", "version", "stage").agg(at("ok"), at("failed"))


def first_seen(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """Each event id once; state is dropped when the watermark has passed."""
    return events.withWatermark("happened", late).dropDuplicatesWithinWatermark(["event_id"])


def windowed(events: DataFrame, late: str = "10 minutes", width: str = "1 hour") -> DataFrame:
    return events.withWatermark("happened", late).groupBy(F.window("happened", width).alias("w"), "stage", "outcome").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "stage", "outcome", "n")


def keep_current(spark: SparkSession, events: DataFrame, target: str, checkpoint: str) -> StreamingQuery:
    """Merge each micro-batch into a Parquet table by key. A batch that is run again changes nothing.

    A merge that was interrupted between its two renames is undone first; only a table that isn't there is taken for the
    first batch, any other failure ends the query.
    """

    def merge(batch: DataFrame, number: int) -> None:
        new = stage_log(batch)
        recover(spark, target)
        if exists(spark, target):
            both = spark.read.parquet(target).unionByName(new)
            new = both.groupBy("slug", "version", "stage").agg(F.max("ok_at").alias("ok_at"), F.max("failed_at").alias("failed_at"))
        part = f"{target}.{number}.part"
        new.write.mode("overwrite").parquet(part)
        swap(spark, part, target)

    return events.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stale_inputs(inputs: DataFrame, done: DataFrame) -> DataFrame:
    """What must run again: inputs whose digest isn't the one that was last done. Both: slug, version, digest."""
    return inputs.join(done, ["slug", "version", "digest"], "left_anti")
