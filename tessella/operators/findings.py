"""Runs, findings and stage events: filters, tallies, latest rows, retention."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F


def select_findings(findings: DataFrame, run_id: int, stage: str | None = None, severity: str | None = None, code: str | None = None, slug: str | None = None) -> DataFrame:
    """One run's findings under optional equalities, in order of id."""
    out = findings.where(F.col("run_id") == run_id)
    for column, value in (("stage", stage), ("severity", severity), ("code", code), ("slug", slug)):
        if value is not None:
            out = out.where(F.col(column) == value)
    return out.orderBy("id")


def severity_tally(findings: DataFrame) -> DataFrame:
    return findings.groupBy("run_id", "severity").agg(F.count("*").alias("rows"))


def occurrences() -> F.Column:
    """A row without a count, or with zero, is one occurrence."""
    return F.greatest(F.coalesce("n", F.lit(1)), F.lit(1))


def latest_counts(findings: DataFrame) -> DataFrame:
    """Per code, slug and version: the sum of the newest run's counts. The newest run travels as a maximum, not a sort."""
    newest = findings.groupBy("code", "slug", "version", "run_id").agg(F.sum(occurrences()).alias("total"))
    return newest.groupBy("code", "slug", "version").agg(F.max("run_id").alias("run_id"), F.max_by("total", "run_id").alias("total"))


def stage_rollup(findings: DataFrame) -> DataFrame:
    """Rows and occurrences by stage and code, with stage totals (null code)."""
    both = findings.rollup("stage", "code").agg(F.count("*").alias("rows"), F.sum(occurrences()).alias("occurrences"))
    return both.where("stage is not null")


def summary_line(findings: DataFrame) -> DataFrame:
    """One line a run, such as '3 errors, 12 warnings'; kinds without rows are left out."""
    counts = findings.groupBy("run_id").agg(*[F.count_if(F.col("severity") == s).alias(s) for s in ("error", "warning", "note")])
    parts = [F.when(F.col(s) > 0, F.concat(F.col(s).cast("string"), F.lit(f" {s}"), F.when(F.col(s) > 1, "s").otherwise(""))) for s in ("error", "warning", "note")]
    return counts.select("run_id", F.concat_ws(", ", *parts).alias("line"))


def recent_runs(runs: DataFrame, findings: DataFrame, limit: int = 10) -> DataFrame:
    """The newest runs with their number of findings; only the few runs meet the counts."""
    newest = runs.orderBy(F.desc("run_id")).limit(limit)
    counts = findings.groupBy("run_id").agg(F.count("*").alias("n_findings"))
    return newest.join(counts, "run_id", "left").withColumn("n_findings", F.coalesce("n_findings", F.lit(0)))


def last_run(runs: DataFrame) -> DataFrame:
    """The newest run of each command."""
    return runs.groupBy("command").agg(F.max("run_id").alias("run_id"), F.max_by("started_at", "run_id").alias("started_at"))


def run_dates(findings: DataFrame, runs: DataFrame) -> DataFrame:
    """When each version was last in a run of each command. Run ids kept as text are cast for the join."""
    metadata = findings.groupBy("slug", "version").agg(F.max("run_id").cast("string").alias("value"))
    return metadata.join(runs, F.col("value").try_cast("bigint") == F.col("run_id")).select("slug", "version", "command", "started_at")


def latest_per_key(events: DataFrame) -> DataFrame:
    """The newest event of each key; equal times are broken by id."""
    return events.groupBy("slug", "version").agg(F.max_by(F.struct("stage", "outcome", "event_id"), F.struct("happened", "event_id")).alias("e")).select("slug", "version", "e.*")


def last_by_outcome(events: DataFrame) -> DataFrame:
    return events.groupBy("slug", "version", "stage").agg(F.max(F.when(F.col("outcome") == "ok", F.col("happened"))).alias("ok_at"), F.max(F.when(F.col("outcome") == "failed", F.col("happened"))).alias("failed_at"))


def current_failures(events: DataFrame) -> DataFrame:
    """Stages whose last failure is not older than their last success."""
    return last_by_outcome(events).where("failed_at is not null and (ok_at is null or failed_at >= ok_at)").select("slug", "version", "stage")


STAGES = ["downloaded", "extracted", "converted", "merged", "synced"]


def version_status(events: DataFrame) -> DataFrame:
    """A failure of a later stage wins over the furthest stage reached."""
    rank = F.array_position(F.array(*map(F.lit, STAGES)), F.col("stage"))
    last = last_by_outcome(events).withColumn("rank", rank)
    failed = F.max(F.when(F.col("failed_at").isNotNull() & (F.col("ok_at").isNull() | (F.col("failed_at") >= F.col("ok_at"))), F.struct("rank", "stage")))
    reached = F.max(F.when(F.col("ok_at").isNotNull(), F.struct("rank", "stage")))
    out = last.groupBy("slug", "version").agg(failed.alias("f"), reached.alias("r"))
    status = F.when(F.col("f").isNotNull() & (F.col("r").isNull() | (F.col("f.rank") >= F.col("r.rank"))), F.concat(F.col("f.stage"), F.lit(" failed"))).otherwise(F.coalesce("r.stage", F.lit("catalogued")))
    return out.select("slug", "version", status.alias("status"))


def staleness(events: DataFrame, done: str, since: str) -> DataFrame:
    """Whether `done` happened before the last `since`."""
    last = events.where("outcome = 'ok'").groupBy("slug", "version").agg(F.max(F.when(F.col("stage") == done, F.col("happened"))).alias("d"), F.max(F.when(F.col("stage") == since, F.col("happened"))).alias("s"))
    return last.select("slug", "version", F.when(F.col("d").isNull(), "never").when(F.col("s") > F.col("d"), "stale").otherwise("current").alias("state"))


def prune(findings: DataFrame, keep: int, read_back: list[str]) -> DataFrame:
    """What stays: the newest `keep` runs that have findings, and each key's newest row for the codes that are read back."""
    runs = findings.select("run_id").distinct().orderBy(F.desc("run_id")).limit(keep)
    newest = findings.where(F.col("code").isin(read_back)).groupBy("code", "slug", "version").agg(F.max(F.struct("run_id", "id")).alias("k")).select(F.col("k.id").alias("id")).distinct()
    runs, newest = runs.withColumn("_run", F.lit(True)), newest.withColumn("_newest", F.lit(True))
    kept = findings.join(F.broadcast(runs), "run_id", "left").join(newest, "id", "left")  # at most `keep` runs
    return kept.where("_run or _newest").select(*findings.columns)


def fold_notes(findings: DataFrame) -> DataFrame:
    """Notes of one run, code, slug and version become one row with the sum; errors and warnings stay rows."""
    notes = findings.where("severity = 'note'").groupBy("run_id", "code", "slug", "version").agg(F.sum(occurrences()).alias("occurrences"), F.min_by("path", "id").alias("path"))
    others = findings.where("severity <> 'note'").select("run_id", "code", "slug", "version", occurrences().cast("long").alias("occurrences"), "path")
    return notes.unionByName(others)


def forget(table: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    return table.join(gone, keys, "left_anti")


def repair_census(pages: DataFrame, pattern: str, text: str = "html") -> DataFrame:
    """Pages that need a repair, and how often its pattern occurs."""
    return pages.select("page_id", F.regexp_count(text, F.lit(pattern)).alias("hits")).where("hits > 0")


def pending_repairs(counts: DataFrame) -> DataFrame:
    """A line a version, such as 'R001(14) R002(3)', in order of the repair."""
    return counts.groupBy("slug").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("repair", "hits"))), lambda r: F.concat(r["repair"], F.lit("("), r["hits"].cast("string"), F.lit(")"))), " ").alias("pending"))


def lowest_scores(rows: DataFrame, score: str, ties: str, limit: int = 40) -> DataFrame:
    return rows.orderBy(score, ties).limit(limit)


def even_sample(rows: DataFrame, order: str, size: int) -> DataFrame:
    """`size` rows evenly spread over an order of distinct values, all if there are fewer.

    Positions come from range partitions and their sizes; no window runs over the whole table.
    """
    total = rows.count()
    if total <= size:
        return rows
    parts = rows.repartitionByRange(F.col(order)).sortWithinPartitions(order).withColumn("_p", F.spark_partition_id())
    parts = parts.withColumn("_n", F.row_number().over(Window.partitionBy("_p").orderBy(order)))
    sizes = parts.groupBy("_p").agg(F.count("*").alias("_c"), F.min(order).alias("_o"))
    before = sizes.select("_p", F.coalesce(F.sum("_c").over(Window.orderBy("_o").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_b"))  # a row a partition
    at = parts.join(F.broadcast(before), "_p").withColumn("_at", F.col("_b") + F.col("_n") - 1)
    return at.where(F.floor((F.col("_at") + 1) * size / F.lit(total)) > F.floor(F.col("_at") * size / F.lit(total))).drop("_p", "_n", "_b", "_at")


def seeded_sample(rows: DataFrame, key: str, seed: int, size: int) -> DataFrame:
    """The `size` rows of least digest of seed and key: the same rows for the same seed, whatever the partitioning or engine."""
    return rows.orderBy(F.md5(F.concat(F.lit(f"{seed}|"), F.col(key).cast("string"))), key).limit(size)
