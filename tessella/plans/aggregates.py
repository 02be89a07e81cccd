"""Queries over runs, findings and stage events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessella.operators import findings as O
from tessella.operators import rules as U
from tessella.plans.model import relation
from tessella.plans.registry import over, query
from tessella.sources import readers as R

_c = F.col
_occ = "greatest(coalesce(n, 1), 1)"
_last = "SELECT slug, version, stage, max(happened) FILTER (outcome = 'ok') AS ok_at, max(happened) FILTER (outcome = 'failed') AS failed_at FROM {stage_events} GROUP BY 1, 2, 3"

over("f040_findings_filter", O.select_findings, "findings", run_id=5, severity="error", stage="convert", oracle="SELECT * FROM {findings} WHERE run_id = 5 AND severity = 'error' AND stage = 'convert'")
over("f097_severity_tally", O.severity_tally, "findings", oracle="SELECT run_id, severity, count(*) AS rows FROM {findings} GROUP BY 1, 2")
over("f098_latest_counts", O.latest_counts, "findings", oracle=f"SELECT code, slug, version, run_id, sum({_occ}) AS total FROM (SELECT *, max(run_id) OVER (PARTITION BY code, slug, version) AS m FROM {{findings}}) t WHERE run_id = m GROUP BY 1, 2, 3, 4")
over("f099_stage_rollup", O.stage_rollup, "findings", oracle=f"SELECT stage, code, count(*) AS rows, sum({_occ}) AS occurrences FROM {{findings}} GROUP BY GROUPING SETS ((stage, code), (stage))")
over("f100_summary_line", O.summary_line, "findings", oracle="SELECT run_id, concat_ws(', ', CASE WHEN e > 0 THEN e || ' error' || CASE WHEN e > 1 THEN 's' ELSE '' END END, CASE WHEN w > 0 THEN w || ' warning' || CASE WHEN w > 1 THEN 's' ELSE '' END END, CASE WHEN n > 0 THEN n || ' note' || CASE WHEN n > 1 THEN 's' ELSE '' END END) AS line FROM (SELECT run_id, count(*) FILTER (severity = 'error') AS e, count(*) FILTER (severity = 'warning') AS w, count(*) FILTER (severity = 'note') AS n FROM {findings} GROUP BY 1) t")
over("f065_recent_runs", O.recent_runs, "runs", "findings", oracle="SELECT r.*, (SELECT count(*) FROM {findings} f WHERE f.run_id = r.run_id) AS n_findings FROM {runs} r ORDER BY run_id DESC LIMIT 10")
over("f138_last_run", O.last_run, "runs", oracle="SELECT command, max(run_id) AS run_id, arg_max(started_at, run_id) AS started_at FROM {runs} GROUP BY 1")
over("f063_run_dates", O.run_dates, "findings", "runs", oracle="SELECT slug, version, command, started_at FROM (SELECT slug, version, max(run_id) AS run_id FROM {findings} GROUP BY 1, 2) t JOIN {runs} USING (run_id)")
over("f064_latest_per_key", O.latest_per_key, "stage_events", oracle="SELECT slug, version, stage, outcome, event_id FROM (SELECT *, row_number() OVER (PARTITION BY slug, version ORDER BY happened DESC, event_id DESC) AS r FROM {stage_events}) t WHERE r = 1")
over("f233_stage_log", O.last_by_outcome, "stage_events", oracle=_last)
over("f131_current_failures", O.current_failures, "stage_events", oracle=f"SELECT slug, version, stage FROM ({_last}) t WHERE failed_at IS NOT NULL AND (ok_at IS NULL OR failed_at >= ok_at)")
over("f130_version_status", O.version_status, "stage_events", oracle=f"WITH l AS (SELECT *, list_position(['downloaded', 'extracted', 'converted', 'merged', 'synced'], stage) AS k FROM ({_last}) t), g AS (SELECT slug, version, max(k) FILTER (failed_at IS NOT NULL AND (ok_at IS NULL OR failed_at >= ok_at)) AS f, max(k) FILTER (ok_at IS NOT NULL) AS r FROM l GROUP BY 1, 2) SELECT slug, version, CASE WHEN f IS NOT NULL AND (r IS NULL OR f >= r) THEN ['downloaded', 'extracted', 'converted', 'merged', 'synced'][f] || ' failed' ELSE coalesce(['downloaded', 'extracted', 'converted', 'merged', 'synced'][r], 'catalogued') END AS status FROM g")
_stale = "WITH l AS (SELECT slug, version, max(happened) FILTER (stage = '{0}') AS d, max(happened) FILTER (stage = '{1}') AS s FROM {{stage_events}} WHERE outcome = 'ok' GROUP BY 1, 2) SELECT slug, version, CASE WHEN d IS NULL THEN 'never' WHEN s > d THEN 'stale' ELSE 'current' END AS state FROM l"
over("f132_verify_staleness", O.staleness, "stage_events", done="converted", since="merged", oracle=_stale.format("converted", "merged"))
over("f133_sync_status", O.staleness, "stage_events", done="synced", since="converted", oracle=_stale.format("synced", "converted"))
over("f034_prune", lambda f: O.prune(f, 5, ["C1", "C2"]).select("id", "run_id"), "findings", oracle="SELECT id, run_id FROM {findings} f WHERE run_id IN (SELECT DISTINCT run_id FROM {findings} ORDER BY run_id DESC LIMIT 5) OR id IN (SELECT id FROM (SELECT id, row_number() OVER (PARTITION BY code, slug, version ORDER BY run_id DESC, id DESC) AS r FROM {findings} WHERE code IN ('C1', 'C2')) t WHERE r = 1)")
over("f234_fold_notes", O.fold_notes, "findings", oracle=f"SELECT run_id, code, slug, version, sum({_occ}) AS occurrences, arg_min(path, id) AS path FROM {{findings}} WHERE severity = 'note' GROUP BY 1, 2, 3, 4 UNION ALL SELECT run_id, code, slug, version, {_occ}, path FROM {{findings}} WHERE severity <> 'note'")
over("f118_repair_census", O.repair_census, "pages", pattern="<br>", oracle="SELECT page_id, len(regexp_extract_all(html, '<br>')) AS hits FROM {pages} WHERE contains(html, '<br>')")
over("f115_outcome_counts", lambda e: U.outcome_counts(e, "stage", "outcome"), "stage_events", oracle="SELECT stage, outcome, count(*) AS n FROM {stage_events} GROUP BY 1, 2")
over("f116_flag_medians", lambda f: U.page_medians(f.select(_c("slug").alias("page"), "words", _c("code").alias("branch"))), "findings", oracle="SELECT slug AS page, floor(quantile_cont(words, 0.5))::bigint AS median_words, count(*) AS topics, count(DISTINCT code) AS branches FROM {findings} GROUP BY 1")
over("f117_flag_tally", lambda f: U.tally(U.flagged(f, {"long": _c("words") > 50000, "uncounted": _c("n").isNull(), "broken": _c("severity") == "error", "never": _c("words") < 0}), ["long", "uncounted", "broken", "never"]), "findings", oracle="SELECT 0 AS rank, 'long' AS flag, count(*) FILTER (words > 50000) AS n FROM {findings} UNION ALL SELECT 1, 'uncounted', count(*) FILTER (n IS NULL) FROM {findings} UNION ALL SELECT 2, 'broken', count(*) FILTER (severity = 'error') FROM {findings} UNION ALL SELECT 3, 'never', 0")
over("f141_lowest_scores", lambda f: O.lowest_scores(f.select("id", "words"), "words", "id"), "findings", oracle="SELECT id, words FROM {findings} ORDER BY words, id LIMIT 40")
over("f139_even_sample", lambda v: O.even_sample(v.select("okey"), "okey", 100), "versions", oracle="SELECT okey FROM (SELECT okey, row_number() OVER (ORDER BY okey) - 1 AS i, count(*) OVER () AS c FROM {versions}) t WHERE floor((i + 1) * 100 / c::double) > floor(i * 100 / c::double)")
over("f140_seeded_sample", lambda v: O.seeded_sample(v.select("okey"), "okey", 7, 50), "versions", oracle="SELECT okey FROM {versions} ORDER BY md5('7|' || okey), okey LIMIT 50")
over("f096_pivot_sum", lambda f: U.pivot_sum(f.withColumn("kind", F.split_part("kind", F.lit(" "), F.lit(1))), ["slug"], "kind", "bytes", ["economy", "standard", "none"]), "files", oracle="SELECT slug, sum(CASE WHEN split_part(kind, ' ', 1) = 'economy' THEN bytes ELSE 0 END)::bigint AS economy, sum(CASE WHEN split_part(kind, ' ', 1) = 'standard' THEN bytes ELSE 0 END)::bigint AS standard, 0::bigint AS none FROM {files} GROUP BY 1")
over("f108_inventory_buckets", lambda f: U.buckets(f.withColumn("root", F.split_part("path", F.lit("/"), F.lit(1))), ["root", "kind"]), "files", oracle="SELECT split_part(path, '/', 1) AS root, kind, count(*) AS files, sum(bytes)::bigint AS bytes FROM {files} GROUP BY 1, 2")
over("f110_tree_measure", U.measure, "files", oracle="SELECT count(*) AS files, sum(bytes)::bigint AS bytes FROM {files}")
over("f107_published_counts", lambda f: U.published_counts(R.published(f.select(F.concat(F.lit("en-us/"), _c("slug"), F.lit("/guide/"), F.replace("path", F.lit("guide"), F.lit("v"))).alias("path")))), "files", oracle="SELECT slug, count(DISTINCT split_part(path, '/', 1)) AS folders FROM {files} GROUP BY 1")
over("f114_extraction_totals", U.extraction_totals, "versions", oracle="SELECT count(topics) AS measured, sum(topics)::bigint AS topics, count(*) FILTER (topics = 0) AS empty FROM {versions}")
over("f120_word_conservation", lambda f: U.conserved(f.select(_c("slug").alias("page"), "words", F.when(_c("severity") == "note", 2).alias("added")), f.groupBy(_c("slug").alias("page")).agg(F.sum("words").alias("words"))), "findings", oracle="SELECT slug AS page, 2 * count(*) FILTER (severity = 'note') AS lost FROM {findings} GROUP BY 1 HAVING count(*) FILTER (severity = 'note') > 0")


@query("WITH c AS (SELECT slug, 'R00' || cast(run_id % 3 AS string) AS repair, count(*) AS hits FROM {findings} GROUP BY 1, 2) SELECT slug, string_agg(repair || '(' || hits || ')', ' ' ORDER BY repair) AS pending FROM c GROUP BY 1")
def f119_pending_repairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = relation(spark, sf_dir, "findings").groupBy("slug", F.concat(F.lit("R00"), (F.col("run_id") % 3).cast("string")).alias("repair")).agg(F.count("*").alias("hits"))
    return O.pending_repairs(counts)


@query("SELECT id FROM {findings} WHERE slug NOT IN (SELECT slug FROM {stage_events} WHERE slug LIKE 'p1%')")
def f033_cascade_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.forget(relation(spark, sf_dir, "findings"), relation(spark, sf_dir, "stage_events").where("slug like 'p1%'").select("slug").distinct(), ["slug"]).select("id")


@query("SELECT stage, code, rows, occurrences FROM (SELECT stage, code, count(*) AS rows, sum(greatest(coalesce(n, 1), 1)) AS occurrences FROM {findings} GROUP BY 1, 2) t")
def f036_report_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    return O.stage_rollup(relation(spark, sf_dir, "findings")).where("code is not null")
