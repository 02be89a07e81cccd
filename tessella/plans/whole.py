"""Operators whose queries build their input first: every row of the main relation takes part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessella.functions import paths as P
from tessella.operators import documents as D, links as L
from tessella.operators import rules as U
from tessella.plans.model import relation
from tessella.plans.registry import over, query
from tessella.sources import readers as R, writers as W
from tessella.storage import scratch

_c = F.col


@query("SELECT id, run_id FROM {findings}")
def f032_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One append for each run, as runs end one by one."""
    path, findings = scratch(spark, "runs"), relation(spark, sf_dir, "findings")
    for row in relation(spark, sf_dir, "runs").select("run_id").orderBy("run_id").collect():
        W.append(findings.where(_c("run_id") == row["run_id"]).drop("run_id"), path, row["run_id"])
    return spark.read.parquet(path).select("id", _c("run_id").cast("long").alias("run_id"))


over("f262_rename_rows", lambda f: U.rename_rows(f.select(F.concat(F.lit("new/"), "path").alias("page"), _c("brand").alias("trail"), F.when(_c("fid") % 3 == 0, F.repeat(F.lit("word "), F.lit(12))).otherwise(_c("brand")).alias("full")), f.select(F.concat(F.lit("new/"), "path").alias("page"), _c("path").alias("source"))).orderBy("source"), "files", oracle="SELECT path AS source, 'new/' || path AS page, brand AS trail, fid % 3 = 0 AS cut FROM {files}")
over("f076_longest_suffix", lambda f: L.longest_suffix(f.select((_c("fid") + 1).alias("uid"), F.concat(F.lit("x/y/"), _c("path")).alias("path")), f), "files", oracle="WITH t AS (SELECT fid, string_split(path, '/') AS p FROM {files}), k AS (SELECT fid, n, array_to_string(p[len(p)-n+1:], '/') AS tail FROM (SELECT fid, p, unnest(range(1, len(p) + 1)) AS n FROM t) x), u AS (SELECT fid + 1 AS uid, string_split('x/y/' || path, '/') AS p FROM {files}), m AS (SELECT uid, n, array_to_string(p[len(p)-n+1:], '/') AS tail FROM (SELECT uid, p, unnest(range(1, len(p) + 1)) AS n FROM u) x), j AS (SELECT uid, m.n, fid FROM m JOIN k USING (tail)), b AS (SELECT uid, max(n) AS shared FROM j GROUP BY 1) SELECT uid, shared, min(fid) AS fid FROM j JOIN b USING (uid) WHERE n = shared GROUP BY 1, 2")
over("f073_version_suffix", lambda v: L.suffix_versions(v.select(F.when(_c("okey") % 5 == 0, _c("version")).otherwise(F.concat(F.lit("guide-"), _c("version"))).alias("stem")), v.select("version")), "versions", oracle="SELECT version, CASE WHEN okey % 5 = 0 THEN version WHEN okey % 17 <> 0 THEN 'guide-' || version END AS stem FROM {versions}")
over("f069_origin_rows", lambda f: f.select(_c("path").alias("source"), F.when(_c("fid") % 3 == 0, F.concat(F.lit("moved/"), _c("path"))).alias("m")).select(F.concat(F.lit("/old/"), "source").alias("from"), F.coalesce("m", P.to_markdown(_c("source"))).alias("to"), F.lit(301).alias("status")), "files", oracle=r"""SELECT '/old/' || path AS "from", CASE WHEN fid % 3 = 0 THEN 'moved/' || path ELSE regexp_replace(path, '\.x?html?$', '.md', 'i') END AS "to", 301 AS status FROM {files}""")
over("f020_help_map", lambda i: i.groupBy("slug", "release").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("ident", "target"))), lambda e: F.concat(F.lit('<Map Name="'), e["ident"], F.lit('" Link="'), e["target"], F.lit('#a"/>'))), "").alias("x")).select("slug", "release", F.explode(R.help_map(_c("x"))).alias("e")).select("slug", "release", "e.*"), "ids", oracle="SELECT slug, release, ident, target AS link, 'a' AS anchor FROM {ids}")


@query()
def f196_markdown_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of whole texts; tests hold them against a parser of their own."""
    return relation(spark, sf_dir, "documents").select("doc_id", F.posexplode(D.markdown_blocks(_c("text"))).alias("pos", "block"))


@query("SELECT 'n_nationkey=' || n_nationkey AS folder, length(n_name) + 1 AS bytes FROM {nation}")
def f014_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tree of one file of known size for each nation, listed."""
    path = scratch(spark, "listing")
    relation(spark, sf_dir, "nation").select("n_nationkey", "n_name").repartition(1).write.partitionBy("n_nationkey").text(path)
    return R.listing(spark, path).select(P.parent(_c("path")).alias("folder"), "bytes")
