"""Queries that write, read back or parse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessella.plans.model import relation
from tessella.plans.registry import over, query
from tessella.sources import readers as R, writers as W
from tessella.storage import scratch
from tessella.streaming import events as S

_c = F.col


@query("SELECT slug, display_name, bu, '' AS nothing FROM {products}")
def f001_csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "csv")
    W.csv(relation(spark, sf_dir, "products"), path, ["slug", "display_name", "bu", "nothing"])
    return R.csv(spark, path)


@query("SELECT doc_id, md5(text) AS value FROM {documents}")
def f002_charset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relation(spark, sf_dir, "documents").select("doc_id", F.md5(R.decoded(_c("text").cast("binary"))).alias("value"))


@query("SELECT event_id, cast(json_extract_string(props, '$.k') AS string) AS value FROM {events}")
def f005_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    wrapped = F.concat(F.lit('{"result":{"product":'), _c("props"), F.lit("}}"))
    return relation(spark, sf_dir, "events").select("event_id", R.unwrapped(F.when(_c("event_id") % 2 == 0, wrapped).otherwise(_c("props")), "missing", "k").alias("value"))


over("f006_crawl", lambda v: R.crawled(v.select("slug", _c("okey").alias("pos"), F.when(_c("okey") % 3 == 0, F.lit(None)).otherwise(_c("okey") % 3 == 1).alias("visible"), _c("version").alias("name"), _c("topics").alias("versions"))), "versions", oracle="SELECT slug, arg_min(version, okey) FILTER (okey % 3 < 2) AS name, max(topics) AS versions FROM {versions} GROUP BY 1 HAVING bool_or(okey % 3 < 2)")
over("f007_sitemap", lambda p: p.select("page_id", F.explode(R.sitemap(F.concat(F.lit("<urlset><url><loc>"), _c("url"), F.lit("</loc><lastmod>2024-01-01</lastmod></url></urlset>")))).alias("e")).select("page_id", "e.loc", "e.lastmod"), "pages", oracle="SELECT page_id, url AS loc, '2024-01-01' AS lastmod FROM {pages}")
over("f008_incremental_walk", lambda f: R.changed(f.select(_c("path").alias("loc"), (_c("fid") % 3).cast("string").alias("lastmod")), f.where("fid % 5 <> 0").select(_c("path").alias("loc"), (_c("fid") % 4).cast("string").alias("lastmod")))[0], "files", oracle="SELECT path AS loc, cast(fid % 3 AS string) AS lastmod FROM {files} WHERE fid % 5 = 0 OR fid % 3 <> fid % 4")
over("f016_published_tree", lambda f: R.published(f.select(F.concat(F.lit("en-us/"), _c("slug"), F.lit("/guide/1-0/"), _c("path")).alias("path"))).groupBy("locale", "slug", "doc_class", "segment").agg(F.count("*").alias("n")), "files", oracle="SELECT 'en-us' AS locale, slug, 'guide' AS doc_class, '1-0' AS segment, count(*) AS n FROM {files} GROUP BY slug")
over("f018_js_table", lambda n: n.select("node", F.explode(R.toc(F.concat(F.lit("define({n:[{t:'"), _c("title"), F.lit("',h:'x.htm',n:[{t:'in',h:'y'},]}]});")), "define")).alias("e")).select("node", "e.*"), "nodes", oracle="SELECT node, 0 AS depth, title, 'x.htm' AS path FROM {nodes} UNION ALL SELECT node, 1, 'in', 'y' FROM {nodes}")
over("f019_html_toc", lambda p: p.select("page_id", F.explode(R.toc(F.concat(F.lit("<ul><li><a href='up.htm'>Up</a>"), "html"), "lists")).alias("e")).select("page_id", "e.*"), "pages", oracle=r"""SELECT page_id, 1 AS depth, trim(regexp_replace(unnest(regexp_extract_all(html, '(?is)<a\b[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 2)), '<[^>]*>', '', 'g')) AS title, unnest(regexp_extract_all(html, '(?is)<a\b[^>]*href="([^"]*)"[^>]*>(.*?)</a>', 1)) AS path FROM {pages} UNION ALL SELECT page_id, 0, 'Up', 'up.htm' FROM {pages}""")
over("f021_yaml_toc", lambda n: n.select("node", F.explode(R.toc(F.concat(F.lit("docs:\n- title: "), _c("title"), F.lit("\n  url: a.md\n  subfolderlist:\n  - title: in\n    url: b.md\n")), "yaml")).alias("e")).select("node", "e.*"), "nodes", oracle="SELECT node, 0 AS depth, title, 'a.md' AS path FROM {nodes} UNION ALL SELECT node, 1, 'in', 'b.md' FROM {nodes}")
over("f022_pdf_title", lambda f: f.select("fid", R.pdf_title(F.when(_c("fid") % 4 == 0, "Untitled").when(_c("fid") % 4 == 1, F.concat("brand", F.lit(".docx"))).otherwise(_c("brand"))).alias("title")), "files", oracle="SELECT fid, CASE WHEN fid % 4 > 1 THEN brand END AS title FROM {files}")
over("f025_redirect_map", lambda f: f.select("fid", F.explode(R.redirect_map(F.when(_c("fid") % 2 == 0, F.concat(F.lit('{"a":"'), _c("path"), F.lit('"}'))).otherwise(F.concat(F.lit('[{"from":"a","to":"'), _c("path"), F.lit('"}]'))))).alias("e")).select("fid", "e.*"), "files", oracle="SELECT fid, 'a' AS \"from\", path AS \"to\" FROM {files}")
over("f216_engine_detection", lambda f: R.engine(f.select("slug", F.when(_c("fid") % 97 == 0, F.lit("Data/Toc.js")).otherwise(_c("path")).alias("path"), F.when(_c("fid") % 11 == 0, F.lit("x WebWorks y")).otherwise(F.lit("")).alias("head"))), "files", oracle="SELECT slug, CASE WHEN bool_or(fid % 97 = 0) THEN 'flare' WHEN bool_or(fid % 11 = 0) THEN 'webworks' ELSE 'auto' END AS engine FROM {files} GROUP BY 1")
over("f035_markdown_report", lambda f: W.report(f.select("fid", "path"), ["fid", "path"]).select("line"), "files", oracle="SELECT '| fid | path |' AS line UNION ALL SELECT '| --- | --- |' UNION ALL SELECT '| ' || fid || ' | ' || path || ' |' FROM {files}")
over("f231_currency_keys", lambda f: S.stale_inputs(f.select("slug", _c("path").alias("version"), F.md5("brand").alias("digest")), f.where("fid % 3 <> 0").select("slug", _c("path").alias("version"), F.md5(F.when(_c("fid") % 5 == 0, "kind").otherwise(_c("brand"))).alias("digest"))).select("slug", "version"), "files", oracle="SELECT slug, path AS version FROM {files} WHERE fid % 3 = 0 OR fid % 5 = 0")


@query("SELECT slug, display_name FROM {products}")
def f027_table_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    base = scratch(spark, "set")
    products, versions = relation(spark, sf_dir, "products"), relation(spark, sf_dir, "versions")
    for _ in range(2):  # the second run swaps with the first one's tables
        W.tables(spark, {f"{base}/products": products, f"{base}/versions": versions})
    return spark.read.parquet(f"{base}/products").select("slug", "display_name")


@query("SELECT slug, version, stage, max(happened) FILTER (outcome = 'ok') AS ok_at, max(happened) FILTER (outcome = 'failed') AS failed_at FROM {stage_events} GROUP BY 1, 2, 3")
def f233_stream_stage_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stage log kept by a stream over files, merged batch by batch."""
    base = scratch(spark, "stream")
    events = relation(spark, sf_dir, "stage_events")
    events.repartition(3).write.parquet(f"{base}/in")
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(f"{base}/in")
    S.keep_current(spark, stream, f"{base}/log", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/log")
