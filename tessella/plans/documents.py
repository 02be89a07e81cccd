"""Queries over documents and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessella.functions import text as X
from tessella.operators import documents as D
from tessella.operators import rules as U
from tessella.plans.model import relation
from tessella.plans.registry import over, query

_c = F.col
_words = r"regexp_extract_all({0}, '[a-z0-9]+(?:[''.\-_/][a-z0-9]+)*')"


@query("WITH t AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS title, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM {documents}), b AS (SELECT doc_id, pos, regexp_replace(regexp_replace(trim(lower(regexp_replace(regexp_replace(title, '<[^>]*>', '', 'g'), '[*`\\[\\]]', '', 'g'))), '[^a-z0-9_ \\-]', '', 'g'), ' +', '-', 'g') AS base FROM t), n AS (SELECT *, row_number() OVER (PARTITION BY doc_id, base ORDER BY pos) - 1 AS n FROM b) SELECT doc_id, pos, CASE WHEN base = '' THEN '' WHEN n = 0 THEN base ELSE base || '-' || n END AS anchor FROM n")
def f208_heading_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = relation(spark, sf_dir, "documents")
    titles = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "title"))
    return D.heading_anchors(docs, "doc_id", titles)


QUERY_124 = "f124_ordinal_suffix"
over(QUERY_124, lambda f: D.heading_anchors(f, "slug", f.select("slug", _c("fid").alias("pos"), _c("brand").alias("title"))), "files", oracle="WITH n AS (SELECT slug, fid AS pos, replace(lower(brand), '#', '') AS base FROM {files}), r AS (SELECT *, row_number() OVER (PARTITION BY slug, base ORDER BY pos) - 1 AS n FROM n) SELECT slug, pos, CASE WHEN n = 0 THEN base ELSE base || '-' || n END AS anchor FROM r")
over("f264_maximal_runs", lambda f: D.maximal_runs(f, "slug", "fid", _c("bytes") > 15000), "files", oracle="WITH n AS (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY fid) AS i FROM {files}), h AS (SELECT *, i - row_number() OVER (PARTITION BY slug ORDER BY fid) AS g FROM n WHERE bytes > 15000) SELECT slug, min(fid) AS first, max(fid) AS last, count(*) AS length FROM h GROUP BY slug, g")
over("f276_byte_copies", lambda d: D.byte_copies(d.select(_c("doc_id").alias("book"), F.sha2("text", 256).alias("digest"))), "documents", oracle="SELECT doc_id AS book, kept FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY text) AS kept FROM {documents}) t WHERE doc_id <> kept")
over("f147_sibling_duplicates", lambda d: D.sibling_duplicates(d.select(_c("source").alias("folder"), F.split_part("text", F.lit("."), F.lit(1)).alias("title"), _c("doc_id").alias("page"), _c("text").alias("body"))), "documents", oracle="SELECT source AS folder, split_part(text, '.', 1) AS title, count(DISTINCT doc_id) AS pages FROM {documents} GROUP BY 1, 2 HAVING count(DISTINCT doc_id) > 1 AND count(DISTINCT text) = 1")
over("f081_images_missing", lambda d: D.images_missing(d.select(_c("doc_id").alias("page"), F.sha2("text", 256).alias("digest")), d.where("doc_id % 3 = 0").select(F.sha2("text", 256).alias("digest"))).select("page"), "documents", oracle="SELECT doc_id AS page FROM {documents} WHERE text NOT IN (SELECT text FROM {documents} WHERE doc_id % 3 = 0)")
over("f255_document_check", lambda f: D.check_document(f.where("fid % 5 <> 0").select(_c("path").alias("name"), F.md5("brand").alias("digest")), f.where("fid % 7 <> 0").select(_c("path").alias("name"), F.md5(F.when(_c("fid") % 3 == 0, "kind").otherwise(_c("brand"))).alias("digest"))), "files", oracle="SELECT path AS name, CASE WHEN fid % 7 = 0 THEN 'missing' WHEN fid % 5 = 0 THEN 'extra' ELSE 'changed' END AS verdict FROM {files} WHERE NOT (fid % 7 = 0 AND fid % 5 = 0) AND (fid % 7 = 0 OR fid % 5 = 0 OR fid % 3 = 0)")
over("f272_anchor_pruning", lambda f: D.anchors_kept(f.select(_c("slug").alias("page"), _c("brand").alias("anchor")).distinct(), f.where("fid % 9 = 0").select(_c("slug").alias("page"), F.upper("brand").alias("anchor"))), "files", oracle="SELECT DISTINCT slug AS page, brand AS anchor FROM {files} f WHERE EXISTS (SELECT 1 FROM {files} g WHERE g.fid % 9 = 0 AND g.slug = f.slug AND g.brand = f.brand)")
over("f145_intersect_shingles", lambda d: d.select("doc_id", X.words(F.lower("text")).alias("w")).select("doc_id", F.size(F.array_intersect(F.slice("w", F.lit(1), F.floor(F.size("w") / 2).cast("int")), F.slice("w", F.floor(F.size("w") / 2).cast("int") + 1, F.size("w")))).alias("shared")), "documents", oracle=f"SELECT doc_id, len(list_intersect(w[1:cast(floor(len(w) / 2) AS int)], w[cast(floor(len(w) / 2) AS int) + 1:])) AS shared FROM (SELECT doc_id, {_words.format('lower(text)')} AS w FROM {{documents}}) t")
over("f258_distinct_urls", lambda p: U.external_urls(p.select(_c("page_id").alias("page"), F.concat(F.lit("[a]("), "url", F.lit(") [b](http://x/"), (_c("page_id") % 7).cast("string"), F.lit(") [c](local.md) `[d](http://no)`")).alias("text"))), "pages", oracle="SELECT url, count(DISTINCT page_id) AS pages FROM (SELECT page_id, url FROM {pages} UNION ALL SELECT page_id, 'http://x/' || (page_id % 7) FROM {pages}) t GROUP BY 1")
over("f265_code_runs", lambda d: D.maximal_runs(d.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line")), "doc_id", "pos", F.length("line") > 60), "documents", oracle="WITH l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos FROM {documents}), h AS (SELECT *, pos - row_number() OVER (PARTITION BY doc_id ORDER BY pos) AS g FROM l WHERE length(line) > 60) SELECT doc_id, min(pos) AS first, max(pos) AS last, count(*) AS length FROM h GROUP BY doc_id, g")
