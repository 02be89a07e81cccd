"""Queries over typed scans, declarations and published trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.functions.values import natural_key
from tessella.operators import checks as K
from tessella.operators import rules as U
from tessella.plans.registry import over, scalar

_c = F.col

over("f003_typed_scan", lambda c: K.typed(c.withColumn("key", _c("k") % 4000)), "cells", oracle="WITH l AS (SELECT k % 4000 AS key, max(k) AS k, count(*) > 1 AS repeated FROM {cells} GROUP BY 1) SELECT key, coalesce(CASE lower(trim(bool_cell)) WHEN 'true' THEN true WHEN 't' THEN true WHEN 'y' THEN true END, false) AS archived, CASE WHEN try_cast(replace(trim(count_cell), ',', '') AS double) >= 0 AND try_cast(replace(trim(count_cell), ',', '') AS double) % 1 = 0 THEN cast(try_cast(replace(trim(count_cell), ',', '') AS double) AS int) END AS topics, CASE WHEN lower(status_cell) IN ('o', 'f') THEN lower(status_cell) ELSE 'unknown' END AS status, repeated FROM l JOIN {cells} USING (k)")
over("f010_end_of_support", lambda p, v: K.end_of_support(v.select(F.concat(F.lit("Name "), "slug").alias("name"), F.substring("version", 1, 2).alias("version"), _c("release_status").alias("status")), p.where("custom_override").select(F.concat(F.lit("Name "), "slug").alias("name"), "slug")), "products", "versions", oracle="WITH r AS (SELECT CASE WHEN p.custom_override THEN v.slug ELSE 'name-' || v.slug END AS slug, substr(version, 1, 2) AS version, release_status AS status FROM {versions} v JOIN {products} p USING (slug)) SELECT slug, version, CASE WHEN count(DISTINCT status) > 1 THEN 'conflict' ELSE max(status) END AS status FROM r GROUP BY 1, 2")
scalar("f011_sheet_slug", "versions", "okey", lambda: K.sheet_slug(F.concat(F.lit("http://h/docs/"), "slug", F.when(_c("okey") % 2 == 0, F.concat(F.lit("-"), F.replace("version", F.lit("."), F.lit("-")))).otherwise(""), F.lit("/")), _c("version")), "slug")
over("f028_catalog_order", lambda v: v.orderBy("slug", natural_key(_c("version")).desc()).select("slug", "version", "release_date"), "versions", oracle="SELECT slug, version, release_date FROM {versions}")
over("f066_evidence", lambda v, e: K.evidence(v.where("okey % 3 = 0").select("slug", "version", (_c("okey") % 2 == 0).alias("downloaded")), v.where("okey % 4 = 0")), "versions", "stage_events", oracle="SELECT slug, version, okey % 3 = 0 AND okey % 2 = 0 AS downloaded, okey % 4 = 0 AS converted FROM {versions} WHERE okey % 3 = 0 OR okey % 4 = 0")
over("f067_locale_overlay", lambda e: K.overlay(e.where("version = '0'"), e.where("version = '1'"), ["downloaded", "extracted"]).select("event_id"), "stage_events", oracle="SELECT event_id FROM {stage_events} WHERE (version = '0') = (stage IN ('downloaded', 'extracted'))")
over("f070_template_derivation", lambda f: K.derive_template(f.select(_c("fid").alias("sid"), "path"), f.where("fid % 10 < 9").select(F.concat(F.lit("old/docs/"), F.regexp_replace("path", "^[^/]*/", "")).alias("url"))).where("enough").select("drop", "prefix", "hits"), "files", oracle="WITH s AS (SELECT fid, string_split(path, '/') AS p FROM {files}), t AS (SELECT fid, k AS drop, array_to_string(p[k + 1:], '/') AS tail FROM (SELECT fid, p, unnest(range(0, least(len(p) - 1, 3) + 1)) AS k FROM s) x), u AS (SELECT string_split('old/docs/' || regexp_replace(path, '^[^/]*/', ''), '/') AS u FROM {files} WHERE fid % 10 < 9), e AS (SELECT DISTINCT array_to_string(u[1:k], '/') AS prefix, array_to_string(u[k + 1:], '/') AS tail FROM (SELECT u, unnest(range(0, len(u))) AS k FROM u) x), h AS (SELECT drop, prefix, count(DISTINCT fid) AS hits FROM t JOIN e USING (tail) GROUP BY 1, 2) SELECT cast(drop AS int) AS drop, prefix, hits FROM h WHERE hits >= 0.9 * (SELECT count(*) FROM {files})")
over("f083_anchor_misses", lambda f: K.anchor_misses(f.select(_c("fid").alias("lid"), _c("slug").alias("page"), F.when(_c("fid") % 3 == 0, F.upper("brand")).when(_c("fid") % 3 == 1, F.lit("none")).otherwise(_c("brand")).alias("anchor")), f.select(_c("slug").alias("page"), _c("brand").alias("anchor"))), "files", oracle="SELECT fid AS lid, CASE WHEN fid % 3 = 0 THEN brand END AS near FROM {files} WHERE fid % 3 < 2")
over("f089_owned_merge", lambda n: K.owned_merge(n.select(_c("node").alias("key"), "pos"), n.where("words between 20 and 25").select((_c("node") + 1000000).alias("key"), _c("pos").alias("n")), n.where("words > 45").select(_c("node").alias("key"))), "nodes", oracle="SELECT node AS key, CASE WHEN pos < (SELECT min(pos) FROM {nodes} WHERE words > 45) THEN 0 ELSE 2 END AS side, pos AS place FROM {nodes} WHERE words <= 45 UNION ALL SELECT node + 1000000, 1, pos FROM {nodes} WHERE words BETWEEN 20 AND 25")
over("f091_secondary_copies", lambda f: K.secondary_copies(f.withColumn("path", F.concat("kind", F.lit("/"), "brand")), f.where("fid % 4 = 0").select("fid")), "files", oracle="SELECT f.fid, t.twin FROM {files} f JOIN (SELECT brand, min(fid) AS twin FROM {files} WHERE fid % 4 = 0 GROUP BY 1) t USING (brand) WHERE fid % 4 <> 0")
over("f093_inbound_orphans", lambda l, f: K.inbound(l, f, _c("fid") % 3 != 0), "links", "files", oracle="SELECT lid, src, fid FROM {links} WHERE src % 3 <> 0 AND fid % 3 = 0 AND src IN (SELECT fid FROM {files})")
over("f121_layout_audit", lambda f: K.layout_audit(f.where("fid % 7 <> 0").select(_c("slug").alias("page"), _c("brand").alias("topic")).unionByName(f.where("fid < 3").select(_c("slug").alias("page"), F.concat(F.lit("x"), _c("fid").cast("string")).alias("topic"))), f.select(_c("brand").alias("topic")).distinct().unionByName(f.where("fid = 0").select(F.lit("never").alias("topic")))), "files", oracle="SELECT brand AS topic, 'repeated' AS fault FROM {files} WHERE fid % 7 <> 0 GROUP BY 1 HAVING count(DISTINCT slug) > 1 UNION ALL SELECT 'x' || fid, 'unknown' FROM {files} WHERE fid < 3 UNION ALL SELECT 'never', 'lost'")
over("f134_natural_order", lambda v: v.groupBy("slug").agg(F.max_by("version", F.struct(natural_key(_c("version")), "version")).alias("newest")), "versions", oracle=r"SELECT slug, newest FROM (SELECT slug, version AS newest, row_number() OVER (PARTITION BY slug ORDER BY regexp_matches(version, '^\d'), CASE WHEN regexp_matches(version, '^\d') THEN 0 END, [cast(p AS bigint) FOR p IN regexp_extract_all(version, '\d+')] DESC) AS r FROM {versions}) t WHERE r = 1")
over("f136_document_order", lambda f: U.document_order(f.select("fid", "slug", F.split_part("kind", F.lit(" "), F.lit(1)).alias("kind"), _c("brand").alias("title"), _c("path").alias("name")), "slug", ["economy", "small"]).select("fid", "place"), "files", oracle="SELECT fid, row_number() OVER (PARTITION BY slug ORDER BY CASE split_part(kind, ' ', 1) WHEN 'economy' THEN 1 WHEN 'small' THEN 2 ELSE 3 END, lower(brand), lower(path)) AS place FROM {files}")
over("f142_ordered_union", lambda n: U.in_order(n.where("words <= 10").select("node"), n.where("words > 10 and words <= 25").select("node"), n.where("words > 25").select("node")).orderBy("side", "node"), "nodes", oracle="SELECT node, CASE WHEN words <= 10 THEN 0 WHEN words <= 25 THEN 1 ELSE 2 END AS side FROM {nodes} ORDER BY side, node")
over("f212_merged_page", lambda n: K.merged_page(n.select((_c("node") % 40).alias("page"), "pos", _c("title").alias("text")), "page"), "nodes", oracle="SELECT node % 40 AS page, string_agg(title, chr(10) || chr(10) ORDER BY pos) AS text FROM {nodes} GROUP BY 1")
over("f217_outermost_roots", lambda f: K.outermost(f.select(F.when(_c("fid") % 4 == 1, F.split_part("path", F.lit("/"), F.lit(1))).otherwise(F.regexp_replace("path", "/[^/]*$", "")).alias("root")).distinct()), "files", oracle="WITH r AS (SELECT DISTINCT CASE WHEN fid % 4 = 1 THEN split_part(path, '/', 1) ELSE regexp_replace(path, '/[^/]*$', '') END AS root FROM {files}) SELECT root FROM r WHERE NOT EXISTS (SELECT 1 FROM r AS o WHERE starts_with(r.root, o.root || '/'))")
over("f226_page_per_row", lambda n: U.single(n.select((_c("node") % 3).alias("guide"), _c("title").alias("source"), "pos")), "nodes", oracle="SELECT node % 3 AS guide, title AS source, min(pos) AS pos FROM {nodes} GROUP BY 1, 2")
over("f245_confirm", lambda f: K.confirm(f.select("fid", "slug", F.when(_c("fid") % 2 == 0, "fixed").otherwise("needed").alias("state")), f.where("fid % 50 < 10"), "slug").select("fid", "state"), "files", oracle="SELECT fid, CASE WHEN fid % 2 = 1 THEN 'needed' WHEN fid % 50 < 10 THEN 'confirmed' ELSE 'fixed' END AS state FROM {files}")
scalar("f252_declaration", "cells", "k", lambda: K.declaration(F.when(_c("k") % 3 == 0, "http://h/x").otherwise("http://h/{path}"), _c("count_cell")), "CASE WHEN k % 3 = 0 THEN 'no path' WHEN k % 6 = 1 THEN '' WHEN k % 6 = 5 THEN '' WHEN k % 6 = 4 THEN 'drop' ELSE 'drop' END")
over("f254_own_language", lambda f: K.own_language(f.select(_c("slug").alias("site"), F.concat(F.when(_c("fid") % 50 < 10, F.when(_c("fid") % 3 == 0, "fr-fr/").otherwise("en-us/")).otherwise(""), "path").alias("path")), "en-us"), "files", oracle="SELECT slug AS site, CASE WHEN fid % 50 < 10 THEN 'en-us/' ELSE '' END || path AS path FROM {files} WHERE fid % 50 >= 10 OR fid % 3 <> 0")
over("f256_index_completeness", lambda f: U.unindexed(f.select("path"), f.where("fid % 5 <> 0").select(F.upper("path").alias("target"))), "files", oracle="SELECT path FROM {files} WHERE lower(path) NOT IN (SELECT lower(path) FROM {files} WHERE fid % 5 <> 0)")
over("f266_ordinal_runs", lambda f: K.ordinal_runs(f.select("slug", _c("fid").alias("pos"), (F.floor(_c("fid") / 50) % 7).alias("number"), (_c("bytes") > 40000).alias("heading")), "slug").drop("run"), "files", oracle="WITH i AS (SELECT slug, fid AS pos, cast(floor(fid / 50) AS bigint) % 7 AS number, bytes > 40000 AS heading FROM {files}), h AS (SELECT *, sum(CASE WHEN heading THEN 1 ELSE 0 END) OVER (PARTITION BY slug ORDER BY pos) AS h FROM i), n AS (SELECT *, CASE WHEN number = lag(number) OVER w + 1 AND h = lag(h) OVER w THEN 0 ELSE 1 END AS fresh FROM h WHERE NOT heading WINDOW w AS (PARTITION BY slug ORDER BY pos)), r AS (SELECT *, sum(fresh) OVER (PARTITION BY slug ORDER BY pos) AS run FROM n) SELECT slug, min(pos) AS first, count(*) AS items FROM r GROUP BY slug, run")
scalar("f268_roman", "cells", "k", lambda: K.roman(F.element_at(F.array(*map(F.lit, ["i", "iv", "ix", "xiv", "xxxix", "iiii", "abc", ""])), (_c("k") % 8 + 1).cast("int"))), "[1, 4, 9, 14, 39, NULL, NULL, NULL][k % 8 + 1]")
over("f270_row_groups", lambda f: K.row_groups(f.select("slug", _c("fid").alias("pos"), "kind"), "slug", _c("kind") == "economy"), "files", oracle="SELECT slug, fid AS pos, sum(CASE WHEN kind = 'economy' THEN 1 ELSE 0 END) OVER (PARTITION BY slug ORDER BY fid)::bigint AS \"group\" FROM {files}")
over("f275_twin_topics", lambda f: K.twins(f.select("fid", F.concat("slug", F.when(_c("fid") > 50, F.concat(F.lit("_unique_"), _c("fid").cast("string"))).otherwise("")).alias("name"))), "files", oracle="SELECT fid, slug AS kept FROM {files} WHERE fid > 50")
over("f280_publish", lambda f: K.publish(f.select(_c("path").alias("name"), F.md5("brand").alias("digest"), F.md5("kind").alias("maps")), f.where("fid % 4 <> 0").select(_c("path").alias("name"), F.md5(F.when(_c("fid") % 3 == 0, "slug").otherwise(_c("brand"))).alias("digest"), F.md5(F.when(_c("fid") % 5 == 0, "slug").otherwise(_c("kind"))).alias("maps"))), "files", oracle="SELECT path AS name, CASE WHEN fid % 4 = 0 OR fid % 3 = 0 THEN 'synced' WHEN fid % 5 = 0 THEN 'maps refreshed' ELSE 'current' END AS outcome FROM {files}")
over("f282_repair", lambda p: K.repaired(p, "page_id", "html", "<br>", "<br/>").select("page_id", F.md5("text").alias("digest"), "n"), "pages", oracle="SELECT page_id, md5(replace(html, '<br>', '<br/>')) AS digest, len(regexp_extract_all(html, '<br>')) AS n FROM {pages} WHERE contains(html, '<br>')")
