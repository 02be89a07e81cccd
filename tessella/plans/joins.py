"""Queries over references, files and help maps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessella.functions import paths as P
from tessella.operators import links as L
from tessella.operators import rules as U
from tessella.plans.model import relation
from tessella.plans.registry import over, query

_c = F.col
_anc = "SELECT fid, bytes, array_to_string(p[1:i], '/') AS root FROM (SELECT fid, bytes, string_split(path, '/') AS p, unnest(range(1, len(string_split(path, '/')))) AS i FROM {files}) t"

over("f082_link_resolution", L.resolve_links, "links", "files", oracle="SELECT lid, CASE WHEN f.path IS NOT NULL THEN 'ok' WHEN g.hint IS NOT NULL THEN 'case' ELSE 'missing' END AS verdict, CASE WHEN f.path IS NULL THEN g.hint END AS hint FROM {links} l LEFT JOIN {files} f ON f.path = l.target LEFT JOIN (SELECT lower(path) AS p, min(path) AS hint FROM {files} GROUP BY 1) g ON g.p = lower(l.target)")
over("f072_unique_match", lambda f: L.unique_match(f.select(F.upper(P.leaf(_c("path"))).alias("name")), f), "files", oracle="SELECT upper(regexp_extract(path, '[^/]*$')) AS name, CASE WHEN count(*) OVER (PARTITION BY lower(regexp_extract(path, '[^/]*$'))) = 1 THEN path END AS path FROM {files}")
over("f075_owning_root", lambda f: L.owning_root(f, f.where("fid % 6 = 0").select(P.parent(_c("path")).alias("root")).unionByName(f.where("fid % 4 <> 3").select(F.split_part("path", F.lit("/"), F.lit(1)).alias("root")))), "files", oracle=f"WITH r AS (SELECT DISTINCT regexp_replace(path, '/[^/]*$', '') AS root FROM {{files}} WHERE fid % 6 = 0 UNION SELECT DISTINCT split_part(path, '/', 1) FROM {{files}} WHERE fid % 4 <> 3), a AS ({_anc}) SELECT fid, arg_max(root, length(root)) AS root FROM a JOIN r USING (root) GROUP BY 1")
over("f109_beneath", L.beneath, "files", oracle=f"SELECT root AS folder, count(*) AS files, sum(bytes)::bigint AS bytes FROM ({_anc}) t GROUP BY 1")
over("f084_nearest_before", lambda f: L.nearest_before(f.select("slug", "fid", "bytes"), "slug", "fid", _c("bytes") > 30000, "twin").select("fid", "twin"), "files", oracle="SELECT fid, max(CASE WHEN bytes > 30000 THEN fid END) OVER (PARTITION BY slug ORDER BY fid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS twin FROM {files}")
over("f127_marker_target", lambda f: L.nearest_before(f.select("slug", "fid", "kind"), "slug", "fid", _c("kind") == "economy", "heading").select("fid", "heading"), "files", oracle="SELECT fid, max(CASE WHEN kind = 'economy' THEN fid END) OVER (PARTITION BY slug ORDER BY fid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS heading FROM {files}")
over("f085_help_map_diff", L.map_diff, "ids", oracle="WITH s AS (SELECT slug, release, lead(release) OVER (PARTITION BY slug ORDER BY release) AS nxt FROM (SELECT DISTINCT slug, release FROM {ids}) t), o AS (SELECT i.slug, s.nxt AS release, ident, target AS was FROM {ids} i JOIN s ON s.slug = i.slug AND s.release = i.release WHERE nxt IS NOT NULL), n AS (SELECT i.* FROM {ids} i JOIN s ON s.slug = i.slug AND s.nxt = i.release) SELECT * FROM (SELECT coalesce(o.slug, n.slug) AS slug, coalesce(o.release, n.release) AS release, coalesce(o.ident, n.ident) AS ident, CASE WHEN n.slug IS NULL THEN 'dropped' WHEN o.slug IS NULL THEN 'added' WHEN was <> target THEN 'retargeted' END AS verdict FROM o FULL JOIN n ON o.slug = n.slug AND o.release = n.release AND o.ident = n.ident) t WHERE verdict IS NOT NULL")
_set = "SELECT slug, ident, min(target) AS target FROM {ids} GROUP BY 1, 2"
over("f068_two_phase_ids", lambda i, e: L.two_phase(e.select("slug", F.concat(F.lit("ID"), (_c("event_id") % 310).cast("string")).alias("ident")).distinct(), i.groupBy("slug", "ident").agg(F.min("target").alias("target"))), "ids", "stage_events", oracle=f"WITH s AS ({_set}), a AS (SELECT DISTINCT slug, 'ID' || cast(event_id % 310 AS string) AS ident FROM {{stage_events}}), n AS (SELECT slug, count(*) AS n FROM s GROUP BY 1), b AS (SELECT ident, target FROM (SELECT ident, target, row_number() OVER (PARTITION BY ident ORDER BY n DESC, slug) AS r FROM s JOIN n USING (slug)) t WHERE r = 1) SELECT a.slug, a.ident, coalesce(s.target, b.target) AS target, CASE WHEN s.target IS NOT NULL THEN 'own' WHEN b.target IS NOT NULL THEN 'sibling' ELSE 'missing' END AS via FROM a LEFT JOIN s ON s.slug = a.slug AND s.ident = a.ident LEFT JOIN b ON b.ident = a.ident")
over("f086_map_mirror", lambda i: L.mirror(i.where("release > 2").select("ident", _c("target").alias("page")).distinct(), i.where("release < 4").select("ident", F.when(_c("release") == 1, F.concat("target", F.lit("x"))).otherwise(_c("target")).alias("page")).distinct()), "ids", oracle="WITH a AS (SELECT DISTINCT ident, target AS page FROM {ids} WHERE release > 2), b AS (SELECT DISTINCT ident, CASE WHEN release = 1 THEN target || 'x' ELSE target END AS page FROM {ids} WHERE release < 4) SELECT *, 'map' AS side FROM (SELECT * FROM a EXCEPT SELECT * FROM b) x UNION ALL SELECT *, 'page' FROM (SELECT * FROM b EXCEPT SELECT * FROM a) y")
over("f144_except_ids", lambda i: U.key_changes(i.where("release % 2 = 1").select("slug", "ident"), i.where("release % 2 = 0").select("slug", "ident")), "ids", oracle="SELECT slug, ident, CASE WHEN max(release % 2) = 1 THEN 'dropped' ELSE 'added' END AS change FROM {ids} GROUP BY 1, 2 HAVING count(DISTINCT release % 2) = 1")
over("f143_union_keys", lambda i: U.all_keys(i.where("release % 2 = 1").select("slug", "ident"), i.where("release % 2 = 0").select("slug", "ident")), "ids", oracle="SELECT slug, ident, CASE WHEN count(DISTINCT release % 2) = 2 THEN 'both' WHEN max(release % 2) = 1 THEN 'present' ELSE 'listed' END AS side FROM {ids} GROUP BY 1, 2")
over("f113_csh_coverage", lambda i: U.map_coverage(i, i.where("length(target) = 6").select("slug", "target")), "ids", oracle="WITH k AS (SELECT slug, ident, bool_or(length(target) = 6) AS opens FROM {ids} GROUP BY 1, 2), p AS (SELECT slug, count(DISTINCT target) AS pages FROM {ids} GROUP BY 1) SELECT slug, count(*) AS idents, count(*) FILTER (NOT opens) AS dropped, pages FROM k JOIN p USING (slug) GROUP BY slug, pages")
over("f261_inverted_map", L.invert, "ids", oracle="SELECT slug, release, target, string_agg(DISTINCT ident, ' ' ORDER BY ident) AS idents FROM {ids} GROUP BY 1, 2, 3")
over("f137_set_order", lambda i: U.set_order(i, "slug"), "ids", oracle="SELECT slug, count(*) AS n FROM {ids} GROUP BY 1 ORDER BY n DESC, slug")
over("f087_dropdown_disk", lambda v, e: L.both_ways(v.select(_c("slug").alias("name")).distinct(), e.select(_c("slug").alias("name")).distinct()), "versions", "stage_events", oracle="SELECT slug AS name, 'no folder' AS verdict FROM (SELECT slug FROM {versions} EXCEPT SELECT slug FROM {stage_events}) a UNION ALL SELECT slug, 'no row' FROM (SELECT slug FROM {stage_events} EXCEPT SELECT slug FROM {versions}) b")
over("f088_redirect_checks", lambda l, f: L.redirects(l.select(_c("target").alias("source"), F.when(_c("lid") % 2 == 0, F.lower("target")).otherwise(F.concat(F.lit("guide1/"), P.leaf(_c("target")))).alias("goal")).distinct(), f), "links", "files", oracle="WITH r AS (SELECT DISTINCT target AS source, CASE WHEN lid % 2 = 0 THEN lower(target) ELSE 'guide1/' || regexp_extract(target, '[^/]*$') END AS goal FROM {links}) SELECT source, goal, CASE WHEN lower(source) = lower(goal) THEN 'loop' WHEN goal NOT IN (SELECT path FROM {files}) THEN 'missing' WHEN source IN (SELECT path FROM {files}) THEN 'shadowed' ELSE 'ok' END AS verdict FROM r")
over("f074_counterparts", lambda d: L.counterparts(d.select((_c("doc_id") % 40).alias("key"), "lang", _c("source").alias("text"))), "documents", oracle="WITH d AS (SELECT doc_id % 40 AS key, lang, source FROM {documents}) SELECT a.lang, count(*) AS pages, count(*) FILTER (a.source = b.source) AS same, cast(round_even(count(*) FILTER (a.source = b.source) * 100.0::double / count(*), 0) AS int) AS share FROM d a JOIN d b ON a.key = b.key WHERE a.lang <> 'en' AND b.lang = 'en' GROUP BY 1")
over("f274_two_hops", lambda l: L.two_hops(l.select(_c("src").alias("a"), (_c("fid") % 100).alias("b")), l.select(_c("src").alias("node")).distinct()), "links", oracle="WITH e AS (SELECT DISTINCT src AS a, fid % 100 AS b FROM {links}), o AS (SELECT a AS node, b AS \"to\", 1 AS hops FROM e UNION ALL SELECT x.a, y.b, 2 FROM e x JOIN e y ON x.b = y.a) SELECT node, \"to\", min(hops) AS hops FROM o WHERE node <> \"to\" GROUP BY 1, 2")
over("f071_listed", lambda f, l: U.in_order(*U.live_rows(f.select(F.concat(F.lit("https://h/"), F.replace("path", F.lit("_"), F.lit("%5F"))).alias("from")), l.select(F.concat(F.lit("/"), "target").alias("from")).withColumnRenamed("from", "url"))[:2]).select("from", "side"), "files", "links", oracle="SELECT 'https://h/' || replace(path, '_', '%5F') AS \"from\", CASE WHEN lower(path) IN (SELECT lower(target) FROM {links}) THEN 0 ELSE 1 END AS side FROM {files}")
over("f095_redirect_coverage", lambda f, l: U.live_rows(l.where("lid % 9 = 0").select(F.concat(F.lit("/"), "target").alias("from")), f.select(F.concat(F.lit("https://h/"), "path").alias("url")))[2], "files", "links", oracle="SELECT 'https://h/' || path AS url FROM {files} WHERE lower(path) NOT IN (SELECT lower(target) FROM {links} WHERE lid % 9 = 0)")
over("f205_asset_outcome", lambda l, f: L.resolve_links(l, f).groupBy("verdict").agg(F.count("*").alias("n")), "links", "files", oracle="SELECT CASE WHEN target IN (SELECT path FROM {files}) THEN 'ok' WHEN lower(target) IN (SELECT lower(path) FROM {files}) THEN 'case' ELSE 'missing' END AS verdict, count(*) AS n FROM {links} GROUP BY 1")
over("f049_path_length", lambda f: U.path_lengths(f.select(F.concat(F.repeat(F.lit("x"), F.lit(235)), "path").alias("path"))), "files", oracle="WITH p AS (SELECT repeat('x', 235) || path AS path FROM {files}) SELECT count(*) FILTER (length(path) > 259) AS over, max(length(path)) AS longest, arg_min(path, struct_pack(l := -length(path), p := path)) AS path FROM p")
over("f046_api_marker", lambda f: f.groupBy(P.parent(_c("path")).alias("folder")).agg(F.bool_or(_c("path").endswith(".png") & (_c("fid") % 2 == 0)).alias("api")), "files", oracle="SELECT regexp_replace(path, '/[^/]*$', '') AS folder, bool_or(path LIKE '%.png' AND fid % 2 = 0) AS api FROM {files} GROUP BY 1")
over("f128_first_per_key", lambda f: U.first_per_key(f.select("slug", "fid", "path", "bytes"), ["slug"], ["bytes", "fid"], last=True), "files", oracle="SELECT slug, fid, path, bytes FROM (SELECT *, row_number() OVER (PARTITION BY slug ORDER BY bytes DESC, fid DESC) AS n FROM {files}) t WHERE n = 1")


@query("SELECT v.slug, v.version, coalesce(d.ok, false) AS downloaded, coalesce(n.n, 0) AS findings, v.topics FROM {versions} v LEFT JOIN (SELECT slug, bool_or(outcome = 'ok') AS ok FROM {stage_events} WHERE stage = 'downloaded' GROUP BY 1) d USING (slug) LEFT JOIN (SELECT slug, count(*) AS n FROM {findings} GROUP BY 1) n USING (slug)")
def f250_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions, events, findings = (relation(spark, sf_dir, r) for r in ("versions", "stage_events", "findings"))
    done = events.where("stage = 'downloaded'").groupBy("slug").agg(F.bool_or(_c("outcome") == "ok").alias("ok"))
    counts = findings.groupBy("slug").agg(F.count("*").alias("n"))
    return versions.join(done, "slug", "left").join(counts, "slug", "left").select("slug", "version", F.coalesce("ok", F.lit(False)).alias("downloaded"), F.coalesce("n", F.lit(0)).alias("findings"), "topics")
