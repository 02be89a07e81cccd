"""Queries over trees."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessella.operators import trees as T
from tessella.plans.registry import over

_c = F.col
_walk = "WITH RECURSIVE w AS (SELECT node, 0 AS depth, [title] AS trail FROM {nodes} WHERE parent IS NULL UNION ALL SELECT n.node, w.depth + 1, list_append(w.trail, n.title) FROM {nodes} n JOIN w ON n.parent = w.node)"

over("f218_depth_first", T.depth_first, "nodes", oracle=f"{_walk} SELECT node, depth, array_to_string(trail, ' > ') AS breadcrumb FROM w")
over("f221_breadcrumbs", lambda n: T.depth_first(n).select("node", "breadcrumb"), "nodes", oracle=f"{_walk} SELECT node, array_to_string(trail, ' > ') AS breadcrumb FROM w")
over("f222_section", T.section, "nodes", oracle=f"{_walk} SELECT node, trail[least(len(trail), 3)] AS section FROM w")
over("f220_fold_same", lambda n: T.folded(n.withColumn("title", F.split_part("title", F.lit(" "), F.lit(1)))), "nodes", oracle="SELECT a.node FROM {nodes} a JOIN {nodes} b ON a.parent = b.node WHERE split_part(a.title, ' ', 1) = split_part(b.title, ' ', 1)")
over("f230_list_children", T.children, "nodes", oracle="SELECT parent AS node, string_agg(title, ' | ' ORDER BY pos) AS links FROM {nodes} WHERE parent IS NOT NULL GROUP BY 1")
over("f078_tree_compare", lambda n: T.compare(n, n.where("node % 11 <> 0").withColumns({"parent": F.when(_c("node") % 7 == 0, F.lit(0)).otherwise(_c("parent")), "title": F.when(_c("node") % 5 == 0, F.upper("title")).otherwise(_c("title"))})), "nodes", oracle="SELECT * FROM (SELECT node, CASE WHEN node % 11 = 0 THEN 'missing' WHEN parent IS DISTINCT FROM CASE WHEN node % 7 = 0 THEN 0 ELSE parent END THEN 'moved' WHEN node % 5 = 0 AND upper(title) <> title THEN 'title' END AS verdict FROM {nodes}) t WHERE verdict IS NOT NULL")
over("f146_out_of_order", lambda n: T.out_of_order(n, n.withColumn("pos", F.when(_c("node") % 31 == 0, _c("pos") + 3).otherwise(_c("pos") + 1))), "nodes", oracle="WITH p AS (SELECT parent, pos, CASE WHEN node % 31 = 0 THEN pos + 3 ELSE pos + 1 END AS q FROM {nodes} WHERE parent IS NOT NULL), l AS (SELECT parent, pos, q, lead(q) OVER (PARTITION BY parent ORDER BY pos) AS nq FROM p) SELECT parent FROM l GROUP BY 1 HAVING bool_or(nq < q)")
over("f129_greedy_packing", lambda n: T.pack(n.withColumn("section", _c("node") % 40), "section", 120), "nodes", oracle="WITH RECURSIVE s AS (SELECT node % 40 AS section, node, words, row_number() OVER (PARTITION BY node % 40 ORDER BY pos) AS i FROM {nodes}), w AS (SELECT section, node, i, 0::bigint AS page, words AS total FROM s WHERE i = 1 UNION ALL SELECT s.section, s.node, s.i, CASE WHEN w.total > 0 AND w.total + s.words > 120 THEN w.page + 1 ELSE w.page END, CASE WHEN w.total > 0 AND w.total + s.words > 120 THEN s.words ELSE w.total + s.words END FROM s JOIN w ON s.section = w.section AND s.i = w.i + 1) SELECT section, node, page FROM w")
over("f125_unique_names", lambda n: T.unique_names(n.select((_c("node") % 30).alias("folder"), "pos", F.split_part("title", F.lit(" "), F.lit(1)).alias("name")), "folder"), "nodes", oracle="SELECT folder, pos, CASE WHEN n = 1 THEN name ELSE name || '-' || n END AS name FROM (SELECT node % 30 AS folder, pos, split_part(title, ' ', 1) AS name, row_number() OVER (PARTITION BY node % 30, split_part(title, ' ', 1) ORDER BY pos) AS n FROM {nodes}) t")
over("f227_untocked", lambda f, n: T.orphans(f.select("fid"), n.where("words > 25").select(_c("node").alias("fid"))), "files", "nodes", oracle="SELECT fid FROM {files} WHERE fid NOT IN (SELECT node FROM {nodes} WHERE words > 25)")
over("f223_folder_mirror", lambda n: T.walk(n).select("node", F.array_join(F.transform("trail", lambda t: F.replace(t, F.lit(" "), F.lit("-"))), "/").alias("path")), "nodes", oracle=f"{_walk} SELECT node, replace(array_to_string(trail, '/'), ' ', '-') AS path FROM w")
