"""The engine's relations derived from the driver's tables, as SQL that any engine reads alike.

Names in braces are tables or earlier relations. `relation` gives a DataFrame; `sql` inlines them as one query.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from tessella.shipping import ship

TABLES = "region nation customer supplier part orders lineitem events documents pages".split()

RELATIONS = {
    "products": """SELECT 'p' || cast(c_custkey AS string) AS slug, 'PC' || cast(c_custkey % 700 AS string) AS product_code, c_name AS display_name,
        lower(c_mktsegment) AS bu, lower(n_name) AS family, CASE c_custkey % 4 WHEN 0 THEN 'manual' WHEN 1 THEN 'rule' WHEN 2 THEN 'inherited' ELSE 'default' END AS family_source,
        c_acctbal > 0 AS in_scope, CASE c_custkey % 3 WHEN 0 THEN 'manual' ELSE 'rule' END AS scope_source, c_custkey % 11 = 0 AS custom_override
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "versions": """SELECT 'p' || cast(o_custkey AS string) AS slug, CASE WHEN o_orderkey % 17 = 0 THEN 'R' ELSE '' END || cast(o_orderkey % 12 AS string) || '.' || cast(o_orderkey AS string) AS version,
        o_orderkey % 9 = 0 AS is_archived, o_orderstatus <> 'P' AS convert_eligible, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE substr(o_orderpriority, 1, 1) END AS batch,
        cast(cast(o_orderdate AS date) AS string) AS release_date, CASE o_orderstatus WHEN 'F' THEN 'retired' WHEN 'O' THEN 'active' ELSE 'unknown' END AS release_status,
        CASE o_orderkey % 6 WHEN 0 THEN 'flare' WHEN 1 THEN 'webworks' WHEN 2 THEN 'dita' WHEN 3 THEN 'auto' ELSE NULL END AS engine,
        CASE o_orderkey % 2 WHEN 0 THEN 'manual' ELSE 'rule' END AS engine_source, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE cast(o_orderkey % 400 AS int) END AS topics,
        CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE 'http://host/pub/p' || cast(o_custkey AS string) || '/' || cast(o_orderkey AS string) || '.zip' END AS zip_url, o_orderkey AS okey
        FROM {orders}""",
    "runs": "SELECT run_id, CASE run_id % 3 WHEN 0 THEN 'verify' WHEN 1 THEN 'convert' ELSE 'fetch' END AS command, '2024-01-' || CASE WHEN run_id < 10 THEN '0' ELSE '' END || cast(run_id AS string) AS started_at FROM (SELECT DISTINCT l_linenumber + l_suppkey % 4 * 6 AS run_id FROM {lineitem}) t",
    "findings": """SELECT l_orderkey * 10000000 + l_partkey * 1000 + l_suppkey % 10 * 10 + l_linenumber AS id, l_linenumber + l_suppkey % 4 * 6 AS run_id, CASE l_linestatus WHEN 'O' THEN 'convert' ELSE 'verify' END AS stage,
        CASE l_returnflag WHEN 'A' THEN 'error' WHEN 'N' THEN 'warning' ELSE 'note' END AS severity, 'C' || cast(l_partkey % 20 AS string) AS code, 'p' || cast(l_suppkey AS string) AS slug,
        '1.' || cast(l_partkey % 3 AS string) AS version, 'guide' || cast(l_partkey % 5 AS string) || '/page' || cast(l_partkey AS string) || '.md' AS path,
        CASE WHEN l_quantity < 10 THEN NULL ELSE cast(l_quantity AS int) END AS n, cast(floor(l_extendedprice) AS bigint) AS words FROM {lineitem}""",
    "stage_events": """SELECT 'p' || cast(user_id AS string) AS slug, cast(event_id % 2 AS string) AS version,
        CASE event_type WHEN 'view' THEN 'downloaded' WHEN 'click' THEN 'extracted' WHEN 'signup' THEN 'converted' WHEN 'purchase' THEN 'merged' ELSE 'synced' END AS stage,
        CASE WHEN value > 15 THEN 'failed' ELSE 'ok' END AS outcome, ts AS happened, event_id FROM {events}""",
    "files": """SELECT p_partkey AS fid, 'p' || cast(p_partkey % 50 AS string) AS slug, 'guide' || cast(p_partkey % 4 AS string) || '/' || replace(p_name, ' ', '_') || '/' || CASE WHEN p_partkey % 7 = 0 THEN 'T' ELSE 't' END || cast(p_partkey AS string) || CASE p_partkey % 3 WHEN 0 THEN '.htm' WHEN 1 THEN '.html' ELSE '.png' END AS path,
        cast(p_size AS bigint) * 1000 AS bytes, p_brand AS brand, lower(p_type) AS kind FROM {part}""",
    "nodes": "SELECT p_partkey AS node, CASE WHEN p_partkey = 0 THEN NULL ELSE cast(floor((p_partkey - 1) / 6) AS bigint) END AS parent, p_partkey AS pos, p_name || ' ' || cast(p_partkey % 13 AS string) AS title, cast(p_size AS bigint) AS words FROM {part}",
    "ids": "SELECT 'p' || cast(l_suppkey AS string) AS slug, cast(l_linenumber AS int) AS release, 'ID' || cast(l_partkey % 300 AS string) AS ident, min('page' || cast(l_partkey % 40 AS string)) AS target FROM {lineitem} GROUP BY l_suppkey, l_linenumber, l_partkey % 300",
    "links": "SELECT l_orderkey * 10 + l_linenumber AS lid, p_partkey AS fid, l_suppkey AS src, CASE WHEN l_linenumber % 4 = 0 THEN upper(f.path) WHEN l_linenumber % 5 = 0 THEN 'gone/' || f.path ELSE f.path END AS target FROM {lineitem} JOIN {part} ON l_partkey = p_partkey JOIN {files} f ON f.fid = p_partkey WHERE l_linenumber < 6",
    "cells": """SELECT o_orderkey AS k,
        CASE o_orderkey % 9 WHEN 0 THEN y || '-' || m || '-' || d WHEN 1 THEN m || '/' || d || '/' || y WHEN 2 THEN cast(13 + o_orderkey % 15 AS string) || '/' || m || '/' || y WHEN 3 THEN y || '/' || m || '/' || d
            WHEN 4 THEN ' ' || d || '-' || m || '-' || y WHEN 5 THEN '1399420800000' WHEN 6 THEN 'June ' || y WHEN 7 THEN y || '-' || m || '-' || d || 'T10:00:00Z' ELSE CASE o_orderkey % 2 WHEN 0 THEN '12345' ELSE '' END END AS date_cell,
        CASE o_orderkey % 7 WHEN 0 THEN 'TRUE' WHEN 1 THEN ' t ' WHEN 2 THEN 'no' WHEN 3 THEN '0' WHEN 4 THEN '' WHEN 5 THEN 'maybe' ELSE 'Y' END AS bool_cell,
        CASE o_orderkey % 6 WHEN 0 THEN '4,310.0' WHEN 1 THEN cast(o_orderkey AS string) WHEN 2 THEN '-5' WHEN 3 THEN '' WHEN 4 THEN '2.5' ELSE ' 17 ' END AS count_cell,
        CASE o_orderkey % 5 WHEN 0 THEN '10.4.0' WHEN 1 THEN '2.0.0-rc1' WHEN 2 THEN cast(o_orderkey % 30 AS string) || '.1' WHEN 3 THEN '2.0.0' ELSE 'HotFix 3' END AS version_cell,
        CASE o_orderkey % 8 WHEN 0 THEN 'images/a%20b.png' WHEN 1 THEN 'mailto:x@y.z' WHEN 2 THEN '//cdn/x.js' WHEN 3 THEN '/shared/a.png' WHEN 4 THEN '#top' WHEN 5 THEN '' WHEN 6 THEN '../x/./y/../p' || cast(o_orderkey AS string) || '.htm?v=2#top' ELSE 'a+b/c.html#s' END AS ref_cell,
        CASE o_orderkey % 5 WHEN 0 THEN 'Note:' WHEN 1 THEN 'WARNING' WHEN 2 THEN 'Hint!' WHEN 3 THEN 'Other' ELSE 'Attention' END AS label_cell,
        CASE o_orderkey % 4 WHEN 0 THEN 'a/b/../c.htm' WHEN 1 THEN '../up/' || cast(o_orderkey % 50 AS string) || '.html' WHEN 2 THEN 'x.htm/y/./z.HTML' ELSE 'plain/' || o_orderpriority || '.png' END AS path_cell,
        o_orderpriority AS words_cell, o_orderstatus AS status_cell, o_totalprice AS price
        FROM (SELECT *, cast(extract(year FROM o_orderdate) AS string) AS y, lpad(cast(extract(month FROM o_orderdate) AS string), 2, '0') AS m, lpad(cast(extract(day FROM o_orderdate) AS string), 2, '0') AS d FROM {orders}) t""",
    "menus": """SELECT tree, node, CASE WHEN node % 2 = 0 THEN node - 1 END AS parent, node AS pos, 'Topic ' || cast(k AS string) || ' of ' || cast(node AS string) AS title, 'p' || cast(k AS string) AS page, k, topic
        FROM (SELECT l_orderkey AS tree, l_partkey % 40 AS k, l_suppkey AS topic, cast(row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS int) AS node FROM {lineitem}) t""",
    "texts": "SELECT doc_id, source, lang, text, lower(text) AS low FROM {documents}",
}


def relation(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table or a relation as a DataFrame; executors get the package, which functions of a page are called from."""
    ship(spark)
    if name in TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    text = RELATIONS[name]
    return spark.sql(text, **{x: relation(spark, sf_dir, x) for x in set(re.findall(r"\{([a-z_]+)\}", text))})


def sql(text: str) -> str:
    """The query with every relation in braces as a common table expression."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in RELATIONS and name not in order:
            for x in re.findall(r"\{([a-z_]+)\}", RELATIONS[name]):
                add(x)
            order.append(name)

    for name in re.findall(r"\{([a-z_]+)\}", text):
        add(name)
    plain = lambda t: re.sub(r"\{([a-z_]+)\}", r"\1", t)
    ctes = ", ".join(f"{x} AS ({plain(RELATIONS[x])})" for x in order)
    body = plain(text)
    if not ctes:
        return body
    if body.lstrip().upper().startswith("WITH "):
        rest = body.lstrip()[5:]
        if rest.upper().startswith("RECURSIVE "):
            return f"WITH RECURSIVE {ctes}, {rest[10:]}"
        return f"WITH {ctes}, {rest}"
    return f"WITH {ctes} {body}"
