"""Queries over layout, registries, stages and small readers."""

from __future__ import annotations

import io
import zipfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tessella.functions import paths as P, text as X
from tessella.operators import documents as D, html as H, layout as Y, registries as G, stages as S
from tessella.plans.model import relation
from tessella.plans.pages import _judged, _sums
from tessella.plans.registry import over, query, scalar
from tessella.sources import readers as R, writers as W
from tessella.storage import scratch

_c = F.col


# Readers and writers


@query("SELECT cast(n_nationkey AS string) AS name, n_name AS label, NULL AS note FROM {nation}")
def f009_rule_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rule file of one rule for each nation, 25 in all."""
    rules = "\n".join(f"- name: '{r.n_nationkey}'\n  label: {r.n_name}" for r in relation(spark, sf_dir, "nation").collect())
    return R.rule_table(spark, rules, ["name", "label", "note"], "name")


@F.pandas_udf(T.BinaryType())
def _zipped(names: pd.Series, texts: pd.Series) -> pd.Series:
    def one(name, text):
        out = io.BytesIO()
        with zipfile.ZipFile(out, "w") as z:
            z.writestr(name, text)
            z.writestr(name.upper(), text)
            z.writestr("../" + name, text)
        return out.getvalue()

    return pd.Series([one(n, t) for n, t in zip(names, texts)])


@query("SELECT p_partkey, m.name || CASE WHEN m.up THEN upper('f' || p_partkey || '.txt') ELSE 'f' || p_partkey || '.txt' END AS member, length(p_name) AS bytes, m.name <> '' AS unsafe FROM {part}, (VALUES ('', false), ('', true), ('../', false)) m(name, up)")
def f012_zip_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = F.concat(F.lit("f"), _c("p_partkey").cast("string"), F.lit(".txt"))
    files = relation(spark, sf_dir, "part").select(_c("p_partkey").cast("string").alias("path"), _zipped(name, _c("p_name")).alias("content"))
    return R.archive(files).select(_c("path").cast("long").alias("p_partkey"), "member", "bytes", "unsafe")


@query("SELECT slug, version, topics FROM {versions} WHERE batch = 'h' AND topics >= 100".replace("'h'", "'1'"))
def f024_parameterised_select(spark: SparkSession, sf_dir: str) -> DataFrame:
    relation(spark, sf_dir, "versions").createOrReplaceTempView("known_versions")
    return R.select(spark, "SELECT slug, version, topics FROM known_versions WHERE batch = :batch AND topics >= :least", batch="1", least=100)


@query("SELECT 'slug,name,missing' AS line UNION ALL SELECT slug || ',' || display_name || ',' FROM {products}")
def f026_csv_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of a file with a fixed schema: a column outside it is dropped, a missing one blank, lines end in CRLF."""
    path = scratch(spark, "csv")
    W.csv(relation(spark, sf_dir, "products").select("slug", _c("display_name").alias("name"), "bu").coalesce(1), path, ["slug", "name", "missing"])
    return spark.read.option("lineSep", "\r\n").text(path).select(_c("value").alias("line"))


@query("SELECT fid, 'second' AS build FROM {files}")
def f029_build_and_swap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A first build, interrupted after it was set aside, recovered, and replaced by the second."""
    base, files = scratch(spark, "swap"), relation(spark, sf_dir, "files").select("fid")
    files.withColumn("build", F.lit("first")).write.parquet(f"{base}/t.old")
    W.recover(spark, f"{base}/t")
    files.withColumn("build", F.lit("second")).write.parquet(f"{base}/t.part")
    W.swap(spark, f"{base}/t.part", f"{base}/t")
    return spark.read.parquet(f"{base}/t")


# Files


over(
    "f015_inventory",
    lambda f: S.inventory(f.select("slug", F.when(_c("fid") % 53 == 0, F.concat(P.parent(_c("path")), F.lit("/Doxygen.png"))).otherwise(_c("path")).alias("path"), "bytes"), ["doxygen.png"]),
    "files",
    oracle=r"""WITH f AS (SELECT slug, bytes, CASE WHEN fid % 53 = 0 THEN regexp_replace(path, '/[^/]*$', '') || '/Doxygen.png' ELSE path END AS path FROM {files}),
    r AS (SELECT DISTINCT slug, regexp_replace(path, '/[^/]*$', '') AS root FROM f WHERE path LIKE '%/Doxygen.png')
    SELECT slug, CASE WHEN EXISTS (SELECT 1 FROM r WHERE r.slug = f.slug AND starts_with(f.path, r.root || '/')) THEN 'api' ELSE 'content' END AS part, CASE WHEN path LIKE '%.png' THEN 'image' ELSE 'topic' END AS category, count(*) AS files, sum(bytes) AS bytes FROM f GROUP BY 1, 2, 3""",
)
over("f037_asset_copies", lambda l, f: S.asset_copies(l.select(_c("src").alias("page"), _c("target").alias("path")), f), "links", "files", oracle="SELECT l.path, f.bytes, l.pages, f.bytes IS NOT NULL AS found FROM (SELECT target AS path, count(DISTINCT src) AS pages FROM {links} GROUP BY 1) l LEFT JOIN {files} f USING (path)")
over(
    "f077_api_urls",
    lambda f: Y.api_urls(f.select("slug", F.lit("1-0").alias("segment"), F.concat("brand", F.lit("/"), "path").alias("path"), _c("kind").alias("signature")), "https://h/", "en-us-docs", "en-us"),
    "files",
    oracle="""WITH r AS (SELECT slug, brand || '/' || path AS path, kind FROM {files}), k AS (SELECT slug, kind, min(path) AS kept FROM r GROUP BY 1, 2), n AS (SELECT *, count(*) OVER (PARTITION BY slug, lower(regexp_extract(kept, '[^/]*$'))) AS c FROM k)
    SELECT path, 'https://h/en-us-docs/en-us/' || slug || '/api-references/1-0/' || replace(CASE WHEN c > 1 THEN replace(kept, '/', '-') ELSE regexp_extract(kept, '[^/]*$') END, '#', '%23') AS url FROM r JOIN n USING (slug, kind)""",
)
over("f228_shelved", lambda d: Y.shelved(d.select(F.concat(F.lit("g/"), _c("doc_id").cast("string")).alias("path"), F.md5("text").alias("digest")), d.where("doc_id % 3 <> 0").select(F.concat(F.lit("g/"), _c("doc_id").cast("string")).alias("path"))), "documents", oracle="WITH p AS (SELECT doc_id, text, 'g/' || doc_id AS path FROM {documents}), t AS (SELECT text, min(path) FILTER (doc_id % 3 <> 0) AS kept, min(path) AS least FROM p GROUP BY 1) SELECT path, CASE WHEN doc_id % 3 <> 0 THEN path ELSE coalesce(kept, 'unfiled/' || least) END AS new FROM p JOIN t USING (text)")
over("f253_redirects", lambda f: Y.redirects(f.select(_c("path").alias("source"), F.when(_c("fid") % 10 == 0, "unfiled/x.md").otherwise(P.to_markdown(_c("path"))).alias("target"), F.when(_c("fid") % 7 == 0, F.concat(F.lit("m/"), "path")).alias("moved")), f.where("fid % 4 <> 0").select(F.concat(F.lit("/pub/"), F.array_join(F.slice(F.split("path", "/"), F.lit(2), F.size(F.split("path", "/"))), "/")).alias("url")), "/pub", 1, True), "files", oracle=r"""WITH u AS (SELECT DISTINCT '/pub/' || regexp_replace(path, '^[^/]*/', '') AS url FROM {files} WHERE fid % 4 <> 0), b AS (SELECT '/pub/' || regexp_replace(path, '^[^/]*/', '') AS "from", CASE WHEN fid % 7 = 0 THEN 'm/' || path WHEN fid % 10 = 0 THEN 'unfiled/x.md' ELSE regexp_replace(path, '\.x?html?$', '.md', 'i') END AS "to" FROM {files}) SELECT "from", "to", "from" IN (SELECT url FROM u) AS listed FROM b WHERE NOT starts_with("to", 'unfiled/')""")


# Navigation. A tree of each order's rows: a row under the one before it where its number is even.


def _menus(spark: SparkSession, sf_dir: str) -> DataFrame:
    return relation(spark, sf_dir, "menus").select("tree", "node", "parent", "pos", "title", "page")


@query("WITH c AS (SELECT m.*, p.title AS above FROM {menus} m LEFT JOIN {menus} p ON p.tree = m.tree AND p.node = m.parent) SELECT tree, CASE WHEN node = 4 THEN 'moved' ELSE 'title' END AS kind, CASE WHEN above IS NULL THEN '' ELSE above || ' > ' END || title AS path FROM c WHERE node IN (4, 6)")
def f079_compare_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The menu has row 4 at the top's end and row 6 under another title."""
    menu = _menus(spark, sf_dir)
    served = menu.withColumns({"parent": F.when(_c("node") != 4, _c("parent")), "pos": F.when(_c("node") == 4, 99).otherwise(_c("pos")), "title": F.when(_c("node") == 6, "Other").otherwise(_c("title"))})
    return Y.compare_titles(menu, served)


@query("WITH h AS (SELECT *, page = 'p7' AND NOT EXISTS (SELECT 1 FROM {menus} x WHERE x.tree = m.tree AND x.parent = m.node) AS hit FROM {menus} m), r AS (SELECT *, row_number() OVER (PARTITION BY tree, hit ORDER BY pos) AS n, max(pos) OVER (PARTITION BY tree) AS last FROM h) SELECT tree, node, CASE WHEN NOT hit THEN parent END AS parent, CASE WHEN hit THEN last + 9 ELSE pos END AS pos, title, page FROM r WHERE NOT hit OR n = 1")
def f080_tail_moved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The new tree ends in the support page p7, so the old rows that open it are one at the end."""
    menu = _menus(spark, sf_dir)
    new = menu.select("tree").distinct().select("tree", F.lit(1).alias("node"), F.lit(None).cast("int").alias("parent"), F.lit(1).alias("pos"), F.lit("Support").alias("title"), F.lit("p7").alias("page"))
    return Y.tail_moved(menu, Y.tail_pages(new, F.lower("title") == "support"))


@query("SELECT tree, node, parent, row_number() OVER (PARTITION BY tree, parent ORDER BY CASE WHEN parent IS NULL AND page = 'p5' AND node % 4 <> 3 THEN 2 ELSE 1 END, node % 3, pos, node) AS place, title, CASE WHEN node % 4 = 3 THEN 'index/' || regexp_replace(lower(title), '[^a-z0-9]+', '-', 'g') || '.md' ELSE page END AS page FROM {menus}")
def f219_synthesised(spark: SparkSession, sf_dir: str) -> DataFrame:
    menu = _menus(spark, sf_dir).withColumn("unit", _c("node") % 3)
    units = menu.select("tree", "unit").distinct().withColumn("rank", _c("unit"))
    return Y.synthesised(units, menu.withColumn("page", F.when(_c("node") % 4 != 3, _c("page"))), F.coalesce(_c("page") == "p5", F.lit(False)))


@query("SELECT tree, node, title, 'out/' || page || '.md' AS page FROM {menus} WHERE page <> 'p3'")
def f229_old_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Source tables of contents keyed by where their pages were published; rows without one are no pages."""
    toc = F.concat(F.lit("define({n:[{t:'"), "title", F.lit("',h:'"), "page", F.lit(".htm'}]});"))
    rows = _menus(spark, sf_dir).select("tree", "node", F.explode(R.toc(toc, "define")).alias("e")).select("tree", "node", "e.title", _c("e.path").alias("source"))
    outputs = _menus(spark, sf_dir).where("page <> 'p3'").select(F.concat("page", F.lit(".htm")).alias("source"), F.concat(F.lit("out/"), "page", F.lit(".md")).alias("page")).distinct()
    return rows.join(outputs, "source").select("tree", "node", "title", "page")


# Layout


@query(
    """WITH t AS (SELECT tree, pos, k, 's' || k AS source, min(pos) OVER (PARTITION BY tree, k) AS first FROM {menus}), p AS (SELECT tree, pos, k, source, CASE WHEN k < 30 THEN 'page' || (k % 8) END AS page FROM t WHERE pos = first),
    q AS (SELECT *, CASE WHEN page IS NOT NULL AND row_number() OVER (PARTITION BY tree, page ORDER BY pos) = 1 THEN 1 ELSE 0 END AS opens FROM p), g AS (SELECT *, sum(opens) OVER (PARTITION BY tree ORDER BY pos) AS gap FROM q)
    SELECT tree, source, page, CASE WHEN page IS NULL THEN min(pos) OVER (PARTITION BY tree, page, gap) ELSE min(pos) OVER (PARTITION BY tree, page) END AS place, CASE WHEN page IS NULL THEN pos ELSE k END AS rank FROM g"""
)
def f090_projected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trees laid out by a reference of eight pages that holds topics s0 to s29; new topics are short."""
    rows = relation(spark, sf_dir, "menus").select("tree", "pos", F.lit("g").alias("guide"), F.concat(F.lit("s"), _c("k").cast("string")).alias("source"), F.lit(5).cast("long").alias("words"))
    held = spark.range(30).select(F.concat(F.lit("page"), (_c("id") % 8).cast("string")).alias("page"), _c("id").cast("int").alias("rank"), F.lit("g").alias("guide"), F.concat(F.lit("s"), _c("id").cast("string")).alias("source"))
    reference = rows.select("tree", "source").distinct().join(held, "source").select("tree", "page", "rank", "guide", "source")
    return Y.project(reference, rows, 1000).select("tree", "source", "page", "place", "rank")


@query(
    """WITH p AS (SELECT o_custkey AS tree, o_orderkey AS key, 'g/p' || o_orderkey || '.md' AS path, CASE o_orderkey % 4 WHEN 1 THEN 'g/Pin.md' WHEN 2 THEN 'new/p' || o_orderkey || '.md' END AS wanted FROM {orders}),
    n AS (SELECT *, CASE WHEN wanted = 'g/Pin.md' THEN row_number() OVER (PARTITION BY tree, wanted ORDER BY key) END AS i FROM p)
    SELECT tree, key, CASE WHEN wanted IS NULL OR i > 1 THEN path ELSE wanted END AS path, CASE WHEN wanted IS NULL THEN 'kept' WHEN i > 1 THEN 'refused' ELSE 'applied' END AS verdict FROM n"""
)
def f094_pinned(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = _c("o_orderkey")
    path = F.concat(F.lit("g/p"), k.cast("string"), F.lit(".md"))
    wanted = F.when(k % 4 == 1, "g/Pin.md").when(k % 4 == 2, F.concat(F.lit("new/p"), k.cast("string"), F.lit(".md")))
    return Y.pinned(relation(spark, sf_dir, "orders").select(_c("o_custkey").alias("tree"), k.alias("pos"), k.alias("key"), path.alias("path"), wanted.alias("wanted")))


@query(
    """WITH o AS (SELECT o_custkey AS tree, o_orderkey AS key, 'customer-' || o_custkey || '/' || repeat('ab', 10) || '-' || o_orderkey AS stem FROM {orders})
    SELECT tree, key, stem || '.md' AS path, 0 AS cap FROM o"""
)
def f224_fitted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paths that are short enough stay; tests hold the cutting against fixed trees."""
    name = F.concat(F.lit("customer-"), _c("o_custkey").cast("string"), F.lit("/"), F.repeat(F.lit("ab"), F.lit(10)), F.lit("-"), _c("o_orderkey").cast("string"), F.lit(".md"))
    return Y.fitted(relation(spark, sf_dir, "orders").select(_c("o_custkey").alias("tree"), _c("o_orderkey").alias("pos"), _c("o_orderkey").alias("key"), name.alias("path")), 60)


@query("WITH h AS (SELECT tree AS page, pos, topic, 'part-' || (k % 3) AS base FROM {menus}), n AS (SELECT *, row_number() OVER (PARTITION BY page, base ORDER BY pos) - 1 AS n FROM h) SELECT page, topic, arg_min(CASE WHEN n = 0 THEN base ELSE base || '-' || n END, pos) AS anchor FROM n GROUP BY 1, 2")
def f225_assigned(spark: SparkSession, sf_dir: str) -> DataFrame:
    heads = relation(spark, sf_dir, "menus").select(_c("tree").alias("page"), "pos", "topic", F.concat(F.lit("Part "), (_c("k") % 3).cast("string")).alias("title"))
    return Y.assigned(heads)


# Registries and stages


@query("SELECT id, code, CASE WHEN code IN ('C1', 'C3') THEN 'warning' WHEN code = 'C2' THEN 'note' ELSE 'error' END AS severity, CASE WHEN code IN ('C1', 'C2', 'C3') THEN 'verify' ELSE 'unknown' END AS stage FROM {findings}")
def f240_graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes = {n: G.Code(n, s, "verify") for n, s in (("C1", "warning"), ("C2", "note"), ("C3", "warning"))}
    return G.graded(relation(spark, sf_dir, "findings").select("id", "code"), codes).select("id", "code", "severity", "stage")


@query("SELECT slug, version, stage FROM (SELECT slug, version, stage, arg_max(CASE WHEN outcome = 'ok' THEN 'begin' ELSE 'end' END, struct_pack(h := happened, o := outcome <> 'ok')) AS mark FROM {stage_events} GROUP BY 1, 2, 3) t WHERE mark = 'begin'")
def f232_building(spark: SparkSession, sf_dir: str) -> DataFrame:
    return S.building(relation(spark, sf_dir, "stage_events").select("slug", "version", "stage", F.when(_c("outcome") == "ok", "begin").otherwise("end").alias("mark"), _c("happened").alias("at")))


scalar("f257_metadata", "products", "slug", lambda: S.metadata_finding(F.when(F.length("slug") % 2 == 0, F.concat(F.lit("id: x\ntitle: "), F.when(_c("in_scope"), _c("slug")).otherwise('""'))).when(_c("in_scope"), "id: 1").otherwise("- a\n- b"), "title"), "CASE WHEN length(slug) % 2 = 0 THEN CASE WHEN NOT in_scope THEN 'title is empty' END WHEN in_scope THEN 'no title' ELSE 'no mapping' END")


@query(r"SELECT 'NAME' AS code, path, 'unsafe' AS message, 'error' AS severity FROM {files} WHERE fid % 6 = 0 UNION ALL SELECT 'LINK', target, 'missing', 'warning' FROM {links} WHERE starts_with(target, 'gone/')")
def f259_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two checks as one run of graded findings."""
    codes = {"NAME": G.Code("NAME", "error", "validate"), "LINK": G.Code("LINK", "warning", "validate")}
    files, links = relation(spark, sf_dir, "files"), relation(spark, sf_dir, "links")
    unsafe = files.where(P.is_unsafe(F.when(_c("fid") % 6 == 0, F.concat(F.lit("../"), "path")).otherwise(_c("path")))).select("path", F.lit("unsafe").alias("message"))
    missing = links.where(_c("target").startswith("gone/")).select(_c("target").alias("path"), F.lit("missing").alias("message"))
    return G.checked({"NAME": unsafe, "LINK": missing}, codes).select("code", "path", "message", "severity")


@query("SELECT page_id, 0 AS missing, 100.0::double AS percent FROM {pages} WHERE html LIKE '%<footer>%'")
def f260_served_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The footer's text, looked for in the whole served page."""
    pages = relation(spark, sf_dir, "pages")
    lower = lambda b: F.transform(b, lambda x: X.normalise(x, compatibility=False))
    mine = pages.select("page_id", H.container_blocks(_c("html"), "footer").alias("blocks")).where("blocks is not null")
    return D.coverage(mine.select("page_id", lower(_c("blocks")).alias("blocks")), pages.select("page_id", lower(H.html_blocks(_c("html"))).alias("blocks")), "page_id").select("page_id", "missing", "percent")


@query("SELECT slug, version, CASE WHEN zip_url IS NULL THEN 'missing' WHEN okey % 3 = 0 THEN 'unchanged' WHEN okey % 5 = 0 THEN 'unsafe' WHEN okey % 7 = 0 THEN 'conflict' ELSE 'extracted' END AS outcome FROM {versions}")
def f277_extracted(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = relation(spark, sf_dir, "versions")
    member = lambda name, crc: F.struct(name.alias("member"), F.lit(9).cast("long").alias("bytes"), crc.cast("long").alias("crc"))
    both = F.array(member(F.when(_c("okey") % 5 == 0, "../a.htm").otherwise("a.htm"), F.lit(1)), member(F.lit("B.htm"), F.lit(2)), member(F.lit("b.htm"), F.when(_c("okey") % 7 == 0, 3).otherwise(2)))
    members = v.select("slug", "version", F.explode(both).alias("m")).select("slug", "version", "m.*").withColumn("unsafe", P.is_unsafe(_c("member")))
    versions = v.select("slug", "version", F.md5("zip_url").alias("checksum"))
    return S.extracted(versions, members, v.where("okey % 3 = 0").select("slug", "version", F.md5("zip_url").alias("done")))


@query(r"SELECT 'g/p' || p_partkey || '.md' AS page, '# ' || p_name || chr(10) || chr(10) || '[next](g/p' || ((p_partkey + 1) % (SELECT count(*) FROM {part})) || '.md#x) [out](gone.htm)' AS text FROM {part}")
def f278_converted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each part a page that links to the next."""
    part = relation(spark, sf_dir, "part")
    n = part.count()
    link = F.concat(F.lit("g/p"), ((_c("p_partkey") + 1) % n).cast("string"), F.lit(".htm"))
    html = F.concat(F.lit("<h1>"), "p_name", F.lit("</h1><p><a href='"), link, F.lit("#x'>next</a> <a href='gone.htm'>out</a></p>"))
    return S.converted(part.select(F.concat(F.lit("g/p"), _c("p_partkey").cast("string"), F.lit(".htm")).alias("page"), html.alias("html")))


@query("SELECT p_partkey, CASE p_partkey % 2 WHEN 0 THEN '> **Tip:**' || chr(10) || '> ' || p_name ELSE p_name END AS markdown FROM {part}")
def f215_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of units whose generator is told from their files, each written in its own dialect."""
    part = relation(spark, sf_dir, "part").withColumn("slug", F.concat(F.lit("u"), _c("p_partkey").cast("string")))
    html = F.when(_c("p_partkey") % 2 == 0, F.concat(F.lit('<div class="note tip">'), "p_name", F.lit("</div>"))).otherwise(F.concat(F.lit("<p>"), "p_name", F.lit("</p>")))
    files = part.select("slug", F.when(_c("p_partkey") % 2 == 0, "a.ditamap").otherwise("a.htm").alias("path"), F.lit("").alias("head"))
    return S.converted_units(part.select("slug", "p_partkey", html.alias("html")), R.engine(files)).select("p_partkey", "markdown")


@query("SELECT o_custkey AS page, count(*) AS topics, sum(CASE WHEN o_orderkey % 2 = 0 THEN 8 ELSE 9 END)::bigint AS words, sum(CASE WHEN o_orderkey % 2 = 0 THEN 8 ELSE 9 END)::bigint AS words_before, string_agg(CASE WHEN o_orderkey % 2 = 0 THEN '## T' ELSE '## Order ' END || o_orderkey || chr(10) || chr(10) || 'see [it](' || o_custkey || '#order-' || o_orderkey || ') and [no](x.md) or five', chr(10) || chr(10) ORDER BY o_orderkey) AS text FROM {orders} GROUP BY 1")
def f279_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A customer's orders as the topics of one page; each links to itself."""
    k = _c("o_orderkey").cast("string")
    text = F.concat(F.when(_c("o_orderkey") % 2 == 0, F.concat(F.lit("# T"), k, F.lit("\n\n"))).otherwise(""), F.lit("see [it](t"), k, F.lit(".md) and [no](x.md) or five"))
    return Y.merge(relation(spark, sf_dir, "orders").select(_c("o_custkey").cast("string").alias("page"), _c("o_orderkey").alias("pos"), F.concat(F.lit("t"), k, F.lit(".md")).alias("source"), F.concat(F.lit("Order "), k).alias("title"), F.lit(2).alias("level"), text.alias("text"))).select(_c("page").cast("long").alias("page"), "topics", "words", "words_before", "text")


@query(
    rf"""WITH s AS (SELECT doc_id, source, string_split(lower(text), chr(10)) AS blocks FROM {{documents}} WHERE text IS NOT NULL), t AS (SELECT doc_id, blocks FROM s WHERE doc_id % 9 <> 0), {_judged},
    sums AS (SELECT source, {_sums} FROM judged JOIN s USING (doc_id) GROUP BY 1), lost AS (SELECT source, count(*) AS images FROM s WHERE blocks[1] NOT IN (SELECT blocks[1] FROM s WHERE doc_id % 50 <> 0) GROUP BY 1), p AS (SELECT source, count(*) AS pages FROM s GROUP BY 1)
    SELECT source AS folder, pages, words, CASE WHEN words = 0 THEN 100.0 ELSE round_even(present * 100.0::double / words, 1) END AS percent, missing, coalesce(images, 0) AS images, CASE WHEN coalesce(images, 0) > 0 THEN 'lost' WHEN missing > 0 THEN 'issues' ELSE 'clean' END AS outcome FROM p JOIN sums USING (source) LEFT JOIN lost USING (source)"""
)
def f281_verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents against a publication without every ninth, with a picture for each first line."""
    docs = relation(spark, sf_dir, "documents").where("text is not null").select(_c("doc_id").alias("key"), _c("source").alias("folder"), F.split(F.lower("text"), "\n").alias("blocks"))
    digest = F.sha2(_c("blocks")[0], 256).alias("digest")
    return S.verified(docs, docs.where("key % 9 <> 0").select("key", "blocks"), docs.select("key", "folder", digest), docs.where("key % 50 <> 0").select(digest))
