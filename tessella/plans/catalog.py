"""Queries over the catalog relations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tessella.operators import catalog as C
from tessella.plans.model import relation
from tessella.plans.registry import over, query

_text = "coalesce(trim(cast({0} AS string)), '')"
_mine = "SELECT slug, version, release_date, CASE WHEN okey % 4 = 0 THEN 'edited' ELSE release_status END AS release_status, okey % 13 = 0 AS pin FROM {versions} WHERE okey % 10 <> 1"
_base = "SELECT slug, version, release_date, release_status FROM {versions} WHERE okey % 10 <> 2"
_theirs = "SELECT slug, version, release_date || CASE WHEN okey % 3 = 0 THEN 'x' ELSE '' END AS release_date, release_status || '!' AS release_status FROM {versions} WHERE okey % 10 <> 3"


def _sql(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    import re

    return spark.sql(text, **{x: relation(spark, sf_dir, x) for x in set(re.findall(r"\{([a-z_]+)\}", text))})


def _field(f: str) -> str:
    m, b, t = (f"{x}.{f}" for x in "mbt")
    return f"CASE WHEN m.slug IS NULL THEN {t} WHEN t.slug IS NULL THEN {m} WHEN coalesce(m.pin, false) THEN {m} WHEN CASE WHEN b.slug IS NULL THEN {_text.format(m)} = '' ELSE {_text.format(m)} = {_text.format(b)} END THEN {t} ELSE {m} END AS {f}"


@query(f"WITH m AS ({_mine}), b AS ({_base}), t AS ({_theirs}) SELECT coalesce(m.slug, t.slug) AS slug, coalesce(m.version, t.version) AS version, {_field('release_date')}, {_field('release_status')} FROM m FULL JOIN t ON m.slug = t.slug AND m.version = t.version LEFT JOIN b ON b.slug = coalesce(m.slug, t.slug) AND b.version = coalesce(m.version, t.version)")
def f053_three_way_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.three_way(_sql(spark, sf_dir, _mine), _sql(spark, sf_dir, _base), _sql(spark, sf_dir, _theirs), ["slug", "version"], ["release_date", "release_status"], pinned="pin")


@query("WITH t AS (SELECT slug, version FROM {versions} WHERE okey % 10 <> 3 AND okey % 7 <> 0) SELECT slug, version, CASE WHEN engine_source = 'manual' THEN 'hand added' ELSE 'deleted' END AS verdict FROM {versions} v WHERE NOT is_archived AND slug IN (SELECT slug FROM t) AND NOT EXISTS (SELECT 1 FROM t WHERE t.slug = v.slug AND t.version = v.version)")
def f054_deletions(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = relation(spark, sf_dir, "versions")
    return C.deletions(versions, versions.where("okey % 10 <> 3 and okey % 7 <> 0").select("slug", "version"), archive_complete=False)


@query("SELECT v.slug, v.version, CASE WHEN v.engine_source = 'manual' THEN v.release_status ELSE coalesce(r.release_status, 'unknown') END AS release_status FROM {versions} v LEFT JOIN (SELECT slug, version, 'reported' AS release_status FROM {versions} WHERE okey % 3 = 1) r ON v.slug = r.slug AND v.version = r.version")
def f055_status_precedence(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = relation(spark, sf_dir, "versions")
    return C.by_precedence(versions, versions.where("okey % 3 = 1").withColumn("release_status", F.lit("reported")), "release_status", "engine_source", "unknown")


@query("SELECT convert_eligible AS eligible, coalesce(d, 'none') AS decision, count(*) AS n FROM (SELECT convert_eligible, CASE WHEN okey % 3 = 1 THEN CASE okey % 2 WHEN 0 THEN 'yes' ELSE 'no' END END AS d FROM {versions}) t GROUP BY 1, 2")
def f056_decision_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = relation(spark, sf_dir, "versions")
    sheet = versions.where("okey % 3 = 1").select("slug", "version", F.when(F.col("okey") % 2 == 0, "yes").otherwise("no").alias("d"))
    return versions.join(sheet, ["slug", "version"], "left").groupBy(F.col("convert_eligible").alias("eligible"), F.coalesce("d", F.lit("none")).alias("decision")).agg(F.count("*").alias("n"))


@query("SELECT slug, version, release_status FROM {versions} WHERE CASE WHEN okey % 5 = 0 THEN release_status <> 'unknown' ELSE okey % 6 = 1 AND release_status <> 'active' END")
def f057_hand_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = relation(spark, sf_dir, "versions")
    written = versions.where("okey % 5 <> 0").withColumn("release_status", F.when(F.col("okey") % 6 == 1, "active").otherwise(F.col("release_status")))
    return C.hand_edits(versions, written, "release_status", "unknown")


@query("SELECT slug, CASE WHEN scope_source = 'manual' THEN in_scope ELSE cast(substr(slug, 2) AS bigint) % 5 = 0 END AS in_scope FROM {products}")
def f058_scope_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = relation(spark, sf_dir, "products")
    return C.scope(products, products.where("cast(substr(slug, 2) as bigint) % 5 = 0"))


@query("SELECT DISTINCT 'p' || cast(user_id * 40 AS string) AS slug FROM {events} WHERE user_id * 40 NOT IN (SELECT c_custkey FROM {customer})")
def f059_unmatched_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = relation(spark, sf_dir, "events").select(F.concat(F.lit("p"), (F.col("user_id") * 40).cast("string")).alias("slug")).distinct()
    return C.unmatched(rules, relation(spark, sf_dir, "products"))


@query("SELECT s.selector, CASE WHEN p.slug IS NOT NULL THEN s.selector WHEN c.n = 1 THEN c.only WHEN c.n > 1 THEN 'ambiguous' ELSE s.selector END AS slug FROM (SELECT DISTINCT CASE user_id % 3 WHEN 0 THEN 'p' WHEN 1 THEN 'PC' ELSE 'x' END || cast(user_id * 9 AS string) AS selector FROM {events}) s LEFT JOIN {products} p ON p.slug = s.selector LEFT JOIN (SELECT product_code, count(*) AS n, min(slug) AS only FROM {products} GROUP BY 1) c ON c.product_code = s.selector")
def f060_selectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = F.when(F.col("user_id") % 3 == 0, "p").when(F.col("user_id") % 3 == 1, "PC").otherwise("x")
    asked = relation(spark, sf_dir, "events").select(F.concat(prefix, (F.col("user_id") * 9).cast("string")).alias("selector")).distinct()
    return C.resolve_selectors(asked, relation(spark, sf_dir, "products"))


_rules = [("pc7", "seven"), ("customer#00000001", "ones"), ("00000000", "early")]
over("f061_first_rule", C.first_rule, "products", rules=_rules, default="general", oracle="SELECT slug, CASE WHEN lower(product_code) = 'pc7' OR contains(lower(display_name), 'pc7') THEN 'seven' WHEN lower(product_code) = 'customer#00000001' OR contains(lower(display_name), 'customer#00000001') THEN 'ones' WHEN contains(lower(display_name), '00000000') THEN 'early' ELSE 'general' END AS family FROM {products}")
over("f062_first_glob", C.first_glob, "findings", rules=[("C3", "p1*", "guide?/*", "accept"), ("C3", "*", "*", "defer"), ("C4", "p?", "*9.md", "fix")], oracle="SELECT id, CASE WHEN code = 'C3' AND slug GLOB 'p1*' AND path GLOB 'guide?/*' THEN 'accept' WHEN code = 'C3' THEN 'defer' WHEN code = 'C4' AND slug GLOB 'p?' AND path GLOB '*9.md' THEN 'fix' END AS decision FROM {findings}")
over("f038_selected", C.selected, "products", "versions", bu="building", oracle="SELECT slug, bu, family, version FROM {products} JOIN {versions} USING (slug) WHERE bu = 'building' AND in_scope AND release_status <> 'retired' AND convert_eligible")
over("f039_gate", C.gate, "products", "versions", oracle="SELECT slug, version, CASE WHEN NOT in_scope THEN 'out of scope' WHEN release_status = 'retired' THEN 'retired' WHEN NOT convert_eligible THEN 'not selected' END AS gate FROM {versions} JOIN {products} USING (slug)")
over("f101_funnel", C.funnel, "products", "versions", "stage_events", oracle="WITH d AS (SELECT slug, bool_or(stage = 'downloaded') AS d, bool_or(stage = 'extracted') AS e, bool_or(stage = 'converted') AS c FROM {stage_events} WHERE outcome = 'ok' GROUP BY slug), r AS (SELECT bu, in_scope AS s, in_scope AND release_status <> 'retired' AS a, in_scope AND release_status <> 'retired' AND convert_eligible AS g, coalesce(d, false) AS d, coalesce(e, false) AS e, coalesce(c, false) AS c FROM {versions} JOIN {products} USING (slug) LEFT JOIN d USING (slug)) SELECT bu, count(*) AS catalogued, count(*) FILTER (s) AS in_scope, count(*) FILTER (a) AS supported, count(*) FILTER (g) AS eligible, count(*) FILTER (g AND d) AS downloaded, count(*) FILTER (g AND e) AS extracted, count(*) FILTER (g AND c) AS converted FROM r GROUP BY bu")
over("f102_engine_histogram", C.engine_histogram, "versions", oracle="SELECT coalesce(engine, 'undetermined') AS engine, count(*) AS n, count(*) FILTER (convert_eligible) AS eligible FROM {versions} GROUP BY 1")
over("f103_batch_counts", C.batch_counts, "versions", oracle="SELECT batch, count(*) AS n FROM {versions} WHERE batch <> '' GROUP BY 1")
over("f104_triage_summary", C.triage_summary, "products", sources=["manual", "rule", "inherited", "default", "keyword"], oracle="SELECT s AS family_source, count(slug) AS n FROM (VALUES ('manual'), ('rule'), ('inherited'), ('default'), ('keyword')) v(s) LEFT JOIN {products} ON family_source = s GROUP BY 1")
over("f105_retirement_effect", C.retirement_effect, "versions", oracle="SELECT slug, count(*) AS n FROM {versions} WHERE convert_eligible GROUP BY slug HAVING bool_and(release_status = 'retired')")
over("f106_family_sizes", C.family_sizes, "products", oracle="SELECT slug, bu, family, count(*) OVER (PARTITION BY bu, family) AS family_products FROM {products}")
over("f123_adjacent_versions", C.adjacent, "versions", oracle=r"SELECT slug, version, newer FROM (SELECT slug, version, lead(version) OVER (PARTITION BY slug ORDER BY [CASE WHEN regexp_matches(p, '^\d') THEN {{'r': 0, 'n': cast(p AS bigint), 't': ''}} ELSE {{'r': 1, 'n': 0, 't': p}} END FOR p IN regexp_extract_all(lower(version), '\d+|[^\d.]+')], version) AS newer FROM {versions}) t WHERE newer IS NOT NULL".replace("{{", "{").replace("}}", "}"))
over("f135_listed_order", C.listed_order, "versions", oracle=r"SELECT slug, version, row_number() OVER (PARTITION BY slug ORDER BY regexp_matches(version, '^\d+(\.\d+)*$') DESC, CASE WHEN regexp_matches(version, '^\d') THEN [cast(p AS bigint) FOR p IN string_split(version, '.')] END DESC NULLS LAST, lower(version)) AS place FROM {versions}")
over("f244_derived_pair", C.derived_pair, "versions", oracle="SELECT slug, version, topics, topics > 0 AS has_topics FROM {versions}")
over("f246_integrity", lambda p, v: C.integrity(p.where("in_scope"), v), "products", "versions", oracle="SELECT 'duplicate' AS rule, slug, version FROM {versions} GROUP BY 2, 3 HAVING count(*) > 1 UNION ALL SELECT 'orphan', slug, version FROM {versions} WHERE slug NOT IN (SELECT slug FROM {products} WHERE in_scope) UNION ALL SELECT 'no address', slug, version FROM {versions} WHERE convert_eligible AND zip_url IS NULL")
over("f247_soft_warnings", C.soft_warnings, "products", "versions", oracle="WITH r AS (SELECT * FROM {versions} JOIN {products} USING (slug) WHERE batch IS NOT NULL) SELECT slug, version, 'out of scope' AS warning FROM r WHERE NOT in_scope UNION ALL SELECT slug, version, 'retired' FROM r WHERE release_status = 'retired' UNION ALL SELECT slug, version, 'ineligible' FROM r WHERE NOT convert_eligible")
over("f248_duplicate_names", C.duplicate_names, "products", oracle="SELECT bu, bu || '-nation' AS name, count(DISTINCT family) AS families FROM {products} GROUP BY 1 HAVING count(DISTINCT family) > 1")
over("f249_coverage_ratio", C.coverage_ratio, "products", "stage_events", oracle="SELECT count(*) FILTER (slug IN (SELECT slug FROM {stage_events})) AS with_data, count(*) AS products FROM {products}")
over("f263_archive_list", C.archive_list, "versions", oracle="SELECT slug, version, coalesce(zip_url, 'local') AS address, release_date FROM {versions} WHERE is_archived")


@query("SELECT slug, CASE WHEN bu = 'machinery' THEN 'moved' ELSE family END AS family, CASE WHEN bu = 'machinery' THEN 'manual' ELSE family_source END AS family_source FROM {products}")
def f242_set_field(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.set_field(relation(spark, sf_dir, "products"), F.col("bu") == "machinery", "family", F.lit("moved"), "family_source").select("slug", "family", "family_source")


@query("SELECT slug, version, CASE WHEN okey % 4 = 1 AND engine_source <> 'manual' THEN 'dita' ELSE engine END AS engine FROM {versions}")
def f243_write_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = relation(spark, sf_dir, "versions")
    updates = versions.where("okey % 4 = 1").select("slug", "version", F.lit("dita").alias("engine"))
    return C.write_back(versions, updates, ["slug", "version"], "engine", "engine_source").select("slug", "version", "engine")


@query("SELECT slug, coalesce(CASE WHEN custom_override THEN 'own' END, CASE WHEN family LIKE '%1' THEN 'family' END, CASE WHEN bu = 'building' THEN 'unit' END, 'default') AS theme FROM {products}")
def f251_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    products = relation(spark, sf_dir, "products")
    by_family = products.select("family").distinct().where("family like '%1'").withColumn("theme", F.lit("family"))
    by_unit = products.select("bu").distinct().where("bu = 'building'").withColumn("theme", F.lit("unit"))
    return C.cascade(products.withColumn("theme", F.when(F.col("custom_override"), "own")), by_family, by_unit, "theme", "default")


@query("SELECT slug, version, CASE WHEN okey % 3 = 0 AND okey % 2 = 0 THEN 'new' ELSE release_status END AS release_status, batch FROM {versions} UNION ALL SELECT 'q' || slug, version, CASE WHEN okey % 2 = 0 THEN 'new' END, NULL FROM {versions} WHERE okey % 50 = 0")
def f030_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = relation(spark, sf_dir, "versions")
    value = F.when(F.col("okey") % 2 == 0, "new").alias("release_status")
    changes = versions.where("okey % 3 = 0").select("slug", "version", value).unionByName(versions.where("okey % 50 = 0").select(F.concat(F.lit("q"), "slug").alias("slug"), "version", value))
    return C.upsert(versions.select("slug", "version", "release_status", "batch"), changes, ["slug", "version"])


@query("SELECT slug, version, 'kept' AS origin FROM {versions} WHERE slug NOT IN (SELECT slug FROM {versions} WHERE okey % 20 = 0) UNION ALL SELECT slug, version, 'new' FROM {versions} WHERE okey % 20 = 0")
def f031_replace_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    versions = relation(spark, sf_dir, "versions")
    old = versions.select("slug", "version", F.lit("kept").alias("origin"))
    return C.replace_partition(old, versions.where("okey % 20 = 0").select("slug", "version", F.lit("new").alias("origin")), ["slug"])
