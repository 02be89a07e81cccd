"""Catalog relations: merging snapshots, precedence of sources, gates, counts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tessella.functions.values import is_numeric_version, natural_key


def text_of(c: Column) -> Column:
    """Cells compare as text; null and blank are one."""
    return F.coalesce(F.trim(c.cast("string")), F.lit(""))


def three_way(mine: DataFrame, base: DataFrame, theirs: DataFrame, keys: list[str], fields: list[str], pinned: str | None = None) -> DataFrame:
    """Their value is taken where mine is blank and there is no base, or where mine is still the base's; pinned rows are mine."""
    names = lambda df, p: df.select(*keys, *[F.col(f).alias(f"{p}_{f}") for f in fields], F.lit(True).alias(f"{p}_is"))
    m = mine.select(*keys, *[F.col(f).alias(f"m_{f}") for f in fields], F.lit(True).alias("m_is"), *([F.col(pinned).alias("_pin")] if pinned else []))
    joined = m.join(names(theirs, "t"), keys, "full").join(names(base, "b"), keys, "left")
    out = []
    for f in fields:
        a, b, c = F.col(f"m_{f}"), F.col(f"b_{f}"), F.col(f"t_{f}")
        take = F.when(F.col("b_is").isNull(), text_of(a) == "").otherwise(text_of(a) == text_of(b))
        value = F.when(F.col("m_is").isNull(), c).when(F.col("t_is").isNull(), a)
        if pinned:
            value = value.when(F.coalesce("_pin", F.lit(False)), a)
        out.append(value.when(take, c).otherwise(a).alias(f))
    return joined.select(*keys, *out)


def deletions(mine: DataFrame, theirs: DataFrame, archive_complete: bool = True) -> DataFrame:
    """My versions that a fetched product no longer lists; archived ones only if the archive was read."""
    fetched = theirs.select("slug").distinct()
    gone = mine.join(fetched, "slug", "left_semi").join(theirs, ["slug", "version"], "left_anti")
    gone = gone if archive_complete else gone.where(~F.col("is_archived"))
    return gone.select("slug", "version", F.when(F.col("engine_source") == "manual", "hand added").otherwise("deleted").alias("verdict"))


def by_precedence(versions: DataFrame, report: DataFrame, value: str, source: str, unknown: str) -> DataFrame:
    """A manual value stays; else the report's for the very same version; else the unknown value, however it was before."""
    found = versions.join(report.select("slug", "version", F.col(value).alias("_r")), ["slug", "version"], "left")
    return found.select("slug", "version", F.when(F.col(source) == "manual", F.col(value)).otherwise(F.coalesce("_r", F.lit(unknown))).alias(value))


def hand_edits(mine: DataFrame, written: DataFrame, value: str, unknown: str) -> DataFrame:
    """Values that differ from what was last written, or stand where nothing was: they become manual."""
    w = written.select("slug", "version", F.col(value).alias("_w"))
    return mine.join(w, ["slug", "version"], "left").where(F.when(F.col("_w").isNull(), F.col(value) != unknown).otherwise(F.col("_w") != F.col(value))).select("slug", "version", value)


def scope(products: DataFrame, rules: DataFrame) -> DataFrame:
    """In scope if a rule names the product, unless a hand set it."""
    hit = products.join(rules.select("slug", F.lit(True).alias("_rule")), "slug", "left")
    return hit.select("slug", F.when(F.col("scope_source") == "manual", F.col("in_scope")).otherwise(F.coalesce("_rule", F.lit(False))).alias("in_scope"))


def unmatched(rules: DataFrame, products: DataFrame) -> DataFrame:
    return rules.select("slug").join(products, "slug", "left_anti").orderBy("slug")


def resolve_selectors(selectors: DataFrame, products: DataFrame) -> DataFrame:
    """A slug as such; else the one product with that code; several are ambiguous, none passes through."""
    by_code = products.groupBy(F.col("product_code").alias("selector")).agg(F.count("*").alias("n"), F.min("slug").alias("only"))
    slugs = products.select(F.col("slug").alias("selector"), F.lit(True).alias("_is"))
    found = selectors.join(slugs, "selector", "left").join(by_code, "selector", "left")
    return found.select("selector", F.when(F.col("_is"), F.col("selector")).when(F.col("n") == 1, F.col("only")).when(F.col("n") > 1, "ambiguous").otherwise(F.col("selector")).alias("slug"))


def first_rule(products: DataFrame, rules: list[tuple[str, str]], default: str) -> DataFrame:
    """The first rule, in their order, whose token is the product's code or stands in its name. Rules are a short list."""
    value = F.lit(default)
    for token, family in reversed(rules):
        value = F.when((F.lower("product_code") == token) | F.contains(F.lower("display_name"), F.lit(token)), family).otherwise(value)
    return products.select("slug", value.alias("family"))


def first_glob(findings: DataFrame, rules: list[tuple[str, str, str, str]]) -> DataFrame:
    """The first rule (code, slug glob, path glob, decision) that fits a finding."""
    like = lambda g: "^" + "".join({"*": ".*", "?": "."}.get(c, "\\" + c if not c.isalnum() else c) for c in g) + "$"
    value = F.lit(None).cast("string")
    for code, slug, path, decision in reversed(rules):
        value = F.when((F.col("code") == code) & F.col("slug").rlike(like(slug)) & F.col("path").rlike(like(path)), decision).otherwise(value)
    return findings.select("id", value.alias("decision"))


def selected(products: DataFrame, versions: DataFrame, bu: str | None = None, family: str | None = None, batch: str | None = None, eligible_only: bool = True) -> DataFrame:
    """Versions behind the gates, ordered by unit, family, slug and version, newest first."""
    p = products
    for column, value in (("bu", bu), ("family", family)):
        p = p if value is None else p.where(F.col(column) == value)
    v = versions if batch is None else versions.where(F.col("batch") == batch)
    if eligible_only:
        p, v = p.where("in_scope"), v.where("release_status <> 'retired' and convert_eligible")
    return p.select("slug", "bu", "family").join(v.select("slug", "version"), "slug").orderBy("bu", "family", "slug", natural_key(F.col("version")).desc())


def gate(products: DataFrame, versions: DataFrame) -> DataFrame:
    both = versions.join(products.select("slug", "in_scope"), "slug")
    verdict = F.when(~F.col("in_scope"), "out of scope").when(F.col("release_status") == "retired", "retired").when(~F.col("convert_eligible"), "not selected")
    return both.select("slug", "version", verdict.alias("gate"))


def funnel(products: DataFrame, versions: DataFrame, events: DataFrame) -> DataFrame:
    """Nested counts by unit: a version counts at a step only if it passed those before."""
    done = events.where("outcome = 'ok'").groupBy("slug").agg(*[F.bool_or(F.col("stage") == s).alias(s) for s in ("downloaded", "extracted", "converted")])
    rows = versions.join(products.select("slug", "bu", "in_scope"), "slug").join(done, "slug", "left")
    scope_, alive = F.col("in_scope"), F.col("in_scope") & (F.col("release_status") != "retired")
    eligible = alive & F.col("convert_eligible")
    return rows.groupBy("bu").agg(
        F.count("*").alias("catalogued"),
        F.count_if(scope_).alias("in_scope"),
        F.count_if(alive).alias("supported"),
        F.count_if(eligible).alias("eligible"),
        *[F.count_if(eligible & F.coalesce(F.col(s), F.lit(False))).alias(s) for s in ("downloaded", "extracted", "converted")],
    )


def engine_histogram(versions: DataFrame) -> DataFrame:
    return versions.groupBy(F.coalesce("engine", F.lit("undetermined")).alias("engine")).agg(F.count("*").alias("n"), F.count_if(F.col("convert_eligible")).alias("eligible"))


def batch_counts(versions: DataFrame) -> DataFrame:
    return versions.where("batch is not null and batch <> ''").groupBy("batch").agg(F.count("*").alias("n")).orderBy("batch")


def triage_summary(products: DataFrame, sources: list[str]) -> DataFrame:
    """Counts of each known source, zeroes too."""
    spark = products.sparkSession
    domain = spark.createDataFrame([(s,) for s in sources], "family_source string")
    counts = products.groupBy("family_source").agg(F.count("*").alias("n"))
    return F.broadcast(domain).join(counts, "family_source", "left").select("family_source", F.coalesce("n", F.lit(0)).alias("n"))


def retirement_effect(versions: DataFrame) -> DataFrame:
    """Products whose every convertible version is retired."""
    return versions.where("convert_eligible").groupBy("slug").agg(F.count("*").alias("n"), F.bool_and(F.col("release_status") == "retired").alias("all_retired")).where("all_retired").select("slug", "n")


def family_sizes(products: DataFrame) -> DataFrame:
    """Each product with its family's size; counted first, then joined, so a large family is no window's burden."""
    sizes = products.groupBy("bu", "family").agg(F.count("*").alias("family_products"))
    return products.select("slug", "bu", "family").join(sizes, ["bu", "family"])


def set_field(table: DataFrame, where: Column, field: str, value: Column, source: str) -> DataFrame:
    """Update by key; a value that is set by hand says so in its source column."""
    return table.withColumns({field: F.when(where, value).otherwise(F.col(field)), source: F.when(where, F.lit("manual")).otherwise(F.col(source))})


def write_back(table: DataFrame, updates: DataFrame, keys: list[str], field: str, source: str) -> DataFrame:
    """Updates apply unless the value is manual."""
    u = updates.select(*keys, F.col(field).alias("_u"), F.lit(True).alias("_has"))
    joined = table.join(u, keys, "left")
    return joined.withColumn(field, F.when(F.coalesce("_has", F.lit(False)) & (F.col(source) != "manual"), F.col("_u")).otherwise(F.col(field))).drop("_u", "_has")


def integrity(products: DataFrame, versions: DataFrame) -> DataFrame:
    """Broken rules of the catalog: duplicate keys, versions without product, eligible without address."""
    duplicate = versions.groupBy("slug", "version").agg(F.count("*").alias("n")).where("n > 1").select(F.lit("duplicate").alias("rule"), "slug", "version")
    orphan = versions.join(products, "slug", "left_anti").select(F.lit("orphan").alias("rule"), "slug", "version")
    no_url = versions.where("convert_eligible and zip_url is null").select(F.lit("no address").alias("rule"), "slug", "version")
    return duplicate.unionByName(orphan).unionByName(no_url)


def soft_warnings(products: DataFrame, versions: DataFrame) -> DataFrame:
    rows = versions.join(products.select("slug", "in_scope"), "slug").where("batch is not null")
    kinds = F.array_compact(F.array(F.when(~F.col("in_scope"), "out of scope"), F.when(F.col("release_status") == "retired", "retired"), F.when(~F.col("convert_eligible"), "ineligible")))
    return rows.select("slug", "version", F.explode(kinds).alias("warning"))


def derived_pair(versions: DataFrame) -> DataFrame:
    """A truth value follows its count; a count never taken leaves it unknown."""
    return versions.select("slug", "version", "topics", (F.col("topics") > 0).alias("has_topics"))


def duplicate_names(products: DataFrame) -> DataFrame:
    """Families of one unit whose repositories would have one name."""
    name = F.concat_ws("-", "bu", F.regexp_replace("family", "[^a-z]", ""))
    return products.select("bu", "family", name.alias("name")).distinct().groupBy("bu", "name").agg(F.count("*").alias("families")).where("families > 1")


def coverage_ratio(products: DataFrame, report: DataFrame) -> DataFrame:
    have = products.join(report.select("slug").distinct().withColumn("_h", F.lit(True)), "slug", "left")
    return have.agg(F.count("_h").alias("with_data"), F.count("*").alias("products"))


def cascade(products: DataFrame, by_family: DataFrame, by_unit: DataFrame, field: str, default: object) -> DataFrame:
    """Defaults < unit < family < product, key by key."""
    out = products.join(by_family.select("family", F.col(field).alias("_f")), "family", "left").join(by_unit.select("bu", F.col(field).alias("_u")), "bu", "left")
    return out.select("slug", F.coalesce(F.col(field), "_f", "_u", F.lit(default)).alias(field))


def adjacent(versions: DataFrame) -> DataFrame:
    """Each version with the next newer one of its product, in natural order."""
    order = Window.partitionBy("slug").orderBy(natural_key(F.col("version")), "version")
    return versions.select("slug", "version", F.lead("version").over(order).alias("newer")).where("newer is not null")


def listed_order(versions: DataFrame) -> DataFrame:
    """Place in a drop-down: numeric versions newest first, then the others by name."""
    numeric = is_numeric_version(F.col("version"))
    order = Window.partitionBy("slug").orderBy(numeric.desc(), F.when(numeric, natural_key(F.col("version"))).desc(), F.lower("version"))
    return versions.select("slug", "version", F.row_number().over(order).alias("place"))


def archive_list(versions: DataFrame) -> DataFrame:
    return versions.where("is_archived").select("slug", "version", F.coalesce("zip_url", F.lit("local")).alias("address"), "release_date").orderBy(F.desc("release_date"), "slug", "version")


def upsert(table: DataFrame, changes: DataFrame, keys: list[str]) -> DataFrame:
    """Insert or update by key; only fields that are supplied (not null) change."""
    fields = [c for c in table.columns if c not in keys]
    c = changes.select(*keys, *[F.col(f).alias(f"_{f}") for f in fields if f in changes.columns])
    return table.join(c, keys, "full").select(*keys, *[F.coalesce(f"_{f}", f).alias(f) if f in changes.columns else F.col(f) for f in fields])


def replace_partition(table: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the given keys are replaced as a whole."""
    return table.join(rows.select(*keys).distinct(), keys, "left_anti").unionByName(rows)
