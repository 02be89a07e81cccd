"""Typed scans, declared rules and the checks of a published tree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tessella.functions import paths as P, text as X, values as V


def typed(cells: DataFrame) -> DataFrame:
    """Version cells as values: unknown words take their default, the last of equal keys wins. cells: k, order, and the cells."""
    last = cells.groupBy("key").agg(F.max_by(F.struct("bool_cell", "count_cell", "status_cell"), "k").alias("c"), F.count("*").alias("seen"))
    return last.select("key", V.boolean(F.col("c.bool_cell"), False).alias("archived"), V.whole_count(F.col("c.count_cell")).alias("topics"), V.enumeration(F.col("c.status_cell"), ["o", "f"], "unknown").alias("status"), (F.col("seen") > 1).alias("repeated"))


def end_of_support(report: DataFrame, aliases: DataFrame) -> DataFrame:
    """Rows of a report by slug: the reviewed alias of a name, else the name as a slug; verdict conflict where rows disagree."""
    slugs = report.join(aliases.select("name", F.col("slug").alias("_a")), "name", "left").withColumn("slug", F.coalesce("_a", X.slug(F.col("name"), ascii_only=True)))
    return slugs.groupBy("slug", "version").agg(F.when(F.countDistinct("status") > 1, "conflict").otherwise(F.max("status")).alias("status"))


def sheet_slug(url: Column, version: Column) -> Column:
    """The slug that a documentation URL states, without the version at its end."""
    leaf = P.leaf(F.regexp_replace(url, "/+$", ""))
    tail = F.concat(F.lit("-"), F.replace(version, F.lit("."), F.lit("-")))
    return F.when(F.endswith(leaf, tail), F.substring(leaf, F.lit(1), F.length(leaf) - F.length(tail))).otherwise(leaf)


def evidence(state: DataFrame, outputs: DataFrame) -> DataFrame:
    """What is known of each version from two tables, either of which may lack it. Both: slug, version."""
    s, o = state.withColumn("_s", F.lit(True)), outputs.select("slug", "version").distinct().withColumn("_o", F.lit(True))
    return s.join(o, ["slug", "version"], "full").select("slug", "version", F.coalesce("downloaded", F.lit(False)).alias("downloaded"), F.coalesce("_o", F.lit(False)).alias("converted"))


def overlay(primary: DataFrame, locale: DataFrame, shared: list[str]) -> DataFrame:
    """A locale's events: the shared stages from the primary, all others its own."""
    return primary.where(F.col("stage").isin(shared)).unionByName(locale.where(~F.col("stage").isin(shared)))


def derive_template(sources: DataFrame, urls: DataFrame, most_dropped: int = 3, coverage: float = 0.9) -> DataFrame:
    """Prefix and dropped leading folders that turn the most sources into live URLs: drop, prefix, hits, enough.

    Every tail of a source meets every URL that ends in it by an equi-join. sources: sid, path; urls: url (path only).
    """
    parts = F.split("path", "/")
    tails = sources.select("sid", F.posexplode(F.transform(F.sequence(F.lit(0), F.least(F.size(parts) - 1, F.lit(most_dropped))), lambda k: F.array_join(F.slice(parts, k + 1, F.size(parts)), "/"))).alias("drop", "tail"))
    u = F.split("url", "/")
    ends = urls.select(F.explode(F.transform(F.sequence(F.lit(0), F.size(u) - 1), lambda k: F.struct(F.array_join(F.slice(u, F.lit(1), k), "/").alias("prefix"), F.array_join(F.slice(u, k + 1, F.size(u)), "/").alias("tail")))).alias("e")).select("e.*").distinct()
    hits = tails.join(ends, "tail").groupBy("drop", "prefix").agg(F.countDistinct("sid").alias("hits"))
    total = sources.select("sid").distinct().count()
    return hits.withColumn("enough", F.col("hits") >= coverage * total)


def anchor_misses(links: DataFrame, anchors: DataFrame) -> DataFrame:
    """Fragments that a page lacks, with the anchor that differs by case alone. links: lid, page, anchor; anchors: page, anchor."""
    exact = anchors.select("page", "anchor").distinct()
    near = anchors.groupBy("page", F.lower("anchor").alias("_l")).agg(F.min("anchor").alias("near"))
    missed = links.join(exact, ["page", "anchor"], "left_anti").withColumn("_l", F.lower("anchor"))
    return missed.join(near, ["page", "_l"], "left").select("lid", "near")


def owned_merge(existing: DataFrame, generated: DataFrame, owned: DataFrame) -> DataFrame:
    """Generated rows in the place of the first row we own, foreign rows on their side of it. existing: key, pos; generated: key, n.

    Only owned rows go: a foreign row stays even if a generated one has its key.
    """
    first = existing.join(owned, "key", "left_semi").agg(F.min("pos").alias("at"))
    foreign = existing.join(owned, "key", "left_anti").crossJoin(F.broadcast(first))  # one row
    head = foreign.select("key", F.when(F.col("pos") < F.coalesce("at", F.lit(1 << 60)), 0).otherwise(2).alias("side"), F.col("pos").cast("bigint").alias("place"))
    return head.unionByName(generated.select("key", F.lit(1).alias("side"), F.col("n").cast("bigint").alias("place")))


def secondary_copies(files: DataFrame, listed: DataFrame) -> DataFrame:
    """Unlisted files with a listed twin under another root. files: fid, path; listed: fid."""
    tail = F.substring_index("path", "/", -1)
    twins = files.join(listed, "fid", "left_semi").groupBy(tail.alias("tail")).agg(F.min("fid").alias("twin"))
    return files.join(listed, "fid", "left_anti").withColumn("tail", tail).join(twins, "tail").select("fid", "twin")


def inbound(links: DataFrame, files: DataFrame, filed: Column) -> DataFrame:
    """Links from filed pages to unfiled ones."""
    f = files.select("fid", filed.alias("filed"))
    return links.join(f.select(F.col("fid").alias("src"), F.col("filed").alias("_s")), "src").join(f, "fid").where("_s and not filed").select("lid", "src", "fid")


def layout_audit(pages: DataFrame, topics: DataFrame) -> DataFrame:
    """Topics that no page holds or that several do, and pages with unknown topics. pages: page, topic; topics: topic."""
    lost = topics.join(pages, "topic", "left_anti").select("topic", F.lit("lost").alias("fault"))
    many = pages.groupBy("topic").agg(F.countDistinct("page").alias("n")).where("n > 1").select("topic", F.lit("repeated").alias("fault"))
    unknown = pages.join(topics, "topic", "left_anti").select("topic", F.lit("unknown").alias("fault")).distinct()
    return lost.unionByName(many).unionByName(unknown)


def outermost(folders: DataFrame) -> DataFrame:
    """Roots that have no other root above them. folders: root."""
    up = folders.select(F.col("root").alias("_r"), F.explode(P.ancestors(F.col("root"))).alias("root"))
    inner = up.join(folders, "root", "left_semi").select(F.col("_r").alias("root"))
    return folders.select("root").distinct().join(inner, "root", "left_anti")


def confirm(table: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """fixed becomes confirmed for the given keys; all else stays."""
    k = keys.select(on).distinct().withColumn("_k", F.lit(True))
    return table.join(k, on, "left").withColumn("state", F.when(F.col("_k") & (F.col("state") == "fixed"), "confirmed").otherwise(F.col("state"))).drop("_k")


def declaration(template: Column, drop: Column) -> Column:
    """Why a declared template can't be used, or ''."""
    return F.when(~F.contains(template, F.lit("{path}")), "no path").when(drop.try_cast("int").isNull() | (drop.try_cast("int") < 0), "drop").otherwise("")


def own_language(pages: DataFrame, locale: str) -> DataFrame:
    """Pages of one language, if a list names several; otherwise all. pages: site, path."""
    lang = F.regexp_extract("path", "^([a-z]{2}-[a-z]{2})/", 1)
    named = pages.withColumn("_l", lang)
    other = named.groupBy("site").agg(F.bool_or((F.col("_l") != "") & (F.col("_l") != locale)).alias("_o"))
    return named.join(other, "site").where(~F.col("_o") | (F.col("_l") == locale)).select("site", "path")


def ordinal_runs(items: DataFrame, group: str) -> DataFrame:
    """Numbered items as runs: a run goes on while each number is its predecessor's successor and no heading lies between."""
    w = Window.partitionBy(group).orderBy("pos")
    head = F.sum(F.when(F.col("heading"), 1).otherwise(0)).over(w)
    numbered = items.withColumn("_h", head).where("not heading")
    new = F.when((F.col("number") == F.lag("number").over(w) + 1) & (F.col("_h") == F.lag("_h").over(w)), 0).otherwise(1)
    return numbered.withColumn("_n", new).withColumn("run", F.sum("_n").over(w)).groupBy(group, "run").agg(F.min("pos").alias("first"), F.count("*").alias("items"))


def row_groups(rows: DataFrame, table: str, full: Column) -> DataFrame:
    """A row over the full width starts a group."""
    w = Window.partitionBy(table).orderBy("pos")
    return rows.withColumn("group", F.sum(F.when(full, 1).otherwise(0)).over(w)).select(table, "pos", "group")


def roman(text: Column) -> Column:
    """The value of a lower-case Roman numeral up to 39, or null; what isn't one is no error."""
    valid = text.rlike("^(x{0,3})(ix|iv|v?i{0,3})$") & (text != "")
    digits = F.transform(F.split(text, ""), lambda c: F.when(c == "x", 10).when(c == "v", 5).when(c == "i", 1).otherwise(0))
    return F.when(valid, F.aggregate(digits, F.struct(F.lit(0).alias("sum"), F.lit(99).alias("before")), lambda a, d: F.struct((a["sum"] + d - F.when(d > a["before"], 2 * a["before"]).otherwise(0)).alias("sum"), d.alias("before")))["sum"])


def twins(topics: DataFrame) -> DataFrame:
    """Topics whose name differs from another's by a _unique_N ending; the least name stays. topics: fid, name."""
    base = F.regexp_replace("name", r"_unique_\d+$", "")
    kept = topics.groupBy(base.alias("base")).agg(F.min("name").alias("kept"), F.count("*").alias("n")).where("n > 1")
    return topics.withColumn("base", base).join(kept, "base").where("name <> kept").select("fid", "kept")


def publish(built: DataFrame, placed: DataFrame) -> DataFrame:
    """synced, current, or maps refreshed where the content is the same and the map isn't. Both: name, digest, maps."""
    p = placed.select("name", F.col("digest").alias("_d"), F.col("maps").alias("_m"))
    return built.join(p, "name", "left").select("name", F.when(F.col("_d").isNull() | (F.col("_d") != F.col("digest")), "synced").when(F.col("_m") != F.col("maps"), "maps refreshed").otherwise("current").alias("outcome"))


def repaired(pages: DataFrame, key: str, text: str, pattern: str, by: str) -> DataFrame:
    """Matching text rewritten, with how often."""
    return pages.select(key, F.regexp_replace(text, pattern, by).alias("text"), F.regexp_count(text, F.lit(pattern)).alias("n")).where("n > 0")


def merged_page(topics: DataFrame, page: str) -> DataFrame:
    """Topics of a page one after another, in order. topics: page, pos, text."""
    return topics.groupBy(page).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "text"))), lambda t: t["text"]), "\n\n").alias("text"))
