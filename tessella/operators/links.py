"""Joins between references, files, help maps and trees."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from tessella.functions import paths as P


def resolve_links(links: DataFrame, files: DataFrame) -> DataFrame:
    """ok, case (only the letters' case differs) or missing for every link. links: lid, target; files: path."""
    exact = files.select(F.col("path").alias("target"), F.lit(True).alias("_x")).distinct()
    folded = files.groupBy(F.lower("path").alias("_l")).agg(F.min("path").alias("hint"))
    found = links.join(exact, "target", "left").join(folded, F.lower("target") == F.col("_l"), "left")
    return found.select("lid", F.when(F.col("_x"), "ok").when(F.col("hint").isNotNull(), "case").otherwise("missing").alias("verdict"), F.when(F.col("_x").isNull(), F.col("hint")).alias("hint"))


def unique_match(wanted: DataFrame, files: DataFrame) -> DataFrame:
    """A file name matches if exactly one file has it, case folded. wanted: name; files: path."""
    by_name = files.groupBy(F.lower(P.leaf(F.col("path"))).alias("_n")).agg(F.count("*").alias("n"), F.min("path").alias("path"))
    return wanted.join(by_name, F.lower("name") == F.col("_n"), "left").select("name", F.when(F.col("n") == 1, F.col("path")).alias("path"))


def owning_root(files: DataFrame, roots: DataFrame) -> DataFrame:
    """The innermost root above each file: ancestors are exploded, so the prefix join is an equi-join."""
    up = files.select("fid", F.explode(P.ancestors(F.col("path"))).alias("root"))
    return up.join(roots.select("root").distinct(), "root").groupBy("fid").agg(F.max_by("root", F.length("root")).alias("root"))


def beneath(files: DataFrame) -> DataFrame:
    """Files and bytes beneath every folder."""
    return files.select(F.explode(P.ancestors(F.col("path"))).alias("folder"), "bytes").groupBy("folder").agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


def longest_suffix(urls: DataFrame, files: DataFrame) -> DataFrame:
    """The file that shares the most trailing path segments with each URL, the least id of several. urls: uid, path.

    Every trailing part of a path is a row, as many as it has segments, so that sharing is an equi-join.
    """

    def tails(df: DataFrame, key: str) -> DataFrame:
        parts = F.split("path", "/")
        return df.select(key, F.explode(F.transform(F.sequence(F.lit(1), F.size(parts)), lambda n: F.struct(n.alias("n"), F.array_join(F.slice(parts, F.size(parts) - n + 1, n), "/").alias("tail")))).alias("t")).select(key, "t.*")

    found = tails(urls, "uid").join(tails(files, "fid").drop("n"), "tail")
    return found.groupBy("uid").agg(F.max("n").alias("shared"), F.max_by("fid", F.struct("n", -F.col("fid"))).alias("fid"))


def nearest_before(rows: DataFrame, group: str, order: str, flag: F.Column, name: str) -> DataFrame:
    """As-of: the order value of the last flagged row before each row of the same group."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(name, F.last(F.when(flag, F.col(order)), ignorenulls=True).over(w))


def map_diff(ids: DataFrame) -> DataFrame:
    """Identifiers dropped, added or retargeted between adjacent releases of a product. ids: slug, release, ident, target."""
    steps = ids.select("slug", "release").distinct().withColumn("next", F.lead("release").over(Window.partitionBy("slug").orderBy("release"))).where("next is not null")
    old = ids.join(steps, ["slug", "release"]).select("slug", F.col("next").alias("release"), "ident", F.col("target").alias("was"))
    new = ids.join(steps.select("slug", F.col("next").alias("release")), ["slug", "release"]).select("slug", "release", "ident", "target")
    verdict = F.when(F.col("target").isNull(), "dropped").when(F.col("was").isNull(), "added").when(F.col("was") != F.col("target"), "retargeted")
    return old.join(new, ["slug", "release", "ident"], "full").select("slug", "release", "ident", verdict.alias("verdict")).where("verdict is not null")


def two_phase(asked: DataFrame, ids: DataFrame) -> DataFrame:
    """An identifier in its own set; else in the other sets, the one with most entries first, ties by name."""
    own = asked.join(ids.select("slug", "ident", F.col("target").alias("own")), ["slug", "ident"], "left")
    rank = ids.groupBy("slug").agg(F.count("*").alias("n"))
    best = ids.join(rank, "slug").groupBy("ident").agg(F.min(F.struct((-F.col("n")).alias("n"), "slug", "target")).alias("b"))
    return own.join(best, "ident", "left").select("slug", "ident", F.coalesce("own", "b.target").alias("target"), F.when(F.col("own").isNotNull(), "own").when(F.col("b").isNotNull(), "sibling").otherwise("missing").alias("via"))


def mirror(map_rows: DataFrame, page_rows: DataFrame) -> DataFrame:
    """What one side says and the other doesn't. Both: ident, page."""
    return map_rows.join(page_rows, ["ident", "page"], "left_anti").withColumn("side", F.lit("map")).unionByName(page_rows.join(map_rows, ["ident", "page"], "left_anti").withColumn("side", F.lit("page")))


def both_ways(rows: DataFrame, folders: DataFrame) -> DataFrame:
    """Rows without folder and folders without row. Both: name."""
    r, f = rows.select("name", F.lit(1).alias("r")), folders.select("name", F.lit(1).alias("f"))
    return r.join(f, "name", "full").where("r is null or f is null").select("name", F.when(F.col("f").isNull(), "no folder").otherwise("no row").alias("verdict"))


def redirects(rows: DataFrame, files: DataFrame) -> DataFrame:
    """missing target, shadowed source, or a loop that differs by case. rows: source, goal; files: path."""
    paths = files.select("path").distinct()
    to = rows.join(paths.select(F.col("path").alias("goal"), F.lit(True).alias("_to")), "goal", "left").join(paths.select(F.col("path").alias("source"), F.lit(True).alias("_from")), "source", "left")
    verdict = F.when(F.lower("source") == F.lower("goal"), "loop").when(F.col("_to").isNull(), "missing").when(F.col("_from"), "shadowed").otherwise("ok")
    return to.select("source", "goal", verdict.alias("verdict"))


def counterparts(pages: DataFrame, folder: str = "lang", base: str = "en") -> DataFrame:
    """Share of each language's pages whose text equals the base language's page of the same key. pages: key, lang, text."""
    b = pages.where(F.col(folder) == base).select("key", F.col("text").alias("_b"))
    return pages.where(F.col(folder) != base).join(b, "key").groupBy(folder).agg(F.count("*").alias("pages"), F.count_if(F.col("text") == F.col("_b")).alias("same")).withColumn("share", F.bround(F.col("same") * 100.0 / F.col("pages")).cast("int"))


def two_hops(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """Nodes reached from each start in one or two steps, each with its least number. edges: a, b; starts: node."""
    e = edges.select("a", "b").distinct()
    one = starts.join(e, F.col("node") == F.col("a")).select("node", F.col("b").alias("to"), F.lit(1).alias("hops"))
    two = one.join(e, F.col("to") == F.col("a")).select("node", F.col("b").alias("to"), F.lit(2).alias("hops"))
    return one.unionByName(two).where("node <> to").groupBy("node", "to").agg(F.min("hops").alias("hops"))


def invert(ids: DataFrame) -> DataFrame:
    return ids.groupBy("slug", "release", "target").agg(F.array_join(F.array_sort(F.collect_set("ident")), " ").alias("idents"))


def suffix_versions(stems: DataFrame, versions: DataFrame) -> DataFrame:
    """An exact stem, else the one stem that ends in the version after something else than a digit. Equi-joins on the tail."""
    exact = versions.join(stems.select(F.col("stem").alias("version"), F.lit(True).alias("_x")).distinct(), "version", "left")
    tails = stems.select("stem", F.regexp_extract("stem", r"^(.*[^0-9.])([0-9][0-9.]*)$", 2).alias("version")).where("version <> ''")
    one = tails.groupBy("version").agg(F.count("*").alias("n"), F.min("stem").alias("stem")).where("n = 1")
    return exact.join(one.select("version", "stem"), "version", "left").select("version", F.when(F.col("_x"), F.col("version")).otherwise(F.col("stem")).alias("stem"))
