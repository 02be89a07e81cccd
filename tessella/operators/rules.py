"""Small rules of a documentation set: what is listed, measured, flagged, ordered, named."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window, functions as F

from tessella.functions import paths as P, text as X
from tessella.operators import markdown as M

#: The folder of pages that no tree lists, where assets are served, how long a published path can be.
UNFILED, ASSETS, PATH_LIMIT = "unfiled", "/content/dam/", 259


def listed(is_archived: Column, convert_eligible: Column) -> Column:
    """Whether a version stands in the drop-down: not archived, or still converted. Nulls count as false."""
    return ~F.coalesce(is_archived, F.lit(False)) | F.coalesce(convert_eligible, F.lit(False))


def is_unfiled(path: Column) -> Column:
    return F.split_part(F.replace(path, F.lit("\\"), F.lit("/")), F.lit("/"), F.lit(1)) == UNFILED


def is_asset_target(target: Column) -> Column:
    return target.startswith(ASSETS)


def is_skin(path: Column, engine: Column, prefixes: dict[str, list[str]]) -> Column:
    """Whether a file is a generator's own chrome: a folder prefix of its engine, letters' case aside."""
    out = F.lit(False)
    for name, folders in prefixes.items():
        hit = F.lit(False)
        for folder in folders:
            hit = hit | F.lower(path).startswith(folder.lower())
        out = F.when(engine == name, hit).otherwise(out)
    return out


def path_lengths(files: DataFrame, limit: int = PATH_LIMIT) -> DataFrame:
    """over (how many paths are longer than the limit), longest, path (the first of the longest). files: path."""
    size = F.length("path")
    return files.agg(F.count_if(size > limit).alias("over"), F.max(size).alias("longest"), F.min_by("path", F.struct(-size, F.col("path"))).alias("path"))


def outcome(errors: Column, warnings: Column, explained: Column) -> Column:
    """What a check of a folder came to: lost, issues, explained or clean."""
    return F.when(errors > 0, "lost").when(warnings > 0, "issues").when(explained > 0, "explained").otherwise("clean")


def live_rows(rows: DataFrame, urls: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Redirect rows whose decoded path is listed, those whose isn't, and live pages that no row maps. rows: from; urls: url."""
    key = lambda c: F.lower(P.percent_decode(F.regexp_replace(c, r"^https?://[^/]*", "")))
    live, mine = urls.withColumn("_k", key(F.col("url"))), rows.withColumn("_k", key(F.col("from")))
    return mine.join(live.select("_k").distinct(), "_k", "left_semi").drop("_k"), mine.join(live.select("_k").distinct(), "_k", "left_anti").drop("_k"), live.join(mine.select("_k").distinct(), "_k", "left_anti").select("url")


def pivot_sum(rows: DataFrame, keys: list[str], category: str, value: str, kinds: list[str]) -> DataFrame:
    """One column for each kind: the sum of its values, 0 for none."""
    return rows.groupBy(*keys).agg(*[F.sum(F.when(F.col(category) == k, F.col(value)).otherwise(0)).alias(k) for k in kinds])


def published_counts(files: DataFrame) -> DataFrame:
    """Published folders of each product. files: slug, segment."""
    return files.groupBy("slug").agg(F.countDistinct("segment").alias("folders"))


def buckets(files: DataFrame, keys: list[str]) -> DataFrame:
    """Files and bytes by the keys; together they are all files. files: keys, bytes."""
    return files.groupBy(*keys).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


def measure(files: DataFrame) -> DataFrame:
    """Files and bytes of a tree, 0 and 0 of an empty one."""
    return files.agg(F.count("*").alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


def map_coverage(ids: DataFrame, published: DataFrame) -> DataFrame:
    """slug, idents, pages, dropped: a product's distinct identifiers and pages, and how many identifiers open nothing published.

    ids: slug, ident, target; published: slug, target.
    """
    there = published.select("slug", "target").distinct().withColumn("_t", F.lit(True))
    found = ids.join(there, ["slug", "target"], "left").groupBy("slug", "ident").agg(F.bool_or(F.coalesce("_t", F.lit(False))).alias("open"))
    pages = ids.groupBy("slug").agg(F.countDistinct("target").alias("pages"))
    return found.groupBy("slug").agg(F.count("*").alias("idents"), F.count_if(~F.col("open")).alias("dropped")).join(pages, "slug")


def extraction_totals(versions: DataFrame) -> DataFrame:
    """measured, topics, empty of a run. versions: topics (null where none were counted)."""
    return versions.agg(F.count("topics").alias("measured"), F.sum("topics").alias("topics"), F.count_if(F.col("topics") == 0).alias("empty"))


def outcome_counts(rows: DataFrame, *keys: str) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count("*").alias("n"))


def page_medians(topics: DataFrame) -> DataFrame:
    """page, median_words (truncated), topics, branches. topics: page, words, branch."""
    return topics.groupBy("page").agg(F.floor(F.percentile("words", 0.5)).alias("median_words"), F.count("*").alias("topics"), F.countDistinct("branch").alias("branches"))


def flagged(rows: DataFrame, flags: dict[str, Column]) -> DataFrame:
    """The rows with the names of the flags that they raise, in the flags' order."""
    return rows.withColumn("flags", F.array_compact(F.array(*[F.when(test, F.lit(name)) for name, test in flags.items()])))


def tally(rows: DataFrame, names: Iterable[str]) -> DataFrame:
    """rank, flag, n: rows for each flag in the given order, 0 for one that nothing raises. rows: flags."""
    every = rows.sparkSession.createDataFrame(list(enumerate(names)), "rank int, flag string")
    counts = rows.select(F.explode("flags").alias("flag")).groupBy("flag").agg(F.count("*").alias("n"))
    return F.broadcast(every).join(counts, "flag", "left").select("rank", "flag", F.coalesce("n", F.lit(0)).alias("n"))


def conserved(before: DataFrame, after: DataFrame) -> DataFrame:
    """page, lost: pages whose words aren't those of their topics plus what was added. before: page, words, added; after: page, words."""
    due = before.groupBy("page").agg(F.sum(F.col("words") + F.coalesce("added", F.lit(0))).alias("due"))
    return due.join(after.select("page", F.col("words").alias("has")), "page", "left").select("page", (F.col("due") - F.coalesce("has", F.lit(0))).alias("lost")).where("lost <> 0")


def fingerprint(*cells: Column, length: int = 16) -> Column:
    """A short digest of inputs, nulls told apart from empty texts."""
    return F.substring(F.sha2(F.to_json(F.struct(*[c.alias(f"c{i}") for i, c in enumerate(cells)])), 256), 1, length)


def first_per_key(rows: DataFrame, keys: list[str], order: list[str], last: bool = False) -> DataFrame:
    """One whole row a key: the first by the order, or the last. A partial aggregate, no sort of a group."""
    rest = [c for c in rows.columns if c not in keys]
    pick = (F.max_by if last else F.min_by)(F.struct(*rest), F.struct(*order))
    return rows.groupBy(*keys).agg(pick.alias("_r")).select(*keys, "_r.*").select(*rows.columns)


def document_order(files: DataFrame, set_col: str, kinds: list[str]) -> DataFrame:
    """The files with their place in their set: by the kind's rank (unknown ones last), title, name, without case. files: kind, title, name."""
    rank = F.coalesce(F.when(F.array_position(F.array(*map(F.lit, kinds)), F.col("kind")) > 0, F.array_position(F.array(*map(F.lit, kinds)), F.col("kind"))), F.lit(len(kinds) + 1))
    return files.withColumn("place", F.row_number().over(Window.partitionBy(set_col).orderBy(rank, F.lower("title"), F.lower("name"))))


def set_order(entries: DataFrame, key: str) -> DataFrame:
    """Sets by how many entries they have, most first, then by name: key, n, place."""
    return entries.groupBy(key).agg(F.count("*").alias("n")).orderBy(F.desc("n"), key)


def in_order(*parts: DataFrame) -> DataFrame:
    """The rows of the parts, one part after another, with the part's number as `side`."""
    out = None
    for n, part in enumerate(parts):
        rows = part.withColumn("side", F.lit(n))
        out = rows if out is None else out.unionByName(rows)
    return out


def all_keys(present: DataFrame, wanted: DataFrame) -> DataFrame:
    """Keys of either side, each once, with where they are: both, present, listed."""
    key = present.columns
    sides = present.distinct().withColumn("_p", F.lit(True)).join(wanted.distinct().withColumn("_l", F.lit(True)), key, "full")
    return sides.select(*key, F.when(F.col("_p") & F.col("_l"), "both").when(F.col("_p"), "present").otherwise("listed").alias("side"))


def key_changes(old: DataFrame, new: DataFrame) -> DataFrame:
    """Keys that were dropped or added. Both: the same columns."""
    return all_keys(old, new).where("side <> 'both'").withColumn("change", F.when(F.col("side") == "present", "dropped").otherwise("added")).drop("side")


def api_name(path: Column, containers: list[str]) -> Column:
    """The folders of an API reference without mere containers, joined by hyphens; its last folder if nothing is left."""
    parts = F.split(path, "/")
    kept = F.array_join(F.filter(parts, lambda p: ~F.lower(p).isin(containers)), "-")
    return F.when(kept != "", kept).otherwise(F.element_at(parts, -1))


def share(part: Column, whole: Column) -> Column:
    """A whole percentage, half to even; 0 of nothing."""
    return F.when(whole > 0, F.bround(F.lit(100.0) * part / whole)).otherwise(0).cast("int")


def split_identifier(link: Column) -> Column:
    """path and anchor of a link: what stands before and after its first #."""
    return F.struct(F.split_part(link, F.lit("#"), F.lit(1)).alias("path"), F.regexp_extract(link, r"(?s)#(.*)$", 1).alias("anchor"))


def cut_at(blocks: Column, labels: list[str]) -> Column:
    """The blocks before the first one that is a label (words compared, case aside); all if none is."""
    plain = F.transform(blocks, lambda b: F.trim(F.regexp_replace(F.lower(b), "[^a-z0-9]+", " ")))
    first = F.array_min(F.filter(F.transform(plain, lambda b, i: F.when(b.isin(labels), i)), lambda i: i.isNotNull()))
    return F.when(first.isNull(), blocks).otherwise(F.slice(blocks, F.lit(1), F.coalesce(first, F.lit(0))))


def single(rows: DataFrame) -> DataFrame:
    """A layout without merging: one page for each topic of a guide, where it first occurs. rows: guide, source, pos."""
    return rows.groupBy("guide", "source").agg(F.min("pos").alias("pos"))


def unindexed(files: DataFrame, links: DataFrame) -> DataFrame:
    """Files that a folder's index doesn't link to, letters' case aside. files: path; links: target."""
    return files.join(links.select(F.lower("target").alias("_l")).distinct(), F.lower("path") == F.col("_l"), "left_anti")


def external_urls(pages: DataFrame) -> DataFrame:
    """Each web address that Markdown pages refer to, once, with how many pages do. pages: page, text."""
    refs = pages.select("page", F.explode(M.references(F.col("text"))).alias("r")).select("page", F.col("r.raw").alias("url"))
    return refs.where(F.lower("url").rlike("^https?://")).groupBy("url").agg(F.countDistinct("page").alias("pages"))


def rename_rows(pages: DataFrame, topics: DataFrame) -> DataFrame:
    """source, page, trail, cut: a row for each topic of a page, and whether the page's name was cut. pages: page, trail, full; topics: page, source."""
    cut = X.page_stem(F.col("full"), F.lit(""), 10_000) != X.page_stem(F.col("full"), F.lit(""))
    return topics.join(pages.withColumn("cut", cut), "page").select("source", "page", "trail", "cut")
