"""Whole stages as DataFrame pipelines: what is extracted, converted, verified; and the marker of a build under way."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tessella.functions import paths as P
from tessella.operators import documents as D, html as H, markdown as M


def inventory(files: DataFrame, markers: list[str]) -> DataFrame:
    """slug, part, category, files, bytes of each product's files. files: slug, path, bytes.

    A folder that holds a marker file makes everything below it an API; everything else is content. Names alone never do.
    """
    roots = files.where(F.lower(P.leaf(F.col("path"))).isin(markers)).select("slug", P.parent(F.col("path")).alias("root")).distinct()
    up = files.select("slug", "path", F.explode(P.ancestors(F.col("path"))).alias("root")).join(roots, ["slug", "root"]).select("slug", "path").distinct().withColumn("_api", F.lit(True))
    return files.join(up, ["slug", "path"], "left").groupBy("slug", F.when(F.col("_api"), "api").otherwise("content").alias("part"), category(F.col("path")).alias("category")).agg(F.count("*").alias("files"), F.sum("bytes").alias("bytes"))


#: What a file is by its suffix.
SUFFIXES = {
    "topic": ["htm", "html", "xhtml"],
    "image": ["png", "gif", "jpg", "jpeg", "svg", "bmp"],
    "media": ["mp4", "webm", "mp3", "swf"],
    "document": ["pdf", "doc", "docx", "xls", "xlsx", "ppt", "pptx", "txt", "md"],
    "archive": ["zip", "gz", "tar", "tgz", "jar", "war"],
    "source": ["fm", "dita", "ditamap", "flprj", "wep", "book", "xml"],
    "skin": ["css", "js", "ico", "woff", "woff2", "ttf", "eot"],
}


def category(path: Column) -> Column:
    suffix = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    out = None
    for name, suffixes in SUFFIXES.items():
        out = F.when(suffix.isin(suffixes), name) if out is None else out.when(suffix.isin(suffixes), name)
    return out.otherwise("other")


def extracted(versions: DataFrame, members: DataFrame, state: DataFrame) -> DataFrame:
    """slug, version, outcome: missing (no archive), unchanged (its checksum is the one extracted last), unsafe, conflict, extracted.

    versions: slug, version, checksum (null without an archive); members: slug, version, member, bytes, crc, unsafe; state: slug,
    version, done.
    """
    names = members.groupBy("slug", "version", F.lower("member").alias("name")).agg(F.max("unsafe").alias("unsafe"), F.countDistinct("member").alias("names"), F.countDistinct("crc", "bytes").alias("contents"))
    bad = names.groupBy("slug", "version").agg(F.max("unsafe").alias("unsafe"), F.bool_or((F.col("names") > 1) & (F.col("contents") > 1)).alias("conflict"))
    outcome = F.when(F.col("checksum").isNull(), "missing").when(F.col("checksum") == F.col("done"), "unchanged").when(F.col("unsafe"), "unsafe").when(F.col("conflict"), "conflict").otherwise("extracted")
    return versions.join(state, ["slug", "version"], "left").join(bad, ["slug", "version"], "left").select("slug", "version", outcome.alias("outcome"))


def converted(pages: DataFrame, dialect: str = "plain") -> DataFrame:
    """page, text: HTML pages as Markdown, with links between them renamed as the pages are. pages: page, html."""
    text = pages.select("page", H.to_markdown(F.col("html"), dialect).alias("text"))
    targets = text.select("page", F.explode(F.transform(M.references(F.col("text")), lambda r: F.split_part(r["raw"], F.lit("#"), F.lit(1)))).alias("target")).distinct()
    known = pages.select(F.col("page").alias("target"), P.to_markdown(F.col("page")).alias("new"))
    out = M.retarget(text, targets.join(known, "target"))
    return out.select(P.to_markdown(F.col("page")).alias("page"), "text")


def converted_units(pages: DataFrame, engines: DataFrame) -> DataFrame:
    """Pages with their Markdown, each in its unit's dialect; `auto` and unknown generators are plain. pages: slug, html; engines: slug, engine.

    One pass for each registered dialect over the pages of its own units; no page is parsed twice.
    """
    known = engines.withColumn("engine", F.when(F.col("engine").isin(list(H.DIALECTS)), F.col("engine")).otherwise("plain"))
    marked, out = pages.join(known, "slug"), None
    for name in H.DIALECTS:
        part = marked.where(F.col("engine") == name).withColumn("markdown", H.to_markdown(F.col("html"), name))
        out = part if out is None else out.unionByName(part)
    return out


def verified(source: DataFrame, target: DataFrame, images: DataFrame, target_images: DataFrame) -> DataFrame:
    """folder, pages, words, percent, missing (sentences), images (lost), outcome, by folder of the source pages.

    source, target: key, blocks, the source with its folder; images: key, folder, digest; target_images: digest. Lost pictures
    are errors, lost sentences warnings.
    """
    texts = D.coverage(source, target, "key").join(source.select("key", "folder"), "key").groupBy("folder").agg(F.count("*").alias("pages"), F.sum("words").alias("words"), F.sum("present").alias("present"), F.sum("missing").alias("missing"))
    lost = images.join(target_images.select("digest").distinct(), "digest", "left_anti").groupBy("folder").agg(F.count("*").alias("images"))
    out = texts.join(lost, "folder", "left").withColumn("images", F.coalesce("images", F.lit(0).cast("long")))
    outcome = F.when(F.col("images") > 0, "lost").when(F.col("missing") > 0, "issues").otherwise("clean")
    return out.select("folder", "pages", "words", D.percent(F.col("present"), F.col("words")).alias("percent"), "missing", "images", outcome.alias("outcome"))


def building(events: DataFrame) -> DataFrame:
    """slug, version, stage of builds that began and neither ended nor failed since. events: slug, version, stage, mark, at."""
    last = events.groupBy("slug", "version", "stage").agg(F.max_by("mark", F.struct("at", F.col("mark") != "begin")).alias("mark"))
    return last.where("mark = 'begin'").drop("mark")


def asset_copies(refs: DataFrame, files: DataFrame) -> DataFrame:
    """path, bytes, pages, found: each picture that pages use, once, with what is to be copied. refs: page, path; files: path, bytes."""
    used = refs.groupBy("path").agg(F.countDistinct("page").alias("pages"))
    return used.join(files.select("path", "bytes"), "path", "left").select("path", "bytes", "pages", F.col("bytes").isNotNull().alias("found"))


def metadata_finding(text: Column, key: str) -> Column:
    """What is wrong with a metadata file: no mapping, no key, an empty key; null if nothing is."""
    line = F.regexp_extract(text, rf"(?m)^{key}[ \t]*:[ \t]*(.*?)[ \t]*$", 1)
    has = text.rlike(rf"(?m)^{key}[ \t]*:")
    value = F.regexp_replace(line, r"""^(["'])(.*)\1$""", "$2")
    return F.when(text.isNull() | ~text.rlike(r"(?m)^[A-Za-z_][\w-]*[ \t]*:"), "no mapping").when(~has, F.lit(f"no {key}")).when(F.trim(value) == "", F.lit(f"{key} is empty"))
