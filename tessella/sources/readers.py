"""Readers of the formats that documentation comes in. Files are read by Spark, so any store works."""

from __future__ import annotations

import io
import json
import re
import zipfile
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tessella.functions import paths as P

ENTRY = T.ArrayType(T.StructType([T.StructField("depth", T.IntegerType()), T.StructField("title", T.StringType()), T.StructField("path", T.StringType())]))


def csv(spark: SparkSession, path: str) -> DataFrame:
    """Every column as text, blank for null; a byte-order mark is read over."""
    df = spark.read.csv(path, header=True, inferSchema=False, multiLine=True, escape='"', encoding="UTF-8")
    names = [c.lstrip("﻿").strip().lower() for c in df.columns]
    return df.toDF(*names).na.fill("")


@F.pandas_udf(T.StringType())
def decoded(content: pd.Series) -> pd.Series:
    """UTF-8 with or without a mark, else Windows-1252; what is neither is null."""

    def one(b):
        if b is None:
            return None
        for charset in ("utf-8-sig", "cp1252"):
            try:
                return b.decode(charset)
            except UnicodeDecodeError:
                pass
        return None

    return content.map(one)


def first_of(*cells: Column) -> Column:
    """The first of several cells that isn't blank."""
    return F.coalesce(*[F.when(F.trim(c) != "", F.trim(c)) for c in cells])


def unwrapped(payload: Column, *keys: str) -> Column:
    """A field of a JSON record, wherever one or two envelopes put it."""
    return first_of(*[F.get_json_object(payload, f"$.{e}{k}") for k in keys for e in ("result.product.", "result.", "product.", "")])


def crawled(records: DataFrame) -> DataFrame:
    """One row a slug, unless every record is hidden: its first visible record and its greatest version count.

    records: slug, pos, visible (null is visible), name, versions.
    """
    shown = F.coalesce("visible", F.lit(True))
    out = records.groupBy("slug").agg(F.bool_or(shown).alias("_any"), F.min_by("name", F.when(shown, F.col("pos"))).alias("name"), F.max("versions").alias("versions"))
    return out.where("_any").drop("_any")


def sitemap(xml: Column) -> Column:
    """Entries of a sitemap or an index of sitemaps: loc, lastmod."""
    blocks = F.regexp_extract_all(xml, F.lit(r"(?s)<(?:url|sitemap)>(.*?)</(?:url|sitemap)>"), F.lit(1))
    return F.transform(blocks, lambda b: F.struct(F.trim(F.regexp_extract(b, r"(?s)<loc>(.*?)</loc>", 1)).alias("loc"), F.trim(F.regexp_extract(b, r"(?s)<lastmod>(.*?)</lastmod>", 1)).alias("lastmod")))


def changed(index: DataFrame, manifest: DataFrame) -> tuple[DataFrame, DataFrame]:
    """What an incremental walk fetches again, and what it drops. Both: loc, lastmod."""
    return index.join(manifest, ["loc", "lastmod"], "left_anti"), manifest.join(index, "loc", "left_anti")


def archive(files: DataFrame) -> DataFrame:
    """Members of ZIP files: path, member, bytes, crc, unsafe. files: path, content. Nothing is written."""

    def run(batches):
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    rows = [(path, i.filename, i.file_size, i.CRC) for i in z.infolist() if not i.is_dir()]
                yield pd.DataFrame(rows, columns=["path", "member", "bytes", "crc"])

    found = files.select("path", "content").mapInPandas(run, "path string, member string, bytes long, crc long")
    return found.withColumn("unsafe", P.is_unsafe(F.col("member")))


def archive_conflicts(members: DataFrame) -> DataFrame:
    """Names that differ by case alone and aren't the same bytes."""
    return members.groupBy("path", F.lower("member").alias("name")).agg(F.countDistinct("member").alias("names"), F.countDistinct("crc", "bytes").alias("contents")).where("names > 1 and contents > 1")


def listing(spark: SparkSession, root: str) -> DataFrame:
    """Every file under a root: path relative to it, bytes. Contents are not read."""
    df = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    full = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString().rstrip("/")  # as Spark spells it
    return df.select(F.substr("path", F.lit(len(full) + 2)).alias("path"), F.col("length").alias("bytes"))


def published(files: DataFrame) -> DataFrame:
    """Dimensions that a published path states: locale, slug, class, segment."""
    p = F.split("path", "/")
    return files.where(F.size(p) > 4).select("*", p[0].alias("locale"), p[1].alias("slug"), p[2].alias("doc_class"), p[3].alias("segment"))


def _define(text: str) -> list[tuple[int, str, str]]:
    """Entries of a `define({...})` table of contents, by its literals; nothing is run."""
    body = text[text.index("(") + 1 : text.rindex(")")]
    body = re.sub(r"'((?:[^'\\]|\\.)*)'", lambda m: json.dumps(m[1].replace("\\'", "'")), body)
    body = re.sub(r"([{,]\s*)([A-Za-z_$][\w$]*)\s*:", r'\1"\2":', body)
    out: list[tuple[int, str, str]] = []

    def visit(node, depth):
        if isinstance(node, list):
            for x in node:
                visit(x, depth)
        elif isinstance(node, dict):
            if "t" in node or "title" in node:
                out.append((depth, str(node.get("t", node.get("title", ""))), str(node.get("h", node.get("href", "")))))
            for k in ("n", "children", "tree"):
                visit(node.get(k), depth + ("t" in node or "title" in node))

    visit(json.loads(re.sub(r",\s*([}\]])", r"\1", body)), 0)
    return out


def _yaml(text: str) -> list[tuple[int, str, str]]:
    """Both dialects of toc.yml: docs/url/subfolderlist and items/path/children."""
    import yaml

    data = yaml.safe_load(text) or {}
    out: list[tuple[int, str, str]] = []

    def visit(nodes, depth):
        for n in nodes or []:
            out.append((depth, str(n.get("title", "")), str(n.get("url", n.get("path", "")) or "")))
            visit(n.get("subfolderlist", n.get("children")), depth + 1)

    visit(data.get("docs", data.get("items")), 0)
    return out


def _lists(text: str) -> list[tuple[int, str, str]]:
    """Nested ul/li links of an HTML table of contents."""
    out, depth = [], -1
    for m in re.finditer(r"(?is)<(/?)ul\b[^>]*>|<a\b[^>]*href=[\"']([^\"']*)[\"'][^>]*>(.*?)</a>", text):
        if m[2] is None:
            depth += -1 if m[1] else 1
        else:
            out.append((max(depth, 0), re.sub(r"<[^>]*>", "", m[3]).strip(), m[2]))
    return out


#: Readers of tables of contents by the name of their dialect.
TOC = {"define": _define, "yaml": _yaml, "lists": _lists}


def register_toc(name: str, read: Callable[[str], list[tuple[int, str, str]]]) -> None:
    """Add a format of tables of contents: a function from its text to (depth, title, path) in reading order."""
    if TOC.setdefault(name, read) is not read:
        raise ValueError(f"two formats are called {name}")


def toc(text: Column, name: str) -> Column:
    """Entries depth, title, path of a table of contents in a registered dialect; null where it can't be read."""
    read = TOC[name]

    @F.pandas_udf(ENTRY)
    def run(pages: pd.Series) -> pd.Series:
        def one(t):
            try:
                return None if t is None else [{"depth": d, "title": a, "path": b} for d, a, b in read(t)]
            except (ValueError, KeyError, AttributeError, ImportError):
                return None

        return pages.map(one)

    return run(text)


def help_map(text: Column, most: int = 300_000) -> Column:
    """Identifier, link and anchor of each entry of an alias file; null if it is too many bytes to be one (see help_map_status)."""
    rows = F.regexp_extract_all(text, F.lit(r"(<Map\b[^>]*>)"), F.lit(1))
    cell = lambda r, name: F.regexp_extract(r, rf'\b{name}="([^"]*)"', 1)
    entries = F.transform(rows, lambda r: F.struct(cell(r, "Name").alias("ident"), F.split_part(cell(r, "Link"), F.lit("#"), F.lit(1)).alias("link"), F.split_part(cell(r, "Link"), F.lit("#"), F.lit(2)).alias("anchor")))
    return F.when(F.octet_length(text) <= most, entries)


def help_map_status(text: Column, most: int = 300_000) -> Column:
    """unreadable (null), unparseable (too many bytes, or no alias file), empty or ok: the finding beside `help_map`."""
    return F.when(text.isNull(), "unreadable").when((F.octet_length(text) > most) | ~text.rlike(r"(?i)<(map|catapult\w*|alias\w*)\b"), "unparseable").when(F.size(help_map(text, most)) == 0, "empty").otherwise("ok")


def rule_table(spark: SparkSession, text: str, columns: list[str], key: str) -> DataFrame:
    """A small table of rules from a YAML list of mappings, all values strings; a key twice or a row without one is an error.

    A rule file is read on the driver: people write it, some hundred rows.
    """
    import yaml

    rows = yaml.safe_load(text) or []
    if not isinstance(rows, list) or not all(isinstance(r, dict) for r in rows):
        raise ValueError("a rule file is a list of mappings")
    unknown = {c for r in rows for c in r} - set(columns)
    keys = [r.get(key) for r in rows]
    if unknown or None in keys or len(set(keys)) < len(keys):
        raise ValueError(f"rules need one {key} each, no two alike, and no columns but {columns}; unknown: {sorted(unknown)}")
    return spark.createDataFrame([tuple(None if r.get(c) is None else str(r[c]) for c in columns) for r in rows], ", ".join(f"`{c}` string" for c in columns))


def select(spark: SparkSession, statement: str, **parameters) -> DataFrame:
    """Rows of a parameterised SELECT; parameters are bound as :name, never pasted into the text."""
    return spark.sql(statement, args=parameters)


def pdf_title(title: Column) -> Column:
    """A PDF's title, unless it says nothing."""
    t = F.trim(title)
    return F.when((t != "") & ~F.lower(t).isin("untitled", "microsoft word") & ~t.rlike(r"(?i)\.(docx?|fm|indd|pdf)$") & ~t.rlike(r"(?i)^microsoft word - "), t)


def redirect_map(text: Column) -> Column:
    """from, to of a JSON list of rows or a flat JSON object."""
    listed = F.from_json(text, "array<struct<`from`:string,`to`:string>>")
    flat = F.transform(F.map_entries(F.from_json(text, "map<string,string>")), lambda e: F.struct(e["key"].alias("from"), e["value"].alias("to")))
    return F.when(F.trim(text).startswith("["), listed).otherwise(flat)


def engine(files: DataFrame) -> DataFrame:
    """The generator of each product's files: a marker file first, else a signature in a page. files: slug, path, head."""
    markers = [("flare", r"(?i)(^|/)data/toc[^/]*\.js$"), ("webworks", r"(?i)(^|/)wwhdata/"), ("dita", r"(?i)\.ditamap$"), ("r-help", r"(?i)/00index\.html$")]
    signs = [("flare", "MadCap"), ("webworks", "WebWorks"), ("dita", "DITA")]
    flags = [F.bool_or(F.col("path").rlike(p)).alias(f"m_{i}") for i, (_, p) in enumerate(markers)] + [F.bool_or(F.contains("head", F.lit(s))).alias(f"s_{i}") for i, (_, s) in enumerate(signs)]
    value = F.lit("auto")
    for i, (name, _) in reversed(list(enumerate(signs))):
        value = F.when(F.col(f"s_{i}"), name).otherwise(value)
    for i, (name, _) in reversed(list(enumerate(markers))):
        value = F.when(F.col(f"m_{i}"), name).otherwise(value)
    return files.groupBy("slug").agg(*flags).select("slug", value.alias("engine"))
