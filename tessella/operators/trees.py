"""Trees as adjacency rows: walks, paths, comparison, packing into pages."""

from __future__ import annotations

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tessella.storage import written


def walk(nodes: DataFrame, most: int = 64) -> DataFrame:
    """Depth and the path of positions from the root, level by level; sorted by path it is the pre-order.

    nodes: node, parent (null for a root), pos, title. A level is one join with the level above, which has been written, so
    that no level computes another anew; levels stop when none is left.
    """
    at = written(nodes.where("parent is null").select("node", F.lit(0).alias("depth"), F.array(F.col("pos")).alias("path"), F.array(F.col("title")).alias("trail")), "tree-level")
    out = at
    for depth in range(1, most):
        below = nodes.alias("n").join(at.alias("p"), F.col("n.parent") == F.col("p.node"))
        at = written(below.select(F.col("n.node"), F.lit(depth).alias("depth"), F.concat("p.path", F.array(F.col("n.pos"))).alias("path"), F.concat("p.trail", F.array(F.col("n.title"))).alias("trail")), "tree-level")
        if at.isEmpty():
            return out
        out = out.unionByName(at)
    raise ValueError(f"deeper than {most} levels, or a cycle")


def depth_first(nodes: DataFrame) -> DataFrame:
    """Each node's depth and breadcrumb."""
    return walk(nodes).select("node", "depth", F.array_join("trail", " > ").alias("breadcrumb"))


def section(nodes: DataFrame, depth: int = 2) -> DataFrame:
    """The title of each node's ancestor at a depth, or its own above that."""
    return walk(nodes).select("node", F.element_at("trail", F.least(F.size("trail"), F.lit(depth + 1))).alias("section"))


def folded(nodes: DataFrame) -> DataFrame:
    """Children that only repeat their parent's title."""
    p = nodes.select(F.col("node").alias("parent"), F.lower("title").alias("_t"))
    return nodes.join(p, "parent").where(F.lower("title") == F.col("_t")).select("node")


def children(nodes: DataFrame) -> DataFrame:
    """The list of links on a page that has only a title: its children in order."""
    return nodes.where("parent is not null").groupBy(F.col("parent").alias("node")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "title"))), lambda c: c["title"]), " | ").alias("links"))


def compare(old: DataFrame, new: DataFrame) -> DataFrame:
    """missing, moved (another parent) or retitled, by page; a moved page is not also retitled. Both: node, parent, title."""
    n = new.select("node", F.col("parent").alias("_p"), F.col("title").alias("_t"), F.lit(True).alias("_is"))
    verdict = F.when(F.col("_is").isNull(), "missing").when(~F.col("parent").eqNullSafe(F.col("_p")), "moved").when(F.col("title") != F.col("_t"), "title")
    return old.join(n, "node", "left").select("node", verdict.alias("verdict")).where("verdict is not null")


def out_of_order(old: DataFrame, new: DataFrame) -> DataFrame:
    """Parents whose common children stand in another order. Both: node, parent, pos."""
    both = old.select("node", "parent", "pos").join(new.select("node", F.col("parent").alias("_p"), F.col("pos").alias("_pos")), "node").where(F.col("parent") == F.col("_p"))
    places = F.transform(F.array_sort(F.collect_list(F.struct("pos", "_pos"))), lambda s: s["_pos"])
    return both.groupBy("parent").agg(places.alias("a")).where(F.col("a") != F.array_sort("a")).select("parent")


def pack(nodes: DataFrame, group: str, most: int) -> DataFrame:
    """Consecutive rows of a group share a page until its words would exceed `most`; one long row is a page alone.

    A running sum that starts over is not a window: sorted rows pass through one scan, which holds two numbers at a time
    and no group, however large.
    """

    def run(batches):
        now, page, total = None, 0, 0
        for batch in batches:
            pages = []
            for key, words in zip(batch.column(0).to_pylist(), batch.column(3).to_pylist()):
                if (key,) != now:
                    now, page, total = (key,), 0, 0
                elif total > 0 and total + words > most:
                    page, total = page + 1, 0
                total += words
                pages.append(page)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(pages, pa.int64())], names=[group, "node", "page"])

    schema = T.StructType([nodes.schema[group], nodes.schema["node"], T.StructField("page", T.LongType())])
    return nodes.select(group, "pos", "node", "words").repartition(group).sortWithinPartitions(group, "pos").mapInArrow(run, schema)


def unique_names(rows: DataFrame, group: str) -> DataFrame:
    """Names made distinct, case folded, with -2, -3, ... until one is free; a suffixed name may be taken too."""

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        taken, out = set(), []
        for name in pdf.sort_values("pos")["name"]:
            n, candidate = 1, name
            while candidate.lower() in taken:
                n += 1
                candidate = f"{name}-{n}"
            taken.add(candidate.lower())
            out.append(candidate)
        return pdf.sort_values("pos").assign(name=out)[[group, "pos", "name"]]

    schema = f"{group} {rows.schema[group].dataType.simpleString()}, pos {rows.schema['pos'].dataType.simpleString()}, name string"
    return rows.select(group, "pos", "name").groupBy(group).applyInPandas(one, schema)


def orphans(files: DataFrame, listed: DataFrame) -> DataFrame:
    """Files that no tree lists."""
    return files.join(listed, "fid", "left_anti")
