"""From topics to pages: navigation compared and laid out, names and anchors, moves, redirects, merged bodies.

Trees are rows (tree, node, parent, pos, title, page). Where a rule depends on what was taken before it (greedy matches,
names, pins) one tree is one group of a pandas function; a tree is one version's table of contents, some thousand rows.
"""

from __future__ import annotations


import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tessella.functions import paths as P, text as X
from tessella.operators import markdown as M, trees
from tessella.operators.documents import heading_anchors

TOP = -1


def _words(title: str) -> str:
    return " ".join("".join(c if c.isalnum() else " " for c in title.lower()).split())


def _below(rows) -> dict:
    """Rows, in order, by parent; the parent of top rows is TOP."""
    out: dict = {}
    for r in rows:
        out.setdefault(TOP if r["parent"] is None else r["parent"], []).append(r)
    return out


def compare_titles(local: DataFrame, served: DataFrame) -> DataFrame:
    """tree, kind, path of each difference between a table of contents and the menu that is served, matched by titles.

    Siblings match in order, each the first free one of its title. Without one: the same title elsewhere is `moved`, the
    free sibling at the same place `title`, else the row is `missing` and nothing below it is looked at. Matched siblings
    in another order are one `order` of their parent. Both: tree, node, parent, pos, title.
    """

    def one(mine, theirs) -> list[dict]:
        rows, menu, found = _below(mine), _below(theirs), []
        anywhere: dict[str, list] = {}
        todo = list(reversed(menu.get(TOP, [])))
        while todo:
            r = todo.pop()
            anywhere.setdefault(_words(r["title"]), []).append(r)
            todo += reversed(menu.get(r["node"], []))

        def level(parent, twin_parent, trail) -> None:
            used, order, siblings = set(), [], menu.get(twin_parent, [])
            for i, r in enumerate(rows.get(parent, [])):
                path, title = " > ".join([*trail, r["title"]]), _words(r["title"])
                at = next((j for j, s in enumerate(siblings) if s["node"] not in used and _words(s["title"]) == title), None)
                if at is not None:
                    twin = siblings[at]
                    order.append(at)
                else:
                    twin, kind = next((s for s in anywhere.get(title, []) if s["node"] not in used), None), "moved"
                    if twin is None and i < len(siblings) and siblings[i]["node"] not in used:
                        twin, kind = siblings[i], "title"
                    found.append({"kind": kind if twin is not None else "missing", "path": path})
                    if twin is None:
                        continue
                used.add(twin["node"])
                level(r["node"], twin["node"], [*trail, r["title"]])
            if order != sorted(order):
                found.append({"kind": "order", "path": " > ".join(trail) or "(top)"})

        level(TOP, TOP, [])
        return found

    def run(mine: pd.Series, theirs: pd.Series) -> pd.Series:
        return pd.Series([one(m, [] if t is None else t) for m, t in zip(mine, theirs)], dtype=object)

    whole = lambda df, name: df.groupBy("tree").agg(F.array_sort(F.collect_list(F.struct("pos", "node", "parent", "title"))).alias(name))
    both = whole(local, "_mine").join(whole(served, "_theirs"), "tree", "left")
    judged = F.pandas_udf(run, "array<struct<kind:string,path:string>>")(F.col("_mine"), F.col("_theirs"))
    return both.select("tree", F.explode(judged).alias("e")).select("tree", "e.*")


def tail_pages(rows: DataFrame, is_tail: Column, most: int = 2) -> DataFrame:
    """tree, page, rank of the last top rows, at most `most`, that all are tail pages without pages of their own below."""
    inner = rows.where("parent is not null").groupBy("tree", F.col("parent").alias("node")).agg(F.count_if(F.col("page").isNotNull()).alias("inner"))
    top = rows.where("parent is null").withColumn("tail", is_tail & F.col("page").isNotNull()).join(inner, ["tree", "node"], "left")
    last = top.withColumn("from_end", F.row_number().over(Window.partitionBy("tree").orderBy(F.desc("pos")))).where(F.col("from_end") <= most)
    ok = F.min((F.col("tail") & (F.coalesce("inner", F.lit(0)) == 0)).cast("int")).over(Window.partitionBy("tree").orderBy("from_end"))
    return last.withColumn("ok", ok).where("ok = 1").select("tree", "page", (-F.col("from_end")).alias("rank"))


def tail_moved(old: DataFrame, tails: DataFrame) -> DataFrame:
    """The old tree with each tail page's first row at the top's end, its other rows gone. old: tree, node, parent, pos, title, page.

    Only rows that open the page and have no rows below them are taken.
    """
    leaf = old.select("tree", F.col("parent").alias("node")).where("node is not null").distinct().withColumn("_inner", F.lit(True))
    hits = old.join(leaf, ["tree", "node"], "left").join(tails, ["tree", "page"], "left")
    hit = F.col("rank").isNotNull() & F.col("_inner").isNull()
    first = F.row_number().over(Window.partitionBy("tree", "page", hit).orderBy("pos"))
    end = F.max("pos").over(Window.partitionBy("tree"))
    placed = hits.withColumn("_hit", hit).withColumn("_first", first).withColumn("_end", end).where("not _hit or _first = 1")
    return placed.select("tree", "node", F.when(~F.col("_hit"), F.col("parent")).alias("parent"), F.when(F.col("_hit"), F.col("_end") + 10 + F.col("rank")).otherwise(F.col("pos")).alias("pos"), "title", "page")


def project(reference: DataFrame, rows: DataFrame, most: int) -> DataFrame:
    """Lay a version out by another one's pages: tree, source, page (null for a new one), new_page, place, rank.

    reference: tree, page, rank, guide, source; rows: tree, pos, guide, source, words in reading order. A topic joins the page
    that holds the same (guide, source), or, if it is no later guide's copy, the only page that holds its source. Pages come
    in the order of their first topic, topics in the reference's. New topics are packed by `most` words in runs that span
    neither a projected page nor two guides. Joins and windows only.
    """
    once = rows.groupBy("tree", "guide", "source").agg(F.min("pos").alias("pos"), F.min_by("words", "pos").alias("words"))
    copy = F.row_number().over(Window.partitionBy("tree", "source").orderBy("pos")) > 1
    exact = reference.groupBy("tree", "guide", "source").agg(F.min(F.struct("page", "rank")).alias("a"))
    only = reference.groupBy("tree", "source").agg(F.min(F.struct("page", "rank")).alias("b"), F.countDistinct("page").alias("n")).where("n = 1").drop("n")
    at = once.withColumn("copy", copy).join(exact, ["tree", "guide", "source"], "left").join(only, ["tree", "source"], "left")
    at = at.withColumn("hit", F.coalesce("a", F.when(~F.col("copy"), F.col("b")))).select("tree", "guide", "source", "pos", "words", F.col("hit.page").alias("page"), F.col("hit.rank").alias("rank"))
    opens = F.when(F.col("page").isNotNull() & (F.row_number().over(Window.partitionBy("tree", "page").orderBy("pos")) == 1), 1).otherwise(0)
    reading = Window.partitionBy("tree").orderBy("pos")
    at = at.withColumn("opens", opens).withColumn("gap", F.sum("opens").over(reading))
    new = at.where("page is null")
    before = F.lag("guide").over(Window.partitionBy("tree", "gap").orderBy("pos"))
    new = new.withColumn("run", F.sum(F.when(F.col("guide") == before, 0).otherwise(1)).over(Window.partitionBy("tree", "gap").orderBy("pos")))
    new = new.withColumn("island", F.concat_ws(":", "tree", "gap", "run"))
    packed = trees.pack(new.select("island", "pos", F.col("pos").alias("node"), "words"), "island", most).select("island", F.col("node").alias("pos"), F.col("page").alias("new_page"))
    fresh = new.join(packed, ["island", "pos"]).select("tree", "source", F.lit(None).cast(at.schema["page"].dataType).alias("page"), F.concat_ws(":", "island", "new_page").alias("new_page"), "pos", F.col("pos").cast("long").alias("rank"))
    kept = at.where("page is not null").dropDuplicates(["tree", "page", "source"]).select("tree", "source", "page", F.lit(None).cast("string").alias("new_page"), "pos", F.col("rank").cast("long").alias("rank"))
    both = kept.unionByName(fresh)
    return both.withColumn("place", F.min("pos").over(Window.partitionBy("tree", "page", "new_page"))).drop("pos")


def pinned(pages: DataFrame) -> DataFrame:
    """tree, key, path, verdict (kept, applied, refused): recorded paths put back. pages: tree, pos, key, path, wanted.

    Paths are compared without case. A page on its own path beats a pin onto it; of two pins onto one path the first in
    order wins; a refused page goes back, which may refuse another.
    """

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("pos").to_dict("records")
        moving = {i: r["wanted"] for i, r in enumerate(rows) if isinstance(r["wanted"], str) and r["wanted"] != r["path"]}
        refused: set[int] = set()
        while True:
            held: dict[str, list[int]] = {}
            for i, r in enumerate(rows):
                held.setdefault(moving.get(i, r["path"]).casefold(), []).append(i)
            lost = [i for group in held.values() for i in group if i in moving and i != min(group, key=lambda x: (x in moving, x))]
            if not lost:
                break
            for i in lost:
                del moving[i]
            refused.update(lost)
        verdict = lambda i: "applied" if i in moving else "refused" if i in refused else "kept"
        return pd.DataFrame([(r["tree"], r["key"], moving.get(i, r["path"]), verdict(i)) for i, r in enumerate(rows)], columns=["tree", "key", "path", "verdict"])

    s = pages.schema
    return pages.select("tree", "pos", "key", "path", "wanted").groupBy("tree").applyInPandas(one, f"tree {s['tree'].dataType.simpleString()}, key {s['key'].dataType.simpleString()}, path string, verdict string")


def _shorter(name: str, limit: int) -> str:
    """As functions.text.shorten, for names inside one tree."""
    if len(name) <= limit:
        return name
    first, *rest = name.split("-")
    kept = "-".join([first, *(w for w in rest if w not in X.STOPWORDS)])
    if len(kept) <= limit:
        return kept
    whole = kept[:limit].rpartition("-")[0] or kept[:limit]
    return whole.rstrip("-")


def fitted(pages: DataFrame, budget: int, longest: int = 49, shortest: int = 8) -> DataFrame:
    """tree, key, path, cap: names on too long paths cut alike, by the greatest cap that makes all fit. pages: tree, pos, key, path.

    A folder and the page named after it are one name. Names off the long paths keep theirs; a cut name that meets a
    sibling gets -2, -3, ... Without a long path the cap is 0.
    """

    def one(pdf: pd.DataFrame) -> pd.DataFrame:
        rows = pdf.sort_values("pos").to_dict("records")
        stems = [tuple(r["path"].rsplit(".", 1)[0].split("/")) for r in rows]
        long = {s for s, r in zip(stems, rows) if len(r["path"]) > budget}
        chain = {s[:k] for s in long for k in range(1, len(s) + 1)}
        every = list(dict.fromkeys(s[:k] for s in stems for k in range(1, len(s) + 1)))
        names, cap = {}, 0
        for cap in range(longest, shortest - 1, -1) if long else ():
            names, taken = {}, {}
            for x in sorted(every, key=lambda x: x in chain):
                siblings, name = taken.setdefault(x[:-1], set()), x[-1]
                if x in chain and len(name) > cap:
                    name = _shorter(name, cap)
                    if name.lower() in siblings:
                        stem, n = _shorter(x[-1], cap - 2), 2
                        while f"{stem}-{n}".lower() in siblings:
                            n += 1
                        name = f"{stem}-{n}"
                siblings.add(name.lower())
                names[x] = name
            if all(sum(len(names[s[:k]]) + 1 for k in range(1, len(s) + 1)) + 2 <= budget for s in long):
                break
        path = lambda s, r: "/".join(names[s[:k]] for k in range(1, len(s) + 1)) + r["path"][len("/".join(s)) :] if long else r["path"]
        return pd.DataFrame([(r["tree"], r["key"], path(s, r), cap) for s, r in zip(stems, rows)], columns=["tree", "key", "path", "cap"])

    s = pages.schema
    return pages.select("tree", "pos", "key", "path").groupBy("tree").applyInPandas(one, f"tree {s['tree'].dataType.simpleString()}, key {s['key'].dataType.simpleString()}, path string, cap int")


def assigned(headings: DataFrame) -> DataFrame:
    """page, topic, anchor: the anchor that a topic's first heading gets when all headings of its page are numbered in one run.

    headings: page, pos (over the page), topic, title.
    """
    anchors = heading_anchors(headings, "page", headings.select("page", "pos", "title"))
    return headings.join(anchors, ["page", "pos"]).groupBy("page", "topic").agg(F.min_by("anchor", "pos").alias("anchor"))


def shelved(pages: DataFrame, listed: DataFrame, folder: str = "unfiled") -> DataFrame:
    """path, new: unlisted pages below `folder`, copies of a listed page (same digest) at it, all others where they are.

    pages: path, digest; listed: path. If nothing is listed everything stays: the tree was not read. A copy of an unlisted
    page goes where the least of its copies goes.
    """
    state = pages.join(listed.select("path", F.lit(True).alias("_l")).distinct(), "path", "left").withColumn("_l", F.coalesce("_l", F.lit(False)))
    twin = state.groupBy("digest").agg(F.min(F.when(F.col("_l"), F.col("path"))).alias("_on"), F.min("path").alias("_least"))
    read = not listed.join(pages, "path", "left_semi").isEmpty()
    off = F.lit(read) & ~F.col("_l") & ~F.col("path").startswith(folder + "/")
    new = F.when(~off, F.col("path")).otherwise(F.coalesce("_on", F.concat(F.lit(folder + "/"), "_least")))
    return state.join(twin, "digest").select("path", new.alias("new"))


def redirects(topics: DataFrame, urls: DataFrame, prefix: str, drop: int, declared: bool) -> DataFrame:
    """from, to, listed: an old address for each topic, and whether it is live. topics: source, target, moved; urls: url.

    The address is the source without its first `drop` folders, below the prefix; shorter sources have none. A derived
    template writes only live addresses, a declared one all. Topics that are not published are left out last.
    """
    parts = F.split("source", "/")
    built = topics.where(F.size(parts) > drop).select(F.concat(F.lit(prefix + "/"), F.array_join(F.slice(parts, F.lit(drop + 1), F.size(parts)), "/")).alias("from"), F.coalesce("moved", "target").alias("to"))
    live = urls.select(F.col("url").alias("from"), F.lit(True).alias("listed")).distinct()
    rows = built.join(live, "from", "left" if declared else "inner").withColumn("listed", F.coalesce("listed", F.lit(False)))
    return rows.where(~F.col("to").startswith("unfiled/"))


def api_urls(roots: DataFrame, base: str, tree: str, locale: str) -> DataFrame:
    """path, url of each API root; roots with one signature share the survivor's. roots: slug, segment, path, signature.

    The survivor is the shortest path, then the least. A name that two survivors of a version would share becomes the path
    with dashes.
    """
    first = F.min(F.struct(F.size(F.split("path", "/")).alias("n"), "path"))
    kept = roots.groupBy("slug", "segment", "signature").agg(first.alias("k")).select("slug", "segment", "signature", F.col("k.path").alias("kept"))
    leaf = P.leaf(F.col("kept"))
    clash = F.count("*").over(Window.partitionBy("slug", "segment", F.lower(leaf))) > 1
    named = kept.withColumn("name", F.when(clash, F.replace("kept", F.lit("/"), F.lit("-"))).otherwise(leaf))
    url = F.concat_ws("/", F.lit(base.rstrip("/")), F.lit(tree), F.lit(locale), "slug", F.lit("api-references"), "segment", P.percent_encode(F.col("name")))
    return roots.join(named, ["slug", "segment", "signature"]).select("path", url.alias("url"))


def merge(topics: DataFrame) -> DataFrame:
    """page, text, topics, words, words_before: pages written from their topics. topics: page, pos, source, title, level, text.

    Headings move to the topic's place, links between topics to page and anchor; words_before counts the topics' words and
    the titles that had to be put in, so that a page that lost a word shows.
    """
    moved = M.shift_headings(F.col("text"), F.col("title"), F.col("level"))
    had = F.regexp_count(M.mask_code(F.col("text")), F.lit(r"(?m)^ {0,3}#[ \t]"))
    parts = topics.withColumn("_body", moved).withColumn("_before", X.word_count(F.col("text")) + F.when(had > 0, 0).otherwise(X.word_count(F.col("title")) + 1))
    body = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "_body"))), lambda x: x["_body"]), "\n\n")
    pages = parts.groupBy("page").agg(body.alias("text"), F.count("*").alias("topics"), F.sum("_before").alias("words_before"))
    anchors = topics.select("page", "source", X.heading_anchor(F.col("title")).alias("anchor"))
    wanted = topics.select("page", F.explode(F.transform(M.references(F.col("text")), lambda r: F.split_part(r["raw"], F.lit("#"), F.lit(1)))).alias("target")).distinct()
    located = wanted.join(anchors.select(F.col("source").alias("target"), F.concat("page", F.lit("#"), "anchor").alias("new")), "target")
    return M.retarget(pages, located.select("page", "target", "new")).withColumn("words", X.word_count(F.col("text")))


def synthesised(units: DataFrame, rows: DataFrame, is_tail: Column, landing: str = "landing") -> DataFrame:
    """tree, node, parent, place, title, page: the trees of a version's units as one. units: tree, unit, rank; rows: tree, unit, node, parent, pos, title, page.

    The landing page is first, support and legal pages (`is_tail`, of top rows) last, everything else in the units' order.
    A heading that opens nothing gets an index page named after it.
    """
    top = F.col("parent").isNull()
    group = F.when(top & (F.lower("title") == landing), 0).when(top & is_tail, 2).otherwise(1)
    placed = rows.join(units, ["tree", "unit"]).withColumn("_g", group)
    place = F.row_number().over(Window.partitionBy("tree", "parent").orderBy("_g", "rank", "pos", "node"))
    return placed.select("tree", "node", "parent", place.alias("place"), "title", F.coalesce("page", F.concat(F.lit("index/"), X.shorten(X.slug(F.col("title"), ascii_only=True)), F.lit(".md"))).alias("page"))


def nest(items: Column) -> Column:
    """A flat run of list items as nested Markdown lines. items: array of (depth, ordered, number, text).

    The shallowest item is the base. An item deeper than the one above opens a list under it, however much deeper; a change
    of kind at one depth begins a new list; an ordered list starts at its first item's number.
    """

    def one(rows) -> list[str] | None:
        if rows is None:
            return None
        stack, out = [], []  # of open lists: depth, ordered, next number, indent
        base = min((r["depth"] for r in rows), default=0)
        for r in rows:
            depth = r["depth"] - base
            while stack and stack[-1][0] > depth:
                stack.pop()
            if stack and stack[-1][0] == depth and stack[-1][1] != r["ordered"]:
                stack.pop()
            if not stack or stack[-1][0] < depth:
                indent = stack[-1][3] + (3 if stack[-1][1] else 2) if stack else 0
                stack.append([depth, r["ordered"], max(1, r["number"] or 1), indent])
            top = stack[-1]
            out.append(" " * top[3] + (f"{top[2]}. " if top[1] else "- ") + (r["text"] or ""))
            top[2] += 1
        return out

    def run(runs: pd.Series) -> pd.Series:
        return runs.map(one)

    return F.pandas_udf(run, "array<string>")(items)
