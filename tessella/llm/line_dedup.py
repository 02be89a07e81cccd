"""Line dedup: later copies of repeated line runs go, found by a suffix array with its longest common prefixes.

Lines are what stands between newlines. A run of consecutive lines with at least `min_words` words (white-space
separated) that also occurs earlier - in a document with a smaller id, or further up in the same document - is a later
copy, and all its lines are deleted. That is every line of each maximal repeated run but its first occurrence.

Positions whose line occurs once cannot belong to a repeated run, so the suffix array is built over the others alone,
and of those over stretches with enough words. A suffix ends where its stretch does.

Suffix array. A line's rank is its place among the distinct lines. Prefix doubling ranks, round by round, the blocks of
2, 4, 8, ... lines that begin at each position: the rank of a block is the place of the pair (rank of its first half,
rank of its second) among all distinct pairs, found by one distributed sort. Suffixes with equal ranks after the last
round are one entry of the array. Rounds end at the depth that the longest shortest run needs.

Longest common prefixes. Each entry and the one before it go down the rounds together: where the first halves differ they
are compared on, else the second halves are and the block's length is added. A round is two joins on ranks.

Intervals. Any later copy is the union of the shortest runs of `min_words` words that begin, and those that end, at its
lines. The occurrences of a run of m lines are the entries around its own between which no common prefix is shorter
than m: an LCP interval, known by the entry where it begins. One scan over the sorted array finds it on a stack;
what a partition cannot settle the stacks of those before it do. The first occurrence of a run is a minimum over its
interval, all others are deleted, as spans of lines.

Memory. Every table grows with the corpus, so every join is told to shuffle, at any size; none is broadcast. A scan's stack
holds ascending common prefixes, so at most as many entries as the longest shortest run has lines; only these stacks, one
for each partition, reach the driver. A document's own lines are held by one task.

Defined results: a null text stays null; an empty text is one empty line; a row without an id is ordered by its
text's hash; rows with equal id and text are one document, given out as often as they occur, with the same result; an
empty table gives no rows; other columns are kept by `clean` and ignored by `report`.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from tessella.shipping import ship
from tessella.storage import written

MIN_WORDS = 50


def _whole_keys(batches) -> Iterator[dict[str, np.ndarray]]:
    """Rows sorted by (d1, d2, pos), given out so that no document is torn."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        d1, d2 = (batch.column(batch.schema.get_field_index(c)).to_numpy() for c in ("d1", "d2"))
        last = np.flatnonzero((d1 != d1[-1]) | (d2 != d2[-1]))
        cut = int(last[-1]) + 1 if len(last) else 0
        if not cut and held:
            end = held[-1]
            if end.column(0)[-1].as_py() == d1[0] and end.column(1)[-1].as_py() == d2[0]:
                held.append(batch)
                continue
        held.append(batch.slice(0, cut))
        table = pa.Table.from_batches(held)
        if table.num_rows:
            yield {c: table.column(c).to_numpy() for c in table.column_names}
        held = [batch.slice(cut)]
    if held:
        table = pa.Table.from_batches(held)
        if table.num_rows:
            yield {c: table.column(c).to_numpy() for c in table.column_names}


def _runs(x: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """First and past-the-last index of each row's run of consecutive lines of one document."""
    new = np.ones(len(x["pos"]), dtype=bool)
    new[1:] = (x["d1"][1:] != x["d1"][:-1]) | (x["d2"][1:] != x["d2"][:-1]) | (x["pos"][1:] != x["pos"][:-1] + 1)
    first = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    return first[run], np.append(first[1:], len(new))[run]


def _shortest(batches, min_words: int):
    """Add to each line its stretch (run) and how many lines the shortest long enough run has that begins (fore) or ends (back) there."""
    for x in _whole_keys(batches):
        a, b = _runs(x)
        total = np.cumsum(x["w"])
        before = total - x["w"]
        i = np.arange(len(total))
        end = np.searchsorted(total, before + min_words)
        fore = np.where(end < b, end - i + 1, 0)
        start = np.searchsorted(before, total - min_words, side="right") - 1
        back = np.where(start >= a, i - start + 1, 0)
        keep = np.bincount(a, fore, minlength=len(a))[a] > 0
        yield pa.RecordBatch.from_pydict({"d1": x["d1"][keep], "d2": x["d2"][keep], "run": a[keep].astype(np.int32), "pos": x["pos"][keep], "fore": fore[keep].astype(np.int32), "back": back[keep].astype(np.int32), "rank": x["rank"][keep]})


def _queries(batches):
    """The runs to look up: where each begins, its lines, and its entry of the suffix array."""
    for x in _whole_keys(batches):
        i = np.arange(len(x["pos"]))
        fore, back = np.flatnonzero(x["fore"] > 0), np.flatnonzero(x["back"] > 0)
        s = np.concatenate((fore, i[back] - x["back"][back] + 1))
        m = np.concatenate((x["fore"][fore], x["back"][back])).astype(np.int64)
        s, m = np.unique(np.stack([s, m]), axis=1)
        yield pa.RecordBatch.from_pydict({"d1": x["d1"][s], "d2": x["d2"][s], "pos": x["pos"][s], "m": m.astype(np.int32), "g": x["rank"][s]})


_SCANNED = pa.schema([("part", pa.int32()), ("g", pa.int64()), ("m", pa.int32()), ("lcp", pa.int32()), ("d1", pa.int64()), ("d2", pa.int64()), ("pos", pa.int32()), ("n", pa.int64()), ("low", pa.int64())])


def _scan(batches):
    """Rows sorted by (g, m): an entry's common prefix with the one before it (m = 0), then the runs looked up there.

    Gives each run the entry `low` where its interval begins, null where that lies in an earlier partition; at the end,
    as rows without m, the stack: entries with ascending common prefixes.
    """
    part, at, depth = -1, [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        part = batch.column(0)[0].as_py()
        g, m, lcp = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("g", "m", "lcp"))
        low = [None] * len(g)
        for i, length in enumerate(m):
            if length:
                k = bisect_left(depth, length) - 1
                if k >= 0:
                    low[i] = at[k]
            else:
                while depth and depth[-1] >= lcp[i]:
                    depth.pop()
                    at.pop()
                depth.append(lcp[i])
                at.append(g[i])
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(low, pa.int64())], schema=_SCANNED).filter(pa.array([x > 0 for x in m], pa.bool_()))
    if at:
        stack = {"part": [part] * len(at), "g": at, "lcp": depth}
        yield pa.RecordBatch.from_arrays([pa.array(stack[f.name], f.type) if f.name in stack else pa.nulls(len(at), f.type) for f in _SCANNED], schema=_SCANNED)


def _carried(spark, stacks: list, parts: list[int], deepest: int) -> DataFrame:
    """part, over, upto, low: for runs of more than `over` and at most `upto` lines, where an interval open before the part begins."""
    rows, stack, ahead = [], [], {}
    for r in sorted(stacks, key=lambda r: (r.part, r.g)):
        ahead.setdefault(r.part, []).append((r.lcp, r.g))
    for part in sorted(set(parts) | set(ahead)):
        if part in parts:
            ends = [x[0] for x in stack[1:]] + [deepest]
            rows += [(part, over, upto, low) for (over, low), upto in zip(stack, ends)]
        for lcp, g in ahead.get(part, []):
            while stack and stack[-1][0] >= lcp:
                stack.pop()
            stack.append((lcp, g))
    return spark.createDataFrame(rows, "part int, over int, upto int, low long")


def _identified(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    h = F.xxhash64(text_col)
    return documents.withColumn("_d1", F.coalesce(F.col(id_col).cast("long"), h)).withColumn("_d2", h)


def _lines(documents: DataFrame, text_col: str) -> DataFrame:
    rows = documents.where(F.col(text_col).isNotNull()).select(F.col("_d1").alias("d1"), F.col("_d2").alias("d2"), F.posexplode(F.split(text_col, "\n", -1)).alias("pos", "line"))
    return rows.select("d1", "d2", "pos", F.xxhash64("line").alias("h1"), F.xxhash64(F.lit(1), "line").alias("h2"), F.regexp_count("line", F.lit(r"\S+")).alias("w"))


def _ranked(keys: DataFrame) -> DataFrame:
    """The distinct keys with their rank: ascending numbers in the order of the keys."""
    return written(keys.distinct().orderBy(*keys.columns).withColumn("rank", F.monotonically_increasing_id()), "ranks")  # numbered once


def _active(lines: DataFrame) -> DataFrame:
    """d1, d2, pos, w, rank of the lines that occur again. The empty line, the most common of all, has the rank -1 without a join."""
    empty = F.struct(F.xxhash64(F.lit("")).alias("h1"), F.xxhash64(F.lit(1), F.lit("")).alias("h2"))
    is_empty = (F.col("h1") == empty["h1"]) & (F.col("h2") == empty["h2"])
    some = lines.where(~is_empty)
    again = _ranked(some.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1").select("h1", "h2"))
    found = some.join(again.hint("merge"), ["h1", "h2"]).select("d1", "d2", "pos", "w", "rank")
    return found.unionByName(lines.where(is_empty).select("d1", "d2", "pos", "w", F.lit(-1).cast("long").alias("rank")))


def _common_prefixes(levels: list[DataFrame], entries: DataFrame) -> DataFrame:
    """g, lcp: of each entry of the suffix array (rank) the lines that it shares with the one before it."""
    part = F.shiftright("rank", 33)
    ends = entries.groupBy(part.alias("part")).agg(F.max("rank").alias("last"))  # as many rows as the sort had partitions
    before = ends.select((F.lead("part").over(Window.orderBy("part"))).alias("part"), "last")
    first = F.col("rank").bitwiseAND((1 << 33) - 1) == 0
    pairs = entries.select("rank", part.alias("part")).join(before.where("part is not null").hint("merge"), "part", "left")
    pairs = pairs.select(F.col("rank").alias("g"), F.when(first, F.col("last")).otherwise(F.col("rank") - 1).alias("x"), F.col("rank").alias("y"), F.lit(0).alias("lcp"))
    for k in range(len(levels), 0, -1):
        halves = levels[k - 1]
        x, y = (halves.select(F.col("rank").alias(c), F.col("p").alias(f"p{c}"), F.col("q").alias(f"q{c}")) for c in "xy")
        both = pairs.join(x.hint("merge"), "x", "left").join(y.hint("merge"), "y", "left")
        same = F.col("px") == F.col("py")
        down = lambda c: F.when(F.col(c) < -1, F.col(c)).when(same, F.col(f"q{c}")).otherwise(F.col(f"p{c}"))
        pairs = written(both.select("g", down("x").alias("x"), down("y").alias("y"), (F.col("lcp") + F.when(same, 1 << (k - 1)).otherwise(0)).alias("lcp")), "line-prefixes")
    return pairs.select("g", "lcp")


def deletions(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """d1, d2 (a document's id and text hash) and gone: the spans (first line, line past the last) to delete, ascending and apart."""
    spark = documents.sparkSession
    ship(spark)
    lines = _lines(_identified(documents, id_col, text_col), text_col)
    if _repeats(documents, id_col):
        lines = lines.dropDuplicates(["d1", "d2", "pos"])
    order = ["d1", "d2", "pos"]
    suffixes = _active(lines).repartition("d1", "d2").sortWithinPartitions(*order).mapInArrow(lambda b: _shortest(b, min_words), "d1 long, d2 long, run int, pos int, fore int, back int, rank long")
    suffixes = written(suffixes, "line-suffixes")
    deepest = suffixes.agg(F.max(F.greatest("fore", "back"))).first()[0] or 1
    levels = []
    for k in range(max(0, int(deepest) - 1).bit_length()):
        ahead = F.lead("rank", 1 << k, -2).over(Window.partitionBy("d1", "d2", "run").orderBy("pos"))  # -2: the suffix has ended
        paired = written(suffixes.withColumn("q", ahead).withColumnRenamed("rank", "p"), "line-pairs")
        levels.append(_ranked(paired.select("p", "q")))
        suffixes = paired.join(levels[-1].hint("merge"), ["p", "q"]).drop("p", "q")
    suffixes = written(suffixes, "line-suffixes")
    entries = levels[-1] if levels else _ranked(suffixes.select(F.col("rank").alias("p"))).select(F.col("p").alias("name"), "rank")
    if not levels:
        suffixes = suffixes.withColumnRenamed("rank", "name").join(entries.hint("merge"), "name")
    prefixes = _common_prefixes(levels, entries)
    runs = written(suffixes.select(*order, "fore", "back", "rank").repartition("d1", "d2").sortWithinPartitions(*order).mapInArrow(_queries, "d1 long, d2 long, pos int, m int, g long"), "line-runs")
    asked = runs.groupBy("g", "m").agg(F.min(F.struct(*order)).alias("first"), F.count("*").alias("n"))
    array = prefixes.select("g", F.lit(0).alias("m"), "lcp", *[F.lit(None).cast(t).alias(c) for c, t in (("d1", "long"), ("d2", "long"), ("pos", "int"), ("n", "long"))])
    array = array.unionByName(asked.select("g", "m", F.lit(None).cast("int").alias("lcp"), "first.*", "n"))
    array = array.repartitionByRange("g").sortWithinPartitions("g", "m").select(F.spark_partition_id().alias("part"), "*")
    scanned = written(array.mapInArrow(_scan, "part int, g long, m int, lcp int, d1 long, d2 long, pos int, n long, low long"), "line-intervals")
    settled, open_ = scanned.where("low is not null"), scanned.where("m is not null and low is null")
    parts = [r.part for r in open_.select("part").distinct().collect()]
    if parts:
        carried = _carried(spark, scanned.where("m is null").select("part", "g", "lcp").collect(), parts, int(deepest))
        found = open_.drop("low").join(carried.hint("merge"), "part").where("m > over and m <= upto").drop("over", "upto")
        settled = settled.unionByName(found.select(*settled.columns))
    interval = written(settled.groupBy("low", "m").agg(F.min(F.struct(*order)).alias("first"), F.sum("n").alias("n")).where("n > 1").drop("n"), "line-firsts")
    firsts = written(settled.select("g", "m", "low").join(interval.hint("merge"), ["low", "m"]).drop("low"), "line-firsts")
    later = runs.join(firsts.hint("merge"), ["g", "m"]).where(F.struct(*order) > F.col("first")).select("d1", "d2", "pos", (F.col("pos") + F.col("m")).alias("end"))
    row = Window.partitionBy("d1", "d2").orderBy("pos", "end")
    reach = F.max("end").over(row.rowsBetween(Window.unboundedPreceding, -1))
    islands = later.withColumn("new", F.when(F.col("pos") <= reach, 0).otherwise(1)).withColumn("island", F.sum("new").over(row.rowsBetween(Window.unboundedPreceding, 0)))
    spans = islands.groupBy("d1", "d2", "island").agg(F.min("pos").alias("begin"), F.max("end").alias("end"))
    return written(spans.groupBy("d1", "d2").agg(F.array_sort(F.collect_list(F.struct("begin", "end"))).alias("gone")), "line-deletions")


def _repeats(documents: DataFrame, id_col: str) -> bool:
    """Whether a document id occurs more than once; only then are rows compared by id and text."""
    return not documents.groupBy(F.col(id_col)).agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def _applied(documents: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """Adds _kept, the text without its spans, and _removed, how many lines went."""
    gone = deletions(documents, id_col, text_col, min_words)
    rows = _identified(documents, id_col, text_col).join(gone.withColumnsRenamed({"d1": "_d1", "d2": "_d2", "gone": "_gone"}).hint("merge"), ["_d1", "_d2"], "left")
    lines = F.split(text_col, "\n", -1)
    begin = F.concat(F.array(F.lit(0)), F.transform("_gone", lambda x: x["end"]))
    end = F.concat(F.transform("_gone", lambda x: x["begin"]), F.array(F.size(lines)))
    stays = F.filter(F.arrays_zip(begin.alias("begin"), end.alias("end")), lambda x: x["end"] > x["begin"])
    kept = F.array_join(F.flatten(F.transform(stays, lambda x: F.slice(lines, x["begin"] + 1, x["end"] - x["begin"]))), "\n")
    removed = F.aggregate("_gone", F.lit(0), lambda n, x: n + x["end"] - x["begin"])
    return rows.withColumn("_kept", F.when(F.col("_gone").isNull(), F.col(text_col)).otherwise(kept)).withColumn("_removed", F.coalesce(removed, F.lit(0)))


def clean(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, drop_emptied: bool = True) -> DataFrame:
    """The documents, same columns, without later copies; a document that loses its whole text goes, if so asked."""
    rows = _applied(documents, id_col, text_col, min_words)
    if drop_emptied:
        rows = rows.where("_gone is null or _kept <> ''")
    return rows.select(*[F.col("_kept").alias(c) if c == text_col else F.col(c) for c in documents.columns])


def report(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """id, text without later copies, n_lines, n_removed (both 0 for a null text)."""
    rows = _applied(documents.select(id_col, text_col), id_col, text_col, min_words)
    return rows.select(id_col, F.col("_kept").alias("text"), F.when(F.col(text_col).isNull(), 0).otherwise(F.size(F.split(text_col, "\n", -1))).cast("long").alias("n_lines"), F.col("_removed").cast("long").alias("n_removed"))
