"""Near-duplicates by BagMinHash signatures, bands and exact multiset overlap.

A text is the multiset of its runs of `shingle` words (lower-cased A-Z; a text with fewer words, but at least one, is
one run). Similarity is the weighted Jaccard index of two multisets: the sum of the lesser counts over that of the
greater. Texts of a class are connected by links of similarity `threshold` or more; all such links count.

Signatures. Each shingle has a Poisson process over weight x register x time. The weight axis is cut at 1, 2, 4, 8, ...;
each piece is a process of its own, and a point's place inside a piece is found by halving it again and again with the
bits of one hash, so a count takes exactly the points at or below it. A register holds the time of its first point.
Registers of two texts agree with the probability of their weighted Jaccard index. Points are made in time order,
only up to when the text's registers are expected to be full, and further for the few texts with an empty one.

Search. Texts with equal multisets are one node, known by 128 bits. `bands` bands of `rows` registers put nodes into
buckets. Each bucket's nodes are first verified against its least node, which settles large groups of copies with
one pair a node and bucket. Then only buckets that still hold several components go on: what lies outside a bucket's
largest component is compared with the rest, in tiles of bounded size, by signature agreement; first the
best partners are verified, then all that are left and agree well enough in a longer signature. Nothing is capped. At
similarity 0.8 a link shares no bucket with probability 3e-6, and either agreement is too low with 2e-5.

Verification joins each pair with both texts' shingles and counts. Only nodes that share a bucket have them fetched.

Defined results: null texts and texts without words are classes of their own; a class id is the least id in it; a row
without an id takes part, stands under its text's hash when ids are compared (so a class of such rows alone is named by
it) and keeps its null id; repeated rows are in one class; an
empty table gives no rows; columns other than id and text are ignored by `classes` and kept by `keep_one`.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import DataFrame, functions as F

from tessella.llm.arrays import Words, mix, ranges, slices
from tessella.llm.components import components
from tessella.shipping import ship
from tessella.storage import written

SHINGLE, THRESHOLD, REGISTERS, BANDS, ROWS, AGREE = 5, 0.8, 192, 24, 4, 0.68
#: Nodes of a bucket that are compared pair by pair at once, and those of one tile of a larger one.
SMALL, TILE, BEST = 24, 1024, 8
#: Registers and least agreement for the nodes of larger buckets that the best partners didn't settle.
FINE_REGISTERS, FINE_AGREE = 1024, 0.7475
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def shingles(words: Words, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of each document of a slice, ascending within a document, and how many each has."""
    at, h = words.windows(size)
    counts = np.bincount(words.doc[at], minlength=len(words.per_doc))[: len(words.per_doc)] if len(at) else np.zeros(len(words.per_doc), np.int64)
    short = np.flatnonzero((words.per_doc > 0) & (words.per_doc < size))
    if len(short):
        total = counts.copy()
        total[short] = 1
        out = np.zeros(int(total.sum()), dtype=np.uint64)
        first = np.concatenate(([0], np.cumsum(total)[:-1]))
        out[ranges(first[counts > 0], counts[counts > 0])] = h
        for d in short.tolist():
            a, b = words.first[d], words.first[d + 1]
            x = np.uint64(0)
            with np.errstate(over="ignore"):
                for w in words.hash[a:b]:
                    x = x * _GOLD + w
            out[first[d]] = mix(np.array([x + np.uint64(b - a)], dtype=np.uint64))[0]
        h, counts = out, total
    else:
        h = h.copy()
    ends = np.cumsum(counts)
    for a, b in zip((ends - counts).tolist(), ends.tolist()):
        h[a:b].sort()
    return h, counts


def _distinct(h: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, shingle, count) of each distinct shingle."""
    doc = np.repeat(np.arange(len(counts)), counts)
    if not len(h):
        return doc, h, doc
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
    at = np.flatnonzero(new)
    return doc[at], h[at], np.diff(np.append(at, len(h)))


def signatures(doc: np.ndarray, key: np.ndarray, count: np.ndarray, n: int, registers: int = REGISTERS, fill: float = 10.0) -> np.ndarray:
    """First point's time in each register, shape (n, registers); infinite for documents without shingles."""
    out = np.full(n * registers, np.inf)
    weight = np.bincount(doc, count, minlength=n)[:n]
    pieces = np.ceil(np.log2(np.maximum(count, 1))).astype(np.int64) + 1  # (0,1], (1,2], (2,4], ...
    level = ranges(np.zeros(len(pieces), np.int64), pieces)
    doc, base, count = np.repeat(doc, pieces), np.repeat(key, pieces), np.repeat(count, pieces)
    seed = mix(base + level.astype(np.uint64) * _GOLD)
    low = np.where(level > 0, 1 << np.maximum(level - 1, 0), 0)
    width = np.where(level > 0, low, 1)
    todo, limit = weight > 0, np.divide(fill, weight, out=np.zeros(n), where=weight > 0)
    while todo.any():
        act = np.flatnonzero(todo[doc])
        time, drawn = np.zeros(len(act)), 0
        while len(act):
            block = 1 if len(act) > 4000 else 32
            step = np.arange(drawn, drawn + block, dtype=np.uint64)
            u = mix(seed[act][:, None] + (step * np.uint64(2) + np.uint64(1)) * _GOLD)
            gap = -np.log(((u >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (registers * width[act][:, None])
            times = np.cumsum(np.concatenate((time[:, None], gap), axis=1), axis=1)[:, 1:]  # one order of additions for all blocks
            r = mix(u + _GOLD)
            place = low[act][:, None] + ((r >> np.uint64(32)) * width[act].astype(np.uint64)[:, None] >> np.uint64(32)).astype(np.int64)
            register = ((r & np.uint64(0xFFFFFFFF)) * np.uint64(registers) >> np.uint64(32)).astype(np.int64)
            good = (times <= limit[doc[act]][:, None]) & (place < count[act][:, None])
            np.minimum.at(out, (doc[act][:, None] * registers + register)[good], times[good])
            time, drawn = times[:, -1], drawn + block
            on = time <= limit[doc[act]]
            act, time = act[on], time[on]
        todo &= np.isinf(out.reshape(n, registers)).any(axis=1)
        limit = limit * 3
    return out.reshape(n, registers)


def _sign_batches(batches, registers: int, bands: int, rows: int, size: int):
    for batch in batches:
        for part, raw, offs in slices(batch, "text"):
            n = part.num_rows
            h, counts = shingles(Words(raw, offs), size)
            doc, key, count = _distinct(h, counts)
            mixed = mix(key + count.astype(np.uint64) * _GOLD)
            prints = np.zeros((n, 2), dtype=np.uint64)
            np.add.at(prints[:, 0], doc, mixed)
            np.add.at(prints[:, 1], doc, mix(mixed ^ np.uint64(0x5851F42D4C957F2D)))
            sig = mix(signatures(doc, key, count, n, registers).view(np.uint64))
            band = np.zeros((n, bands), dtype=np.uint64)
            for k in range(rows):
                band = mix(band * _GOLD + sig[:, k : bands * rows : rows] + np.arange(bands, dtype=np.uint64))
            some = pa.array(counts == 0)
            null = lambda a: pa.compute.if_else(some, None, a)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(part.schema.get_field_index("id")),
                    part.column(part.schema.get_field_index("text_hash")),
                    part.column(part.schema.get_field_index("known")),
                    null(pa.array([x.tobytes() for x in prints.astype(">u8")], pa.binary())),
                    pa.array(counts, pa.int64()),
                    pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * bands, pa.int32()), pa.array(band.view(np.int64).reshape(-1))),
                    pa.array([x.tobytes() for x in (sig >> np.uint64(56)).astype(np.uint8)], pa.binary()),
                ],
                names=["id", "text_hash", "known", "node", "weight", "bands", "sig"],
            )


def _identified(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return documents.select(F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text_col)).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.col(id_col).isNotNull().alias("known"), F.col(text_col).alias("text"))


def _contents(documents: DataFrame, wanted: DataFrame, size: int) -> DataFrame:
    """node, h (its shingles' hashes, ascending) of the wanted nodes; wanted: node, id and text_hash of a row that has it."""

    def run(batches):
        for batch in batches:
            for part, raw, offs in slices(batch, "text"):
                h, counts = shingles(Words(raw, offs), size)
                ends = np.cumsum(counts)
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index("node")), pa.array([h[a:b].tobytes() for a, b in zip(ends - counts, ends)], pa.binary())], names=["node", "h"])

    return documents.join(wanted, ["id", "text_hash"]).select("node", "text").mapInArrow(run, "node binary, h binary")


def overlap(a: np.ndarray, b: np.ndarray) -> float:
    """Weighted Jaccard index of two ascending arrays of hashes, repeated as often as they occur."""
    ka, ca = np.unique(a, return_counts=True)
    kb, cb = np.unique(b, return_counts=True)
    at = np.searchsorted(kb, ka)
    at[at == len(kb)] = 0
    same = kb[at] == ka if len(kb) else np.zeros(len(ka), bool)
    both = int(np.minimum(ca[same], cb[at[same]]).sum())
    return both / (len(a) + len(b) - both) if len(a) + len(b) else 0.0


def _verified(pairs: DataFrame, contents: DataFrame, threshold: float) -> DataFrame:
    """The pairs a, b whose exact similarity reaches the threshold."""

    def run(batches):
        for batch in batches:
            a, b, x, y = (batch.column(i) for i in range(4))
            ok = [overlap(np.frombuffer(p.as_buffer(), dtype=np.uint64), np.frombuffer(q.as_buffer(), dtype=np.uint64)) >= threshold for p, q in zip(x, y)]
            yield pa.RecordBatch.from_arrays([a, b], names=["a", "b"]).filter(pa.array(ok, pa.bool_()))

    left = contents.select(F.col("node").alias("a"), F.col("h").alias("x"))
    right = contents.select(F.col("node").alias("b"), F.col("h").alias("y"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "x", "y").mapInArrow(run, "a binary, b binary")


def _tiles(batches, agree: float, best: int | None):
    """Pairs from rows sorted by tile: a node from outside the main component with one from the bucket."""
    held: list[pa.Table] = []
    now = None

    def pairs(table: pa.Table):
        node = table.column("node").to_pylist()
        label = np.array(table.column("label").to_pylist(), dtype=object)
        weight = table.column("weight").to_numpy()
        sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype=np.uint8).reshape(len(node), -1)
        band = np.array(table.column("bands").to_pylist(), dtype=np.int64)
        key = table.column("key")[0].as_py()
        odd = table.column("odd").to_numpy(zero_copy_only=False)
        names = {x: i for i, x in enumerate(sorted(set(label)))}
        comp = np.array([names[x] for x in label])
        ask, give = np.flatnonzero(odd), np.flatnonzero(~odd)
        out = []
        for i in ask.tolist():
            near = (sig[give] == sig[i]).mean(axis=1)
            fit = np.minimum(weight[give], weight[i]) >= THRESHOLD * np.maximum(weight[give], weight[i])
            ok = np.flatnonzero((near >= agree) & fit & (comp[give] != comp[i]))
            same = band[give[ok]] == band[i]  # of the buckets that two nodes share, the first band's gives the pair
            ok = ok[band[i][same.argmax(axis=1)] == key]
            if best is not None and len(ok) > best:
                ok = ok[np.argsort(-near[ok], kind="stable")[:best]]
            out += [(node[i], node[give[j]]) for j in ok.tolist()]
        return pa.RecordBatch.from_arrays([pa.array([min(p) for p in out], pa.binary()), pa.array([max(p) for p in out], pa.binary())], names=["a", "b"])

    for batch in batches:
        table = pa.Table.from_batches([batch])
        key = np.stack([table.column(c).to_numpy().astype(np.int64) for c in ("key", "s", "t")], axis=1)
        cut = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(key)]):
            if a == b:
                continue
            here = tuple(key[a].tolist())
            if held and here != now:
                yield pairs(pa.concat_tables(held))
                held = []
            now = here
            held.append(table.slice(a, b - a))
    if held:
        yield pairs(pa.concat_tables(held))


def _cross_pairs(members: DataFrame, nodes: DataFrame, labels: DataFrame, agree: float, best: int | None) -> DataFrame:
    """Pairs of one bucket and different components. members: key, node, n; labels: node, label."""
    labelled = members.join(labels, "node", "left").select("key", "node", "n", F.coalesce("label", "node").alias("label"))
    mixed = labelled.groupBy("key", "label").agg(F.count("*").alias("k")).groupBy("key").agg(F.max_by("label", F.struct("k", "label")).alias("main"), F.count("*").alias("several")).where("several > 1").select("key", "main")
    here = labelled.join(mixed, "key").withColumn("odd", F.col("label") != F.col("main")).drop("main")
    small, large = here.where(F.col("n") <= SMALL), here.where(F.col("n") > SMALL)
    pairs = None
    if best is not None:
        x, y = (small.where("odd") if k == "x" else small for k in "xy")
        x = x.select("key", F.col("node").alias("p"), F.col("label").alias("l"))
        pairs = x.join(y.select("key", F.col("node").alias("q"), F.col("label").alias("m")), "key").where("l <> m").select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b"))
    chunks = F.ceil(F.col("n") / TILE).cast("int")
    own = F.pmod(F.xxhash64("node"), chunks).cast("int")
    every = F.sequence(F.lit(0), chunks - 1)
    asking = large.where("odd").select("key", own.alias("s"), F.explode(every).alias("t"), "node", "label", F.lit(True).alias("odd"))
    giving = large.select("key", F.explode(every).alias("s"), own.alias("t"), "node", "label", F.lit(False).alias("odd"))
    tiles = asking.unionByName(giving).join(nodes.select("node", "weight", "sig", "bands"), "node")
    far = tiles.repartition("key", "s", "t").sortWithinPartitions("key", "s", "t").mapInArrow(lambda b: _tiles(b, agree, best), "a binary, b binary")
    return far if pairs is None else far.unionByName(pairs)


def _finer(contents: DataFrame, registers: int) -> DataFrame:
    """node, weight, sig: longer signatures from shingles already at hand."""

    def run(batches):
        for batch in batches:
            for a in range(0, batch.num_rows, 256):
                part = batch.slice(a, 256)
                h = [np.frombuffer(x.as_buffer(), dtype=np.uint64) for x in part.column(1)]
                counts = np.array([len(x) for x in h])
                doc, key, count = _distinct(np.concatenate(h), counts)
                sig = (mix(signatures(doc, key, count, len(h), registers).view(np.uint64)) >> np.uint64(56)).astype(np.uint8)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(counts, pa.int64()), pa.array([x.tobytes() for x in sig], pa.binary())], names=["node", "weight", "sig"])

    return contents.select("node", "h").mapInArrow(run, "node binary, weight long, sig binary")


def sign(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, registers: int = REGISTERS, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """id, text_hash, known (has an id of its own), node (128 bits of the multiset, null without words), weight, bands, sig (a byte of each register)."""
    ship(documents.sparkSession)
    return _identified(documents, id_col, text_col).mapInArrow(lambda b: _sign_batches(b, registers, bands, rows, shingle), "id long, text_hash long, known boolean, node binary, weight long, bands array<long>, sig binary")


def classes(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """id, class_id for each row: the least id of the row's class."""
    return _classes(documents, id_col, text_col, **options).select(F.when(F.col("known"), F.col("id")).alias(id_col), F.col("least.id").alias("class_id"))


def _classes(documents: DataFrame, id_col: str, text_col: str, shingle: int = SHINGLE, threshold: float = THRESHOLD, agree: float = AGREE) -> DataFrame:
    """id, text_hash, known, least (id and text_hash of the class's least row) for each row. Bands and agreements are made for links of 0.8 or more."""
    if threshold < THRESHOLD:
        raise ValueError(f"threshold {threshold}: links below {THRESHOLD} would be missed")
    signed = written(sign(documents, id_col, text_col, shingle), "signatures")
    found = signed.where("node is not null")
    nodes = written(found.groupBy("node").agg(F.min(F.struct("id", "text_hash")).alias("row"), F.first("weight").alias("weight"), F.first("bands").alias("bands"), F.first("sig").alias("sig")), "nodes").select("*", "row.id", "row.text_hash")
    placed = nodes.select("node", "weight", F.explode("bands").alias("key"))
    shared = placed.groupBy("key").agg(F.min("node").alias("leader"), F.min_by("weight", "node").alias("leader_weight"), F.count("*").alias("n")).where("n > 1")
    members = written(placed.join(shared, "key"), "buckets")
    wanted = members.select("node").distinct().join(nodes.select("node", "id", "text_hash"), "node")
    contents = written(_contents(_identified(documents, id_col, text_col), wanted, shingle).dropDuplicates(["node"]), "shingles")
    fits = F.least("weight", "leader_weight") >= F.greatest("weight", "leader_weight") * threshold
    tried = written(members.where((F.col("node") != F.col("leader")) & fits).select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    links = written(_verified(tried, contents, threshold), "links")
    labels = components(links)
    for best in (BEST, None):
        if best is None:
            large = members.where(F.col("n") > SMALL).select("node").distinct()
            nodes_, agree = written(_finer(contents.join(large, "node", "left_semi"), FINE_REGISTERS).join(nodes.select("node", "bands"), "node"), "fine-signatures"), FINE_AGREE
        else:
            nodes_ = nodes
        fresh = _cross_pairs(members.select("key", "node", "n"), nodes_, labels, agree, best).distinct().join(tried, ["a", "b"], "left_anti")
        fresh = written(fresh, "pairs")
        more = written(_verified(fresh, contents, threshold), "links")
        if not more.isEmpty():
            tried, links = tried.unionByName(fresh), links.unionByName(more)
            labels = components(links)
    labelled = nodes.select("node", "row").join(labels, "node", "left").select("node", "row", F.coalesce("label", "node").alias("label"))
    least = labelled.groupBy("label").agg(F.min("row").alias("least"))
    named = labelled.join(least, "label").select("node", "least")
    return signed.select("id", "text_hash", "known", "node").join(named, "node", "left").select("id", "text_hash", "known", F.coalesce("least", F.struct("id", "text_hash")).alias("least"))


def keep_one(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents, same columns, without those that aren't their class's least by id and text hash; of rows with equal id and text one."""
    found = written(_classes(documents, id_col, text_col, **options), "classes")
    row = F.struct("id", "text_hash")
    later = found.where(row != F.col("least")).select(F.col("id").alias("_later"), F.col("text_hash").alias("_text")).distinct()
    key = F.coalesce(F.col(id_col).cast("long"), F.xxhash64(text_col))
    kept = documents.join(later, (key == F.col("_later")) & (F.xxhash64(text_col) == F.col("_text")), "left_anti")
    if found.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return kept
    return kept.dropDuplicates([id_col, text_col])
