"""Benchmark decontamination by a broadcast set of normalised test n-grams.

A word is a maximal run of 0-9, a-z (after lower-casing A-Z) and non-ASCII characters. An item's windows
are its runs of `size` consecutive words; an item with fewer words, but at least one, is one window. A
document word inside any occurrence of a window is hit. Window hashes only nominate: every nominated run
is compared word by word with the item before it counts.

What is broadcast has a bound. A benchmark of at most `block_bytes` of text, the usual case, is broadcast as it is, and each
worker holds its windows as sorted hashes over flat arrays, about six times the text. Of a larger one only a bitmap of window
hashes is broadcast, `_BITS` bits whatever the benchmark's size; document windows whose bit is set are joined with the
items' windows on hash and words. Both ways give the same result.

Defined results: a null or empty text has no words and no hits; a null item or one without words matches
nothing; repeated documents and repeated items are each kept (an item id counts once); an empty benchmark
hits nothing; columns of the input other than id and text are ignored by `scan` and kept by `clean`.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tessella.llm.arrays import Words, ranges, slices
from tessella.shipping import ship
from tessella.storage import written

BLOCK_BYTES = 8 << 20
#: Of a bitmap that nominates windows: here, and in the one that is broadcast for a benchmark beyond a block.
_LOCAL_BITS, _BITS = 22, 26


def _spelt(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """The words with one space between, and where each begins there."""
    size = words.end - words.start
    first = np.concatenate(([0], np.cumsum(size + 1)))
    out = np.full(int(first[-1]), 32, dtype=np.uint8)
    out[ranges(first[:-1], size)] = words.low[ranges(words.start, size)]
    return out, first


class WindowSet:
    """The windows of a bounded benchmark: sorted hashes, spans of the items' words, and item numbers, in flat arrays."""

    def __init__(self, items: list[tuple[object, str]], size: int):
        self.names = [str(i) for i, _ in items]
        raw = [t.encode() for _, t in items]
        words = Words(np.frombuffer(b"".join(raw), dtype=np.uint8), np.concatenate(([0], np.cumsum([len(r) for r in raw]))).astype(np.int64))
        self.text, first = _spelt(words)
        self.by_length: dict[int, tuple] = {}
        for n in sorted({*np.unique(words.per_doc[words.per_doc < size]).tolist()} - {0} | ({size} if (words.per_doc >= size).any() else set())):
            at, h = words.windows(n)
            mine = (words.per_doc[words.doc[at]] == n) if n < size else np.ones(len(at), dtype=bool)
            at, h = at[mine], h[mine]
            order = np.argsort(h, kind="stable")
            at, h = at[order], h[order]
            maybe = np.zeros(1 << _LOCAL_BITS, dtype=bool)
            maybe[h >> np.uint64(64 - _LOCAL_BITS)] = True
            self.by_length[n] = (h, first[at], first[at + n] - 1, words.doc[at].astype(np.int32), maybe)

    def hits(self, words: Words) -> list[tuple[int, int, frozenset]]:
        """(first word, window length, item ids) of each verified occurrence."""
        out, known, own = [], {}, None
        for n, (hashes, start, end, item, maybe) in self.by_length.items():
            at, h = words.windows(n)
            near = np.flatnonzero(maybe[h >> np.uint64(64 - _LOCAL_BITS)])
            lo = np.searchsorted(hashes, h[near], side="left")
            some = lo < len(hashes)
            some[some] = hashes[lo[some]] == h[near][some]
            if some.any() and own is None:
                own = _spelt(words)
            for i, a in zip(at[near[some]].tolist(), lo[some].tolist()):
                text = own[0][own[1][i] : own[1][i + n] - 1].tobytes()
                if text not in known:
                    b = int(np.searchsorted(hashes, hashes[a], side="right"))
                    known[text] = frozenset(self.names[item[k]] for k in range(a, b) if self.text[start[k] : end[k]].tobytes() == text)
                if known[text]:
                    out.append((i, n, known[text]))
        return out


def _items(benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int) -> list[tuple] | None:
    """All items, if their texts are at most `block_bytes` long; None for a larger benchmark, of which no more is read here."""
    known = benchmark.where(F.octet_length(text_col) > 0).select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    total = known.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    return [tuple(r) for r in known.collect()] if total <= block_bytes else None


_sets: dict[tuple, WindowSet] = {}  # of one benchmark: what a worker keeps between tasks


def _window_set(shared, size: int) -> WindowSet:
    name, items = shared.value
    key = (name, size)
    if key not in _sets:
        _sets.clear()
        _sets[key] = WindowSet(items, size)
    return _sets[key]


def _covered(words: Words, hits) -> tuple[np.ndarray, dict[int, set]]:
    """Whether each word is hit, and each document's items."""
    cover = np.zeros(len(words.hash) + 1, dtype=np.int64)
    items: dict[int, set] = {}
    for i, n, ids in hits:
        cover[i] += 1
        cover[i + n] -= 1
        items.setdefault(int(words.doc[i]), set()).update(ids)
    return np.cumsum(cover[:-1]) > 0, items


def _positions(words: Words, hit: np.ndarray, rows: int) -> list[list[int]]:
    """Of each document the positions of its hit words."""
    out: list[list[int]] = [[] for _ in range(rows)]
    at = np.flatnonzero(hit)
    owner = words.doc[at]
    for d in np.unique(owner):
        out[d] = (at[owner == d] - words.first[d]).tolist()
    return out


def scan(documents: DataFrame, benchmark: DataFrame, size: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """id, n_words, hit_words (ascending word positions inside any window), items (ids, as sorted strings)."""
    spark = documents.sparkSession
    ship(spark)
    items = _items(benchmark, item_col, item_text, block_bytes)
    near = items is not None
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, items)) if near else None
    fields = [T.StructField(id_col, documents.schema[id_col].dataType), T.StructField("n_words", T.LongType())]
    found = [T.StructField("hit_words", T.ArrayType(T.LongType())), T.StructField("items", T.ArrayType(T.StringType()))]
    keys = [T.StructField("_t1", T.LongType()), T.StructField("_t2", T.LongType())]

    def run(batches):
        windows = _window_set(shared, size) if near else None
        for batch in batches:
            for part, raw, offs in slices(batch, text_col):
                words = Words(raw, offs)
                columns = [part.column(0), pa.array(words.per_doc, pa.int64())]
                if near:
                    hit, ids = _covered(words, windows.hits(words))
                    columns += [pa.array(_positions(words, hit, part.num_rows), pa.list_(pa.int64())), pa.array([sorted(ids.get(d, ())) for d in range(part.num_rows)], pa.list_(pa.string()))]
                else:
                    columns += [part.column(2), part.column(3)]
                yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields + (found if near else keys)])

    if near:
        return documents.select(id_col, text_col).mapInArrow(run, T.StructType(fields + found))
    counted = documents.select(id_col, text_col, *_text_key(text_col)).mapInArrow(run, T.StructType(fields + keys))
    hits = _joined(documents, benchmark, size, text_col, item_col, item_text)
    rows = counted.join(hits.hint("merge"), ["_t1", "_t2"], "left")
    return rows.select(id_col, "n_words", *[F.coalesce(f.name, F.array().cast(f.dataType)).alias(f.name) for f in found])


def _text_key(text_col: str) -> list:
    return [F.xxhash64(text_col).alias("_t1"), F.xxhash64(F.lit(1), text_col).alias("_t2")]


def _item_windows(batches, size: int):
    """n, h, words, item of each window of a benchmark item."""
    for batch in batches:
        for part, raw, offs in slices(batch, "text"):
            words = Words(raw, offs)
            text, first = _spelt(words)
            for n in range(1, size + 1):
                at, h = words.windows(n)
                mine = words.per_doc[words.doc[at]] == n if n < size else np.ones(len(at), dtype=bool)
                at, h = at[mine], h[mine]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), n), pa.int32()), pa.array(h.view(np.int64)), pa.array([text[first[i] : first[i + n] - 1].tobytes() for i in at.tolist()], pa.binary()), part.column(0).take(pa.array(words.doc[at]))],
                    names=["n", "h", "words", "item"],
                )


def _joined(documents: DataFrame, benchmark: DataFrame, size: int, text_col: str, item_col: str, item_text: str) -> DataFrame:
    """_t1, _t2, hit_words, items of the texts that have hits, for a benchmark of any size: windows meet in a join.

    What a text holds depends on the text alone, so equal texts, however many, are one.
    """
    spark = documents.sparkSession
    known = benchmark.where(F.col(item_text).isNotNull()).select(F.col(item_col).cast("string").alias("item"), F.col(item_text).alias("text"))
    windows = written(known.mapInArrow(lambda b: _item_windows(b, size), "n int, h long, words binary, item string").distinct(), "item-windows")
    place = F.shiftrightunsigned("h", 64 - _BITS) + 1  # bucket 1 holds the places 1 to 32768, and so on
    packed = windows.select(F.bitmap_bucket_number(place).alias("b"), F.bitmap_bit_position(place).alias("p")).groupBy("b").agg(F.bitmap_construct_agg("p").alias("bits")).collect()  # at most 2^_BITS bits
    bits = np.zeros((1 << _BITS) // 8, dtype=np.uint8)
    for r in packed:
        bits[(r.b - 1) * 4096 : r.b * 4096] = np.frombuffer(bytes(r.bits), dtype=np.uint8)
    lengths = [r.n for r in windows.select("n").distinct().collect()]  # at most `size`
    shared = spark.sparkContext.broadcast(bits)

    def nominate(batches):
        for batch in batches:
            for part, raw, offs in slices(batch, text_col):
                words = Words(raw, offs)
                spelt = None
                for n in lengths:
                    at, h = words.windows(n)
                    bit = (h >> np.uint64(64 - _BITS)).astype(np.int64)
                    near = np.flatnonzero((shared.value[bit >> 3] >> (bit & 7)) & 1)
                    if len(near):
                        text, first = spelt = spelt or _spelt(words)
                        i = at[near]
                        d = pa.array(words.doc[i])
                        yield pa.RecordBatch.from_arrays(
                            [part.column(1).take(d), part.column(2).take(d), pa.array(i - words.first[words.doc[i]]), pa.array(np.full(len(i), n), pa.int32()), pa.array(h[near].view(np.int64)), pa.array([text[first[x] : first[x + n] - 1].tobytes() for x in i.tolist()], pa.binary())],
                            names=["_t1", "_t2", "at", "n", "h", "words"],
                        )

    texts = documents.where(F.col(text_col).isNotNull()).select(text_col, *_text_key(text_col))
    asked = texts.mapInArrow(nominate, "_t1 long, _t2 long, at long, n int, h long, words binary").distinct()
    key = ["h", "words"]
    asked = written(asked.join(windows.select(*key).distinct().hint("merge"), key, "left_semi"), "window-hits")
    spans = asked.select("_t1", "_t2", F.explode(F.sequence("at", F.col("at") + F.col("n") - 1)).alias("w")).groupBy("_t1", "_t2").agg(F.array_sort(F.collect_set("w")).alias("hit_words"))
    ids = asked.select("_t1", "_t2", *key).distinct().join(windows.select(*key, "item").hint("merge"), key).select("_t1", "_t2", "item").distinct().groupBy("_t1", "_t2").agg(F.array_sort(F.collect_set("item")).alias("items"))
    return spans.join(ids.hint("merge"), ["_t1", "_t2"])


def clean(documents: DataFrame, benchmark: DataFrame, remove: str = "documents", size: int = 10, text_col: str = "text", item_col: str = "item_id", item_text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents, same columns, without what the benchmark contaminates.

    remove="documents": a document with any hit goes. remove="spans": each maximal run of hit words, with what
    stands between them, is cut out of the text. A null text stays null.
    """
    if remove not in ("documents", "spans"):
        raise ValueError(f"remove must be 'documents' or 'spans', not {remove!r}")
    spark = documents.sparkSession
    ship(spark)
    items = _items(benchmark, item_col, item_text, block_bytes)
    near, schema = items is not None, documents.schema
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, items)) if near else None

    def run(batches):
        windows = _window_set(shared, size) if near else None
        for batch in batches:
            k = batch.schema.get_field_index(text_col)
            for part, raw, offs in slices(batch, text_col):
                words = Words(raw, offs)
                if near:
                    hit = _covered(words, windows.hits(words))[0]
                else:
                    hit = np.zeros(len(words.hash), dtype=bool)
                    given = part.column(part.num_columns - 1).to_pylist()
                    for d, own in enumerate(given):
                        hit[words.first[d] + np.array(own or [], dtype=np.int64)] = True
                    part = part.select(range(part.num_columns - 1))
                dirty = np.zeros(part.num_rows, dtype=bool)
                dirty[words.doc[hit]] = True
                if not dirty.any():
                    yield part
                elif remove == "documents":
                    yield part.filter(pa.array(~dirty))
                else:
                    texts = part.column(k).to_pylist()
                    for d in np.flatnonzero(dirty).tolist():
                        a, b = words.first[d], words.first[d + 1]
                        own = hit[a:b]
                        edge = np.diff(np.concatenate(([0], own.astype(np.int8), [0])))
                        kept, at, base = [], offs[d], raw
                        for s, e in zip(np.flatnonzero(edge == 1) + a, np.flatnonzero(edge == -1) + a - 1):
                            kept.append(base[at : words.start[s]].tobytes())
                            at = words.end[e]
                        kept.append(base[at : offs[d + 1]].tobytes())
                        texts[d] = b"".join(kept).decode()
                    columns = [part.column(j) if j != k else pa.array(texts, part.column(k).type) for j in range(part.num_columns)]
                    yield pa.RecordBatch.from_arrays(columns, schema=part.schema)

    if near:
        return documents.mapInArrow(run, schema)
    key = _text_key(text_col)
    names = [uuid.uuid4().hex for _ in key]  # no column of the input has such a name
    hits = _joined(documents, benchmark, size, text_col, item_col, item_text).select(*[F.col(f"_t{i}").alias(n) for i, n in enumerate(names, 1)], F.col("hit_words").alias("hits" + names[0]))
    rows = documents.select("*", *[c.alias(n) for c, n in zip(key, names)]).join(hits.hint("merge"), names, "left").drop(*names)
    return rows.mapInArrow(run, schema)


def report(documents: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The digest columns of `scan`: n_words, n_hit, n_items, items_sha256, contaminated."""
    found = scan(documents, benchmark, **options)
    key = found.columns[0]
    return found.select(
        key,
        "n_words",
        F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"),
    )
