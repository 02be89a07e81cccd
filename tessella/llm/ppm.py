"""Language-model scoring by prediction by partial matching over bytes.

The model is a trie of byte contexts up to `order` bytes, pretrained on the training documents, lower-cased A-Z. Each
document is its bytes and one end symbol, after `order` symbols of beginning (both 0xFF, which UTF-8 never has).
A symbol is coded in its longest context that the trie has; where the context lacks it, an escape is coded and the
next shorter context is tried, without the symbols that the longer one had (symbol exclusion). With n occurrences of a
context, d kept symbols whose counts sum to t, a symbol of count c gets c / (n + d) and the escape (n - t + d) / (n + d),
where under exclusion n, t and d lack the excluded symbols. Below the empty context all symbols not excluded are equally likely.
A context's symbols are always among those of its suffix, so what exclusion leaves depends on the longer context
alone: denominators and escapes are tables of the trie's nodes, and a batch of positions is scored by lookups.

The trie has every n-gram of the training text, whatever its count, so it grows with the corpus. A symbol's score depends on
its last order + 1 bytes alone: those of the most frequent n-grams are broadcast with their scores (at most `frequent`), all
others are graded in shards of the trie and joined. A shard has the n-grams whose contexts end in the same two bytes; the
levels below, at most 65,792 n-grams, are in every shard. A task holds one shard, or several small ones, at a time.

Base score: tokens are runs of bytes other than white space, and one end for each document. Counts of all training tokens
are exact: those of at least one in `head` occurrences are broadcast (at most `head`), all others are joined.
Tokens are known by 128 bits.

Defined results: a null text is an empty one; a row without an id is for training and not held out; rows with equal id
and text are scored alike; without training rows every byte costs log10(256) and base counts are 0; an empty
table gives no rows; columns other than id and text are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tessella.llm.arrays import LOWER, slices, span_hashes, trimmed
from tessella.shipping import ship
from tessella.storage import written

ORDER, HEAD, FREQUENT = 5, 1 << 21, 1 << 19
#: Context bytes that name a shard of the trie, and how many n-grams are graded at once where shards are smaller.
SHARD, GRADED = 2, 1_000_000
#: Bytes of text that are coded at once, and sums that a counting task holds.
SLICE, SUMS = 1 << 20, 2_000_000
END = 0xFF
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_GOLD = np.uint64(0x9E3779B97F4A7C15)
_codes = np.random.default_rng(77).integers(1, 1 << 63, (2, 256), dtype=np.uint64)
_radix = [0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
_END_TOKEN = (0, 0)


class Table:
    """Integer keys to places 0, 1, ... by open addressing, for arrays of keys."""

    def __init__(self, keys: np.ndarray):
        self.shift = np.uint64(64 - max(4, int(len(keys) * 3).bit_length()))
        size = 1 << (64 - int(self.shift))
        self.place = np.full(size, -1, dtype=np.int32)
        self.keys = np.zeros(size, dtype=np.uint64)
        todo = np.arange(len(keys))
        slot = self._slot(keys)
        while len(todo):
            free = self.place[slot] < 0
            self.place[slot[free]] = todo[free]  # of several, the last stays
            won = self.place[slot] == todo
            self.keys[slot[won]] = keys[todo[won]]
            todo, slot = todo[~won], (slot[~won] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * _GOLD) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, or -1."""
        slot = self._slot(keys)
        out = self.place[slot]
        odd = np.flatnonzero((out >= 0) & (self.keys[slot] != keys))
        slot = slot[odd]
        while len(odd):
            slot = (slot + 1) & (len(self.place) - 1)
            found = self.place[slot]
            out[odd] = found
            on = (found >= 0) & (self.keys[slot] != keys[odd])
            odd, slot = odd[on], slot[on]
        return out


def symbols(raw: np.ndarray, offs: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """For each coded symbol its last order + 1 bytes as one integer, and each document's first place."""
    n, docs = len(raw), len(offs) - 1
    sizes = np.diff(offs)
    doc = np.repeat(np.arange(docs), sizes)
    buf = np.full(n + docs * (order + 1), END, dtype=np.uint8)
    buf[np.arange(n) + order + (order + 1) * doc] = LOWER[raw]
    wide = buf.astype(np.uint64)
    key = np.zeros(len(buf) - order, dtype=np.uint64)
    for j in range(order + 1):
        key <<= np.uint64(8)
        key |= wide[j : len(buf) - order + j]
    coded = np.ones(len(key), dtype=bool)
    first = offs[:-1] + (order + 1) * np.arange(docs)  # in key, of each document's first symbol
    for j in range(1, order + 1):  # beginnings are given, not coded
        coded[first[1:] - j] = False
    return key[coded], np.append(offs[:-1] + np.arange(docs), n + docs)


def tokens(raw: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Two hashes of each white-space separated token, and its document."""
    low = LOWER[raw]
    n = len(low)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    inside = ~_SPACE[low]
    cut = np.zeros(n + 1, dtype=bool)
    cut[offs] = True
    begin, end = inside.copy(), inside.copy()
    begin[1:] &= ~inside[:-1] | cut[1:n]
    end[:-1] &= ~inside[1:] | cut[1:n]
    a, b = np.flatnonzero(begin), np.flatnonzero(end) + 1
    h1, h2 = (span_hashes(low, a, b, code, radix, lengths=True) for code, radix in zip(_codes, _radix))
    return h1, h2, np.searchsorted(offs, a, side="right") - 1


def _folded(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sums of the counts of equal (k1, k2)."""
    k1, k2, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(k1)
    k1, k2, n = k1[order], k2[order], n[order]
    same = np.flatnonzero(k1[1:] == k1[:-1])
    if len(same) and (k2[same] != k2[same + 1]).any():
        order = np.lexsort((k2, k1))
        k1, k2, n = k1[order], k2[order], n[order]
    at = np.flatnonzero(np.concatenate(([True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]))))
    return k1[at], k2[at], np.add.reduceat(n, at)


def _count_batches(batches, order: int):
    """kind (0: n-gram of bytes, 1: token), k1, k2, n: sums over what the task has read, in bounded memory."""
    held: dict[int, list] = {0: [], 1: []}
    sizes = {0: 0, 1: 0}

    def given(kind):
        k1, k2, n = _folded(held[kind])
        for a in range(0, len(k1), 100_000):
            s = slice(a, a + 100_000)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(k1[s]), kind, np.int32)), pa.array(k1[s].view(np.int64)), pa.array(k2[s].view(np.int64)), pa.array(n[s])], names=["kind", "k1", "k2", "n"])
        held[kind], sizes[kind] = [], 0

    for batch in batches:
        for part, raw, offs in slices(batch, "text", SLICE):
            key, _ = symbols(raw, offs, order)
            key.sort()
            at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            held[0].append((key[at], np.zeros(len(at), np.uint64), np.diff(np.append(at, len(key)))))
            h1, h2, _ = tokens(raw, offs)
            rows = [(h1, h2, np.ones(len(h1), np.int64))] if len(h1) else []
            ends = (np.array([_END_TOKEN[0]], np.uint64), np.array([_END_TOKEN[1]], np.uint64), np.array([part.num_rows], np.int64))
            held[1].append(_folded([*rows, ends]))
            for kind in held:
                sizes[kind] += len(held[kind][-1][0])
                if sizes[kind] > SUMS:
                    held[kind] = [_folded(held[kind])]
                    sizes[kind] = len(held[kind][0][0])
                    if sizes[kind] > SUMS // 2:
                        yield from given(kind)
    for kind in held:
        if held[kind]:
            yield from given(kind)
    held.clear()
    trimmed()


class Trie:
    """N-grams of each depth, of all contexts or of whole shards, as lookup tables. grams: depth to (keys, counts), keys ascending."""

    def __init__(self, grams: list[tuple[np.ndarray, np.ndarray]]):
        self.order = len(grams) - 1
        self.grams, self.free, self.count, self.contexts, self.escape, self.low, self.low_escape = [], [], [], [], [], [], []
        sums: list[tuple] = []
        for k, (keys, counts) in enumerate(grams):
            context = keys >> np.uint64(8)
            at = np.flatnonzero(np.concatenate(([True], context[1:] != context[:-1]))) if len(keys) else np.zeros(0, np.int64)
            own = context[at]
            kept = np.add.reduceat(counts, at).astype(float) if len(at) else np.zeros(0)
            kinds = np.diff(np.append(at, len(keys))).astype(float)
            total = kept.copy()
            if k and len(own):  # occurrences of a context: those of its last byte after what stands before that
                below_keys, below_counts = grams[k - 1]
                place = np.searchsorted(below_keys, own)
                place[place == len(below_keys)] = 0
                has = (below_keys[place] == own) & ((own & np.uint64(0xFF)) != END)
                total = np.maximum(kept, np.where(has, below_counts[place], 0))
            sums.append((own, kept, kinds, total, context, at))
            logs = np.log10(counts.astype(float))
            free = np.log10(total + kinds)
            which = np.repeat(np.arange(len(own)), np.diff(np.append(at, len(keys))))
            self.grams.append(Table(keys))
            self.count.append(logs)
            self.free.append(logs - free[which] if len(keys) else logs)
            self.contexts.append(Table(own))
            self.escape.append(np.log10(total - kept + kinds) - free)
            if not k:
                self.low.append(np.log10(np.maximum(256.0 - kinds, 1)))
                self.low_escape.append(np.zeros(len(own)))
                continue
            # what the next shorter context has left when this one's symbols are excluded
            mask = np.uint64((1 << 8 * k) - 1)
            short_keys, short_counts = grams[k - 1]
            place = np.searchsorted(short_keys, keys & mask)
            gone = np.bincount(which, short_counts[place].astype(float), len(own))
            s_own, s_kept, s_kinds, s_total = sums[k - 1][:4]
            place = np.searchsorted(s_own, own & np.uint64((1 << 8 * (k - 1)) - 1)) if k > 1 else np.zeros(len(own), np.int64)
            left_kinds = s_kinds[place] - kinds
            left = s_total[place] - gone + left_kinds
            mass = s_total[place] - s_kept[place] + left_kinds
            self.low.append(np.log10(np.maximum(left, 1e-300)))
            self.low_escape.append(np.where(left > 0, np.log10(np.maximum(mass, 1e-300)) - self.low[-1], 0.0))

    def score(self, key: np.ndarray) -> np.ndarray:
        """log10 probability of each symbol after its context."""
        out = np.zeros(len(key))
        act = np.arange(len(key))
        above = np.full(len(key), -1)  # place of the longer context whose symbols are excluded
        for k in range(self.order, -1, -1):
            gram = key[act] & np.uint64((1 << 8 * (k + 1)) - 1)
            at = self.grams[k].find(gram)
            hit = at >= 0
            was = above[act] if k < self.order else above
            bare = hit & (was < 0)
            out[act[bare]] += self.free[k][at[bare]]
            under = hit & (was >= 0)
            out[act[under]] += self.count[k][at[under]] - self.low[k + 1][was[under]] if k < self.order else 0.0
            act, was = act[~hit], was[~hit]
            if not len(act):
                return out
            deep = was >= 0
            if k < self.order:
                out[act[deep]] += self.low_escape[k + 1][was[deep]]
            at = self.contexts[k].find(gram[~hit] >> np.uint64(8))
            fresh = ~deep & (at >= 0)
            out[act[fresh]] += self.escape[k][at[fresh]]
            above[act] = at
        has = above[act] >= 0
        out[act[has]] -= self.low[0][0] if has.any() else 0.0
        out[act[~has]] -= np.log10(256.0)
        return out


def held_out(id_col: str = "doc_id", parts: int = 7, part: int = 2) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def count(documents: DataFrame, text_col: str = "text", order: int = ORDER) -> DataFrame:
    """Counts over all rows, written: kind (0: byte n-gram, 1: token), k1, k2, n."""
    ship(documents.sparkSession)
    rows = documents.select(F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return written(rows.mapInArrow(lambda b: _count_batches(b, order), "kind int, k1 long, k2 long, n long").groupBy("kind", "k1", "k2").agg(F.sum("n").alias("n")), "counts")


class Low(NamedTuple):
    """The trie's order, and its n-grams of the levels below the shards."""

    order: int
    grams: list[tuple[np.ndarray, np.ndarray]]


def _masked(keys: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of depth k in those of a greater depth."""
    keys = keys & np.uint64((1 << 8 * (k + 1)) - 1)
    by = np.argsort(keys)
    keys = keys[by]
    at = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    return keys[at], np.add.reduceat(counts[by], at) if len(at) else np.zeros(0, np.int64)


def train(counts: DataFrame, order: int = ORDER) -> Low:
    """The n-grams of the levels below the shards, at most 65,792; the levels above stay in the counts."""
    below = min(SHARD, order)
    key = F.col("k1").bitwiseAND(F.lit((1 << 8 * below) - 1))
    low = counts.where("kind = 0").groupBy(key.alias("key")).agg(F.sum("n").alias("n")).toArrow()
    keys, n = low["key"].to_numpy().astype(np.int64).view(np.uint64), low["n"].to_numpy().astype(np.int64)
    return Low(order, [_masked(keys, n, k) for k in range(below)])


def _graded(grams: DataFrame, asked: DataFrame, low: Low) -> DataFrame:
    """k1, value: log10 probability of each asked n-gram's last byte after the others, by the trie of all grams (k1, n)."""

    def grade(tables: list[pa.Table]):
        t = pa.concat_tables(tables)
        key, n = t["k1"].to_numpy().view(np.uint64), t["n"].to_numpy()
        known = n > 0
        ask = key[~known]
        levels = [_masked(key[known], n[known], k) for k in range(len(low.grams), low.order + 1)]
        return pa.RecordBatch.from_arrays([pa.array(ask.view(np.int64)), pa.array(Trie([*low.grams, *levels]).score(ask))], names=["k1", "value"])

    def run(batches):
        held: list[pa.Table] = []
        size, last = 0, None
        for batch in batches:
            table = pa.Table.from_batches([batch])
            shard = table["shard"].to_numpy()
            cut = [0, *(np.flatnonzero(shard[1:] != shard[:-1]) + 1).tolist(), len(shard)]
            for a, b in zip(cut, cut[1:]):
                if a == b:
                    continue
                if size >= GRADED and shard[a] != last:
                    yield grade(held)
                    held, size = [], 0
                    trimmed()
                held.append(table.slice(a, b - a))
                size, last = size + b - a, shard[a]
        if held:
            yield grade(held)
            held.clear()
        trimmed()

    shard = F.shiftrightunsigned("k1", 8).bitwiseAND(F.lit((1 << 8 * len(low.grams)) - 1)).alias("shard")
    rows = grams.select(shard, "k1", "n").unionByName(asked.select(shard, "k1", F.lit(0).cast("long").alias("n")))
    return rows.repartition("shard").sortWithinPartitions("shard").mapInArrow(run, "k1 long, value double")


def _frequent(grams: DataFrame, head: int) -> tuple[np.ndarray, np.ndarray]:
    """At most `head` of the most frequent n-grams, ascending, and their log10 probabilities."""
    top = 1 << 12
    steps = sorted(grams.groupBy(F.least("n", F.lit(top)).alias("n")).agg(F.count("*").alias("k"), F.sum("n").alias("all")).collect(), reverse=True)
    least, have = -(-sum(r["all"] for r in steps) // head), 0
    for r in steps:
        have += r["k"]
        if have > head:
            break
        least = min(least, r["n"])
    context = F.shiftrightunsigned("k1", 8).alias("context")
    sums = grams.groupBy(context).agg(F.log10(F.sum("n") + F.count("*")).alias("free"))
    found = grams.where(F.col("n") >= max(least, 1)).select("k1", context, "n").join(sums, "context").select("k1", (F.log10("n") - F.col("free")).alias("value")).toArrow()
    keys, value = found["k1"].to_numpy().astype(np.int64).view(np.uint64), found["value"].to_numpy().astype(float)
    by = np.argsort(keys)
    return keys[by], value[by]


class _Head:
    def __init__(self, k1: np.ndarray, k2: np.ndarray, n: np.ndarray):
        self.table, self.k2, self.n = Table(k1), k2, n


class _Scores:
    """Scores of n-grams; its lookup table is built where it arrives."""

    def __init__(self, keys: np.ndarray, value: np.ndarray):
        self.keys, self.value = keys, value

    def __getstate__(self):
        return self.keys, self.value

    def __setstate__(self, state):
        self.keys, self.value = state
        self.table = Table(self.keys)


def _counted(doc: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each distinct (doc, a, b), ascending, and how often it occurs."""
    by = np.lexsort((b, a, doc))
    doc, a, b = doc[by], a[by], b[by]
    new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])))) if len(doc) else np.zeros(0, np.int64)
    return doc[new], a[new], b[new], np.diff(np.append(new, len(doc)))


def score(documents: DataFrame, counts: DataFrame, low: Low, id_col: str = "doc_id", text_col: str = "text", head: int = HEAD, frequent: int = FREQUENT) -> DataFrame:
    """id, n_tokens, n_known, train_tokens, base_score, score."""
    spark = documents.sparkSession
    ship(spark)
    grams, words = counts.where("kind = 0").select("k1", "n"), counts.where("kind = 1")
    is_end = (F.col("k1") == _END_TOKEN[0]) & (F.col("k2") == _END_TOKEN[1])
    total, kinds, end_n = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*"), F.coalesce(F.sum(F.when(is_end, F.col("n"))), F.lit(0))).first()
    top = words.where(F.col("n") * head >= total).select("k1", "k2", "n").toPandas().sort_values(["k1", "k2"]).drop_duplicates("k1", keep=False)
    shared = spark.sparkContext.broadcast((_Scores(*_frequent(grams, frequent)), _Head(*(top[c].to_numpy(np.int64).view(t) for c, t in (("k1", np.uint64), ("k2", np.uint64), ("n", np.int64))))))
    below = float(np.log10(total + kinds + 1))
    order = low.order
    rows = documents.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    if not documents.groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        rows = rows.dropDuplicates()
    rows = rows.withColumn("h", F.xxhash64("text"))
    kind = rows.schema["id"].dataType
    schema = T.StructType([T.StructField("id", kind), T.StructField("h", T.LongType()), *(T.StructField(c, t) for c, t in (("n_tokens", T.LongType()), ("n_known", T.LongType()), ("base_score", T.DoubleType()), ("score", T.DoubleType()), ("rare", T.ArrayType(T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("k1", T.LongType()), T.StructField("k2", T.LongType()), T.StructField("tf", T.IntegerType())])))))])

    def run(batches):
        model, known = shared.value
        for batch in batches:
            for part, raw, offs in slices(batch, "text", SLICE):
                key, first = symbols(raw, offs, order)
                n = part.num_rows
                owner = np.repeat(np.arange(n), np.diff(first))
                at = model.table.find(key)
                hit = at >= 0
                logs = np.bincount(owner[hit], model.value[at[hit]], n)[:n].astype(float)
                deep = _counted(owner[~hit], key[~hit], np.zeros(int((~hit).sum()), np.uint64))
                h1, h2, doc = tokens(raw, offs)
                at = known.table.find(h1)
                hit = at >= 0
                hit[hit] = known.k2[at[hit]] == h2[hit]
                base = np.bincount(doc[hit], np.log10(known.n[at[hit]] + 1.0) - below, n)[:n]
                known_n = np.bincount(doc[hit], minlength=n)[:n]
                miss = np.flatnonzero(~hit)
                far = _counted(doc[miss], h1[miss], h2[miss])
                by = np.argsort(np.concatenate((deep[0], far[0])), kind="stable")
                kind_, a, b, tf = (np.concatenate(x)[by] for x in ((np.zeros(len(deep[0]), np.int32), np.ones(len(far[0]), np.int32)), *zip(deep[1:], far[1:])))
                per = np.bincount(deep[0], minlength=n)[:n] + np.bincount(far[0], minlength=n)[:n]
                rare = pa.StructArray.from_arrays([pa.array(kind_), pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(tf.astype(np.int32))], names=["kind", "k1", "k2", "tf"])
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(2),
                        pa.array(np.bincount(doc, minlength=n)[:n] + 1, pa.int64()),
                        pa.array(known_n + int(end_n > 0), pa.int64()),
                        pa.array(base + np.log10(end_n + 1.0) - below),
                        pa.array(logs),
                        pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(per))), pa.int32()), rare),
                    ],
                    names=schema.names,
                )
        trimmed()

    scored = written(rows.mapInArrow(run, schema), "scored")
    rare = scored.select("id", "h", F.explode("rare").alias("r")).select("id", "h", "r.*")
    asked = rare.where("kind = 0").select("k1").distinct()
    graded = _graded(grams, asked, low).select(F.lit(0).alias("kind"), "k1", F.lit(0).cast("long").alias("k2"), "value")
    values = words.select("kind", "k1", "k2", (F.log10(F.col("n") + 1.0) - below).alias("value")).unionByName(graded)
    is_word = F.col("kind") == 1
    rest = rare.join(values, ["kind", "k1", "k2"], "left").groupBy("id", "h").agg(
        F.sum(F.when(is_word, F.col("tf") * F.coalesce("value", F.lit(-below)))).alias("more"),
        F.sum(F.when(is_word & F.col("value").isNotNull(), F.col("tf"))).alias("also"),
        F.sum(F.when(~is_word, F.col("tf") * F.col("value"))).alias("deep"),
    )
    full = scored.drop("rare").alias("s").join(rest.alias("r"), F.col("s.id").eqNullSafe(F.col("r.id")) & (F.col("s.h") == F.col("r.h")), "left")
    found = full.select(F.col("s.id").alias("id"), F.col("s.h").alias("h"), "n_tokens", (F.col("n_known") + F.coalesce("also", F.lit(0))).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"), (F.col("base_score") + F.coalesce("more", F.lit(0.0))).alias("base_score"), (F.col("score") + F.coalesce("deep", F.lit(0.0))).alias("score"))
    return found.withColumnRenamed("id", id_col)


def report(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", order: int = ORDER) -> DataFrame:
    """Learns from what isn't held out and scores all: id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    counts = count(documents.where(~held_out(id_col)), text_col, order)
    scored = score(documents, counts, train(counts, order), id_col, text_col)
    columns = [id_col, held_out(id_col).alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    if documents.groupBy(id_col).agg(F.count("*").alias("n")).where("n > 1").isEmpty():
        return scored.select(*columns)
    rows = documents.select(F.col(id_col).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_h"))
    return rows.join(scored, F.col("_id").eqNullSafe(F.col(id_col)) & (F.col("_h") == F.col("h"))).select(*columns)
