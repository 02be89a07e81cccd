"""Token-id files: patched frame-of-reference blocks with an index of block starts.

A file holds the ids of some documents, in ascending document order. All integers are little-endian.

  magic "TPF1", block length u32, ids u64, documents u64, blocks u64
  for each block, one after another: minimum u32, width u8, exceptions u16,
      the low `width` bits of (id - minimum), packed least significant bit first, padded to a byte,
      exception positions u16 each, exception high parts u32 each
  block index: the byte offset of each block u64
  document index: for each document its id count u64, then whether it has a key u8, then its key i64
  the offset of the block index u64

The width of a block is that of the `percentile`-th of its differences: what is wider keeps its low bits in
place and its high part in the exception list.

Ids come from the tokenizers library. Latin texts are split into words here, by the vocabulary's pattern, so that the
ids of words already met can be kept in a bounded table; other texts go to the library whole.

Order: documents are dealt to range partitions by (key, hash of the text) with bounds taken from a sample, so
that one key with very many rows still spreads; within a partition they are sorted. Ranges decide only balance.
Writing goes to a name of its own and is then moved in place, so a repeated task leaves one whole file.

Defined results: null and empty texts hold only the end id; a null key sorts first; equal keys are ordered by their
text's hash, then by their ids; an empty table writes no file and reads as no rows; other columns are ignored.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window, functions as F, types as T

from tessella.llm.arrays import ranges, slices
from tessella.llm.bpe_automaton import SPACE, byte_symbols
from tessella.shipping import ship
from tessella.storage import scratch, written

BLOCK = 128
PERCENTILE = 90
FILE_IDS = 32 << 20
MAX_WORDS, MAX_WORD = 400_000, 48
#: The pattern of byte-level vocabularies, as published with them; letters and numbers before U+0250.
LATIN, NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾"
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_MAGIC = b"TPF1"
_HEAD = struct.Struct("<4sIQQQ")
_BLOCK_HEAD = np.dtype([("low", "<u4"), ("width", "u1"), ("odd", "<u2")])


def _packed(values: np.ndarray, width: int) -> np.ndarray:
    """Rows of integers' low bits side by side, by 64-bit words over all rows at once."""
    n, length = values.shape
    words = (length * width + 63) // 64
    acc = np.zeros((words + 1, n), dtype=np.uint64)
    columns = values.T.astype(np.uint64) & np.uint64((1 << width) - 1)
    for j in range(length if width else 0):
        i, shift = divmod(j * width, 64)
        acc[i] |= columns[j] << np.uint64(shift)
        if shift + width > 64:
            acc[i + 1] |= columns[j] >> np.uint64(64 - shift)
    return np.ascontiguousarray(acc[:words].T).view(np.uint8).reshape(n, words * 8)[:, : (length * width + 7) // 8]


def _unpacked(body: np.ndarray, length: int, width: int) -> np.ndarray:
    n = len(body)
    padded = np.zeros((n, (length * width + 63) // 64 * 8 + 8), dtype=np.uint8)
    padded[:, : body.shape[1]] = body
    acc = np.ascontiguousarray(padded.view(np.uint64).T)
    out = np.zeros((length, n), dtype=np.uint32)
    for j in range(length if width else 0):
        i, shift = divmod(j * width, 64)
        x = acc[i] >> np.uint64(shift)
        if shift + width > 64:
            x |= acc[i + 1] << np.uint64(64 - shift)
        out[j] = x & np.uint64((1 << width) - 1)
    return np.ascontiguousarray(out.T)


def pack_blocks(ids: np.ndarray, percentile: int = PERCENTILE) -> tuple[bytes, np.ndarray]:
    """Encode blocks, an array of shape (blocks, block length): their bytes end to end, and how many each has."""
    n, length = ids.shape
    low = ids.min(axis=1)
    rest = (ids - low[:, None]).astype(np.uint32)
    k = min(length - 1, (length * percentile + 99) // 100 - 1)
    pivot = np.partition(rest, k, axis=1)[:, k]
    width = np.where(pivot > 0, np.floor(np.log2(np.maximum(pivot, 1).astype(np.float64))).astype(np.int64) + 1, 0)
    size = _BLOCK_HEAD.itemsize
    parts = []
    for w in np.unique(width).tolist():
        rows = np.flatnonzero(width == w)
        part = rest[rows]
        high = part >> np.uint32(w) if w < 32 else np.zeros_like(part)
        line, column = np.nonzero(high)
        parts.append((w, rows, np.bincount(line, minlength=len(rows)), _packed(part, w), column.astype("<u2"), high[line, column].astype("<u4")))
    lengths = np.zeros(n, dtype=np.int64)
    for _, rows, counts, body, _, _ in parts:
        lengths[rows] = size + body.shape[1] + 6 * counts
    starts = np.cumsum(lengths) - lengths
    out = np.zeros(int(lengths.sum()), dtype=np.uint8)
    for w, rows, counts, body, column, value in parts:
        head = np.zeros(len(rows), dtype=_BLOCK_HEAD)
        head["low"], head["width"], head["odd"] = low[rows], w, counts
        at = starts[rows]
        out[at[:, None] + np.arange(size)] = head.view(np.uint8).reshape(len(rows), size)
        out[at[:, None] + size + np.arange(body.shape[1])] = body
        at = at + size + body.shape[1]
        out[ranges(at, 2 * counts)] = column.view(np.uint8)
        out[ranges(at + 2 * counts, 4 * counts)] = value.view(np.uint8)
    return out.tobytes(), lengths


def unpack_blocks(data: bytes, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Decode the blocks that begin at these offsets; lengths: ids in each."""
    heads = np.zeros(len(starts), dtype=_BLOCK_HEAD)
    raw = np.frombuffer(data, dtype=np.uint8)
    size = _BLOCK_HEAD.itemsize
    heads[:] = raw[starts[:, None] + np.arange(size)].copy().view(_BLOCK_HEAD)[:, 0]
    out = np.zeros(int(lengths.sum()), dtype=np.uint32)
    first = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
    for length in np.unique(lengths).tolist():
        for w in np.unique(heads["width"][lengths == length]).tolist():
            rows = np.flatnonzero((lengths == length) & (heads["width"] == w))
            packed = (length * w + 7) // 8
            values = _unpacked(raw[starts[rows, None] + size + np.arange(packed)], length, w)
            counts = heads["odd"][rows].astype(np.int64)
            if counts.any():
                at = starts[rows] + size + packed
                where = raw[ranges(at, 2 * counts)].view("<u2")
                values[np.repeat(np.arange(len(rows)), counts), where] |= raw[ranges(at + 2 * counts, 4 * counts)].view("<u4") << np.uint32(w)
            values += heads["low"][rows][:, None]
            out[(first[rows][:, None] + np.arange(length)).reshape(-1)] = values.reshape(-1)
    return out


def to_bytes(ids: np.ndarray, counts: np.ndarray, keys: list[int | None], block: int = BLOCK, percentile: int = PERCENTILE) -> bytes:
    """One file's bytes. counts: ids of each document; keys: their document ids."""
    whole = len(ids) // block * block
    chunks = [ids[a : min(whole, a + block * 4096)].reshape(-1, block) for a in range(0, whole, block * 4096)] + [ids[whole:].reshape(1, -1)] * (whole < len(ids))
    packed = [pack_blocks(c, percentile) for c in chunks]
    sizes = np.concatenate([np.zeros(0, np.int64), *(n for _, n in packed)])
    head = _HEAD.pack(_MAGIC, block, len(ids), len(counts), len(sizes))
    starts = len(head) + np.concatenate(([0], np.cumsum(sizes)))
    index = starts[:-1].astype("<u8").tobytes()
    has = np.array([k is not None for k in keys], dtype=np.uint8)
    docs = np.asarray(counts, dtype="<u8").tobytes() + has.tobytes() + np.array([k or 0 for k in keys], dtype="<i8").tobytes()
    return b"".join([head, *(b for b, _ in packed), index, docs, struct.pack("<Q", int(starts[-1]))])


class TokenFile:
    """A file's indexes, and any range of its ids by decoding only the blocks that hold it."""

    def __init__(self, data: bytes):
        magic, self.block, self.n_ids, n_docs, n_blocks = _HEAD.unpack_from(data)
        if magic != _MAGIC:
            raise ValueError("not a token file")
        self.data = data
        at = struct.unpack_from("<Q", data, len(data) - 8)[0]
        self.starts = np.frombuffer(data, "<u8", n_blocks, at).astype(np.int64)
        at += 8 * n_blocks
        self.counts = np.frombuffer(data, "<u8", n_docs, at).astype(np.int64)
        has = np.frombuffer(data, "u1", n_docs, at + 8 * n_docs)
        keys = np.frombuffer(data, "<i8", n_docs, at + 9 * n_docs)
        self.keys = [k if h else None for k, h in zip(keys.tolist(), has.tolist())]
        self.first = np.concatenate(([0], np.cumsum(self.counts)))

    def ids(self, a: int, b: int) -> np.ndarray:
        if a >= b:
            return np.zeros(0, np.uint32)
        i, j = a // self.block, (b - 1) // self.block + 1
        lengths = np.minimum(self.block, self.n_ids - np.arange(i, j) * self.block)
        return unpack_blocks(self.data, self.starts[i:j], lengths)[a - i * self.block : b - i * self.block]

    def documents(self, chunk: int = 1 << 20) -> Iterator[tuple[int | None, int, np.ndarray]]:
        """(key, ids before it in this file, its ids), a chunk of ids in memory at a time."""
        d, n = 0, len(self.counts)
        while d < n:
            to = max(d + 1, int(np.searchsorted(self.first, self.first[d] + chunk, side="right")) - 1)
            ids = self.ids(int(self.first[d]), int(self.first[to]))
            for i in range(d, to):
                yield self.keys[i], int(self.first[i]), ids[self.first[i] - self.first[d] : self.first[i + 1] - self.first[d]]
            d = to


class ByteLevelEncoder:
    """The tokenizers library's model behind a table of the words already met."""

    def __init__(self, spec: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.model, self.split = self.tokenizer.model, self.tokenizer.pre_tokenizer.pre_tokenize_str
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # the published pattern, with its classes spelled out for Latin text
        pattern = PATTERN.replace(r"^\s\p{L}\p{N}", f"^{SPACE}{LATIN}{NUMBERS}").replace(r"\p{L}", f"[{LATIN}]").replace(r"\p{N}", f"[{NUMBERS}]")
        self.latin = re.compile(pattern.replace(r"\S", f"[^{SPACE}]").replace(r"\s", f"[{SPACE}]")).findall
        self.beyond = re.compile("[^\0-\u024f]").search
        self.symbols = byte_symbols()
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}  # the table before the last time it was full

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def word(self, word: str) -> bytes:
        """Ids of one word of the pattern."""
        out = self.before.get(word)
        if out is None:
            symbols = "".join([self.symbols[b] for b in word.encode()])
            ids = [t.id for t in self.model.tokenize(symbols)]
            out = struct.pack(f"<{len(ids)}I", *ids)
        if len(self.known) >= MAX_WORDS:
            self.known, self.before = {}, self.known
        if len(word) <= MAX_WORD:
            self.known[word] = out
        return out

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian 32-bit integers. Special tokens, and characters beyond Latin, are left to the library."""
        if not text:
            return b""
        if self.beyond(text) or any(s in text for s in self.special):
            return self.whole(text)
        get, word = self.known.get, self.word
        return b"".join([get(w) or word(w) for w in self.latin(text)])


@lru_cache(maxsize=2)
def _encoder(spec: str) -> ByteLevelEncoder:
    return ByteLevelEncoder(spec)


def encode(documents: DataFrame, vocabulary: str, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, h (hash of the text), ids (little-endian unsigned integers of 16 or 32 bits, as `wide` says)."""
    spark = documents.sparkSession
    ship(spark)
    with open(vocabulary, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast(f.read())  # one vocabulary file
    end = np.array([end_id], dtype="<u4").tobytes()

    def run(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = _encoder(shared.value)
        for batch in batches:
            for part, _, _ in slices(batch, "text"):
                ids = [np.frombuffer(x + end, dtype="<u4") for x in map(encoder.encode, part.column(2).to_pylist())]
                wide = [bool(x.max() > 65535) for x in ids]
                packed = [x.tobytes() if w else x.astype("<u2").tobytes() for x, w in zip(ids, wide)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(wide), pa.array(packed, pa.binary())], names=["key", "h", "wide", "ids"])

    rows = documents.select(F.col(id_col).cast("long").alias("key"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("h"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "key long, h long, wide boolean, ids binary")


def _bounds(documents: DataFrame, id_col: str, text_col: str, parts: int, sampled: int) -> list[tuple[int, int]]:
    """parts - 1 ascending (key, hash) bounds from a sample of about `sampled` rows; they decide balance alone."""
    rows = max(1, documents.count())
    sample = documents.where(F.col(id_col).isNotNull())
    if rows > sampled:
        sample = sample.sample(sampled / rows, seed=7)
    found = sorted((r[0], r[1], r[2]) for r in sample.select(F.col(id_col).cast("long"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))), F.length(F.coalesce(F.col(text_col), F.lit("")))).limit(2 * sampled).collect())
    weights = np.cumsum([x[2] + 1 for x in found])
    if not len(weights):
        return []
    at = np.searchsorted(weights, weights[-1] * np.arange(1, parts) / parts)
    return sorted({found[i][:2] for i in at.tolist()})


def write(documents: DataFrame, vocabulary: str, path: str | None = None, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", block: int = BLOCK, percentile: int = PERCENTILE, file_ids: int = FILE_IDS, parts: int | None = None, sampled: int = 20_000) -> DataFrame:
    """Write the files; returns the manifest: path, first (ids before the file), n_ids, n_docs."""
    spark = documents.sparkSession
    path = path or scratch(spark, "tokens")
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds = _bounds(documents, id_col, text_col, parts, sampled)
    bucket = F.lit(0)
    if bounds:
        edges = F.array(*[F.struct(F.lit(k).alias("key"), F.lit(h).alias("h")) for k, h in bounds])
        bucket = F.when(F.col("key").isNull(), 0).otherwise(F.size(F.filter(edges, lambda e: e < F.struct("key", "h"))))
    encoded = encode(documents, vocabulary, end_id, id_col, text_col).withColumn("bucket", bucket.cast("int"))

    def run(batches):
        store, base = fs.FileSystem.from_uri(path)
        store.create_dir(base)
        held: list[np.ndarray] = []
        keys: list[int | None] = []
        total, now, seq = 0, None, 0

        def flushed():
            name = f"{base}/part-{now:08d}-{seq:05d}.tpf"
            data = to_bytes(np.concatenate(held), np.array([len(x) for x in held]), keys, block, percentile)
            own = f"{base}/.{uuid.uuid4().hex}"
            with store.open_output_stream(own) as out:
                out.write(data)
            store.move(own, name)
            return pa.RecordBatch.from_pydict({"bucket": pa.array([now], pa.int32()), "seq": pa.array([seq], pa.int32()), "path": [f"{path}/{name.rpartition('/')[2]}"], "n_ids": [total], "n_docs": [len(keys)]})

        for batch in batches:
            for key, wide, ids, b in zip(*(batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("key", "wide", "ids", "bucket"))):
                if keys and (b != now or total >= file_ids):
                    yield flushed()
                    seq = seq + 1 if b == now else 0
                    held, keys, total = [], [], 0
                now = b
                held.append(np.frombuffer(ids, dtype="<u4" if wide else "<u2").astype(np.uint32))
                keys.append(key)
                total += len(held[-1])
        if keys:
            yield flushed()

    files = encoded.repartitionById(len(bounds) + 1, F.col("bucket")).sortWithinPartitions(F.asc_nulls_first("key"), "h", "ids").mapInArrow(run, "bucket int, seq int, path string, n_ids long, n_docs long")
    files = written(files, "token-manifest")
    order = Window.orderBy("bucket", "seq").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    return files.select("path", F.coalesce(F.sum("n_ids").over(order), F.lit(0)).alias("first"), "n_ids", "n_docs")


def read(manifest: DataFrame) -> DataFrame:
    """Each document from the files: key, start (ids of all documents before it), ids."""
    return _read(manifest, "key long, start long, ids array<int>", lambda rows: {"key": pa.array([r[0] for r in rows], pa.int64()), "start": pa.array([r[1] for r in rows], pa.int64()), "ids": pa.array([r[2].astype(np.int32) for r in rows], pa.list_(pa.int32()))})


def _read(manifest: DataFrame, schema: str, columns) -> DataFrame:
    spark = manifest.sparkSession
    ship(spark)

    def run(batches):
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                store, name = fs.FileSystem.from_uri(path)
                with store.open_input_file(name) as f:
                    file = TokenFile(f.read())
                rows = []
                for key, start, ids in file.documents():
                    rows.append((key, first + start, ids))
                    if len(rows) == 2000:
                        yield pa.RecordBatch.from_pydict(columns(rows))
                        rows = []
                if rows:
                    yield pa.RecordBatch.from_pydict(columns(rows))

    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return manifest.select("path", "first").repartition(parts).mapInArrow(run, schema)


def report(documents: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Writes the files and digests what is read back: id, start, n_tokens, ids_crc32."""
    manifest = write(documents, vocabulary, id_col=id_col, text_col=text_col, **options)

    def columns(rows):
        return {id_col: pa.array([r[0] for r in rows], pa.int64()), "start": pa.array([r[1] for r in rows], pa.int64()), "n_tokens": pa.array([len(r[2]) for r in rows], pa.int64()), "ids_crc32": pa.array([zlib.crc32(r[2].astype("<u4").tobytes()) for r in rows], pa.int64())}

    return _read(manifest, T.StructType([T.StructField(c, T.LongType()) for c in (id_col, "start", "n_tokens", "ids_crc32")]), columns)
