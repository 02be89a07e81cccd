"""Language identification by rank-order n-gram profiles.

Letters are lower-cased; every run of other characters is one word boundary. A document's profile is its
`profile_size` most frequent character n-grams (1 to 3 characters, inside words with their boundaries), most
frequent first, ties by the n-gram itself. A language's profile is made the same way from the counts of all its
training documents. The out-of-place distance adds, for each n-gram of the document, how far its rank is
from its rank in the language profile, or `profile_size` if it isn't there; divided by the largest possible sum.

Prediction: the language of least distance (ties: the alphabetically first). Score: d2 / (d1 + d2) for the least
distance d1 and the next d2, so 0.5 is undecided and 1 is a perfect fit; 1 - d1 with one language.

Counting is combined within each task and slice before the one shuffle, whose rows are distinct
(language, n-gram) pairs. What is broadcast is one profile for each language, at most `max_languages` of them.

Defined results: a null text or one without letters is `und` with score 0; rows without a language or
text teach nothing; without any training rows every document is `und`; repeated rows count as often as they occur; a row without an id is predicted and not held out;
columns other than id, text and (for training) language are ignored.
"""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tessella.llm.arrays import slices
from tessella.shipping import ship

PROFILE_SIZE = 300
MAX_LANGUAGES = 10_000
_BREAK = 1
_codes: list[np.ndarray] = []


def _code_table() -> np.ndarray:
    """For each code point its lower-case form, or a boundary if it isn't a letter."""
    if not _codes:
        table = np.full(0x110000, _BREAK, dtype=np.uint64)
        for cp in range(sys.maxunicode + 1):
            c = chr(cp)
            if c.isalpha():
                low = c.lower()
                table[cp] = ord(low) if len(low) == 1 else cp
        _codes.append(table)
    return _codes[0]


def ngrams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """All n-grams of the texts as integers, text after text, and where each text's begin. 0: no n-gram."""
    joined = "\n" + "".join([(t or "") + "\n" for t in texts])
    cp = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype="<u4")
    c = _code_table()[cp]
    starts = np.concatenate(([1], 1 + np.cumsum([len(t or "") + 1 for t in texts])))
    keep = c != _BREAK
    keep[1:] |= keep[:-1]
    keep[0] = True
    at = np.concatenate(([0], np.cumsum(keep)))[starts]
    c = c[keep]
    letter = c != _BREAK
    out = np.zeros((len(c), 3), dtype=np.uint64)
    out[:, 0] = np.where(letter, c, 0)
    pair = (c[:-1] << np.uint64(21)) | c[1:]
    out[1:, 1] = np.where(letter[:-1] | letter[1:], pair, 0)
    triple = (c[:-2] << np.uint64(42)) | pair[1:]
    out[2:, 2] = np.where(letter[1:-1], triple, 0)
    return out.reshape(-1), at * 3


def ranked(grams: np.ndarray, size: int) -> np.ndarray:
    """The most frequent n-grams, most frequent first, ties by value."""
    keys, counts = np.unique(grams, return_counts=True)
    if len(keys) and keys[0] == 0:
        keys, counts = keys[1:], counts[1:]
    return keys[np.argsort(-counts, kind="stable")[:size]]


def _count_batches(batches, lang_col: str, text_col: str):
    held: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
    size = 0

    def folded(parts):
        keys, inverse = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
        return keys, np.bincount(inverse, np.concatenate([n for _, n in parts])).astype(np.int64)

    def flushed():
        for lang, parts in held.items():
            keys, counts = folded(parts)
            for a in range(0, len(keys), 100_000):
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys[a : a + 100_000])), pa.array(keys[a : a + 100_000].astype(np.int64)), pa.array(counts[a : a + 100_000])], names=["lang", "gram", "n"])

    for batch in batches:
        for part, _, _ in slices(batch, text_col):
            langs = np.array(part.column(part.schema.get_field_index(lang_col)).to_pylist(), dtype=object)
            texts = part.column(part.schema.get_field_index(text_col)).to_pylist()
            for lang in sorted(set(langs)):
                grams, _ = ngrams([texts[i] for i in np.flatnonzero(langs == lang)])
                keys, counts = np.unique(grams, return_counts=True)
                parts = held.setdefault(lang, [])
                parts.append((keys[keys > 0], counts[keys > 0]))
                size += len(keys)
        if size > 4_000_000:
            held = {lang: [folded(parts)] for lang, parts in held.items()}
            size = sum(len(p[0][0]) for p in held.values())
            if size > 2_000_000:  # many alphabets: the shuffle sums what comes in parts
                yield from flushed()
                held, size = {}, 0
    yield from flushed()


def train(documents: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = PROFILE_SIZE) -> DataFrame:
    """The profiles: lang, gram, rank (from 0)."""
    ship(documents.sparkSession)
    rows = documents.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counts = rows.mapInArrow(lambda b: _count_batches(b, "lang", "text"), "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "gram")
    return counts.withColumn("rank", F.row_number().over(order) - 1).where(F.col("rank") < size).select("lang", "gram", "rank")


class Profiles:
    def __init__(self, rows: list[tuple[str, int, int]], size: int):
        self.size = size
        self.langs = sorted({r[0] for r in rows})
        where = {x: i for i, x in enumerate(self.langs)}
        self.grams = np.unique(np.array([r[1] for r in rows], dtype=np.int64)).astype(np.uint64)
        self.rank = np.full((len(self.grams) + 1, len(self.langs)), -1, dtype=np.int32)
        if rows:
            at = np.searchsorted(self.grams, np.array([r[1] for r in rows], dtype=np.uint64))
            self.rank[at, [where[r[0]] for r in rows]] = [r[2] for r in rows]

    def distances(self, profile: np.ndarray) -> np.ndarray:
        """To each language, from 0 to 1."""
        at = np.searchsorted(self.grams, profile)
        at[at == len(self.grams)] = 0
        at = np.where(self.grams[at] == profile, at, len(self.grams))
        rank = self.rank[at]
        off = np.where(rank < 0, self.size, np.abs(rank - np.arange(len(profile), dtype=np.int32)[:, None]))
        return off.sum(axis=0) / (len(profile) * self.size)

    def predict(self, profile: np.ndarray) -> tuple[str, float]:
        if not len(profile) or not self.langs:
            return "und", 0.0
        d = self.distances(profile)
        order = np.argsort(d, kind="stable")
        best = float(d[order[0]])
        if len(order) == 1:
            return self.langs[0], 1.0 - best
        second = float(d[order[1]])
        return self.langs[order[0]], second / (best + second) if best + second else 0.5


def predict(documents: DataFrame, profiles: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = PROFILE_SIZE, max_languages: int = MAX_LANGUAGES) -> DataFrame:
    """id, lang_pred, score."""
    spark = documents.sparkSession
    ship(spark)
    rows = [tuple(r) for r in profiles.limit(max_languages * size + 1).collect()]
    if len(rows) > max_languages * size:
        raise ValueError(f"more than {max_languages} languages; a language column is expected, not free text")
    shared = spark.sparkContext.broadcast(Profiles(rows, size))

    def run(batches):
        model = shared.value
        for batch in batches:
            for part, _, _ in slices(batch, text_col):
                grams, at = ngrams(part.column(part.schema.get_field_index(text_col)).to_pylist())
                found = [model.predict(ranked(grams[a:b], size)) for a, b in zip(at[:-1], at[1:])]
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(id_col)), pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], names=[id_col, "lang_pred", "score"])

    return documents.select(id_col, text_col).mapInArrow(run, T.StructType([T.StructField(id_col, documents.schema[id_col].dataType), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]))


def held_out(id_col: str = "doc_id", parts: int = 3, part: int = 1) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def report(documents: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """Learns from the rows that aren't held out and predicts all: id, held_out, lang_pred, score."""
    profiles = train(documents.where(~held_out(id_col)), lang_col, text_col)
    return predict(documents, profiles, id_col, text_col).select(id_col, held_out(id_col).alias("held_out"), "lang_pred", "score")
