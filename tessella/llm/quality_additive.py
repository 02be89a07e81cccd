"""Quality scores by a generalised additive model with pairwise interactions.

Numeric features of a text are cut into bins at training quantiles. Boosting goes through the features in turn, round
after round: each step fits a shallow regression tree on one feature's bins to the log-loss gradient and adds a
small multiple of it to that feature's table. Then the pairs of features with the greatest gain on what is left
get tables of their own the same way, on coarser bins. A score is the logistic of the intercept plus one addition
from each table, for a whole batch of documents at once.

Training reads at most `sample` labelled rows, those of least hash, so the driver's arrays have a fixed bound; scoring
reads every document and moves none.

Defined results: a null text is an empty one, whose features are 0; labels that are null or neither 0 nor 1 teach
nothing; with no labels every score is 0.5; with one class every score is near it; each of several different labels of a
document counts, repeated rows count once; a null id is scored and not held out; columns other than those named are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tessella.llm.arrays import WORD, Words, slices
from tessella.shipping import ship

SAMPLE = 20_000
_BYTES = np.arange(256)
_CLASSES = {
    "upper": (_BYTES >= 65) & (_BYTES <= 90),
    "digit": (_BYTES >= 48) & (_BYTES <= 57),
    "space": np.isin(_BYTES, [32, 9, 13]),
    "line": _BYTES == 10,
    "stop": np.isin(_BYTES, list(b".,;:?'\"-()")),
    "bang": _BYTES == 33,
    "symbol": np.isin(_BYTES, list(b"#$%&*+/<=>@[\\]^_`{|}~")),
    "beyond_ascii": _BYTES >= 192,
}
FEATURES = ["log_bytes", *_CLASSES, "word_length", "distinct_words", "upper_words", "repeated_lines", "line_words", "digits_in_words"]


def features(raw: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """One row for each document of a slice."""
    n = len(offs) - 1
    size = np.diff(offs)
    some = np.maximum(size, 1)
    out = np.zeros((n, len(FEATURES)))
    out[:, 0] = np.log1p(size)

    def per_doc(mask: np.ndarray) -> np.ndarray:
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return total[offs[1:]] - total[offs[:-1]]

    code = np.zeros(256, dtype=np.uint8)
    for k, table in enumerate(_CLASSES.values(), 1):
        code[table] = k
    kind = code[raw]
    doc_code = np.repeat(np.arange(n, dtype=np.int64) * 16, size) + kind
    counts = np.bincount(doc_code, minlength=16 * n).reshape(n, 16) if n else np.zeros((0, 16))
    for k in range(1, len(_CLASSES) + 1):
        out[:, k] = counts[:, k] / some
    lines = counts[:, 1 + list(_CLASSES).index("line")] + 1
    words = Words(raw, offs)
    n_words = np.maximum(words.per_doc, 1)
    at = 1 + len(_CLASSES)
    out[:, at] = per_doc(WORD[words.low]) / n_words
    order = np.lexsort((words.hash, words.doc))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (words.hash[order][1:] != words.hash[order][:-1]) | (words.doc[order][1:] != words.doc[order][:-1])
    out[:, at + 1] = np.bincount(words.doc[order][new], minlength=n)[:n] / n_words
    if len(words.start):
        out[:, at + 2] = np.bincount(words.doc, _CLASSES["upper"][raw[words.start]], minlength=n)[:n] / n_words
        has_digit = np.concatenate(([0], np.cumsum(_CLASSES["digit"][raw])))
        out[:, at + 5] = np.bincount(words.doc, has_digit[words.end] > has_digit[words.start], minlength=n)[:n] / n_words
        line_no = np.concatenate(([0], np.cumsum(raw == 10)))[words.start]
        key = words.doc * (int(line_no[-1]) + 1) + line_no
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        line_hash = np.add.reduceat(words.hash * (2 * np.arange(len(words.hash), dtype=np.uint64) - np.repeat(2 * first.astype(np.uint64), np.diff(np.append(first, len(key)))) + np.uint64(1)), first)
        line_doc = words.doc[first]
        order = np.lexsort((line_hash, line_doc))
        same = (line_hash[order][1:] == line_hash[order][:-1]) & (line_doc[order][1:] == line_doc[order][:-1])
        out[:, at + 3] = np.bincount(line_doc[order][1:][same], minlength=n)[:n] / np.maximum(np.bincount(line_doc, minlength=n)[:n], 1)
    out[:, at + 4] = words.per_doc / lines
    return out


def _tree(g: np.ndarray, h: np.ndarray, leaves: int, smooth: float) -> np.ndarray:
    """Step values for bins in their order: a tree of few leaves on the bins' gradient and curvature sums."""
    edges = [0, len(g)]
    cg, ch = np.concatenate(([0.0], np.cumsum(g))), np.concatenate(([0.0], np.cumsum(h)))
    gain_of = lambda a, b: (cg[b] - cg[a]) ** 2 / (ch[b] - ch[a] + smooth)
    for _ in range(leaves - 1):
        best = (1e-9, None)
        for a, b in zip(edges[:-1], edges[1:]):
            if b - a > 1:
                cut = np.arange(a + 1, b)
                gain = gain_of(a, cut) + gain_of(cut, b) - gain_of(a, b)
                i = int(gain.argmax())
                best = max(best, (float(gain[i]), int(cut[i])), key=lambda x: x[0])
        if best[1] is None:
            break
        edges = sorted([*edges, best[1]])
    out = np.zeros(len(g))
    for a, b in zip(edges[:-1], edges[1:]):
        out[a:b] = (cg[b] - cg[a]) / (ch[b] - ch[a] + smooth)
    return out


def _quadrants(g: np.ndarray, h: np.ndarray, smooth: float) -> tuple[float, np.ndarray]:
    """The best pair of cuts of a square of bins, and its four step values."""
    cg, ch = (np.zeros((g.shape[0] + 1, g.shape[1] + 1)) for _ in range(2))
    cg[1:, 1:], ch[1:, 1:] = g.cumsum(0).cumsum(1), h.cumsum(0).cumsum(1)
    parts = []
    for c in (cg, ch):
        a = c[1:-1, 1:-1]
        parts.append(np.stack([a, c[1:-1, -1:] - a, c[-1:, 1:-1] - a, c[-1, -1] - c[1:-1, -1:] - c[-1:, 1:-1] + a]))
    gain = (parts[0] ** 2 / (parts[1] + smooth)).sum(axis=0)
    i, j = np.unravel_index(int(gain.argmax()), gain.shape)
    value = (parts[0] / (parts[1] + smooth))[:, i, j]
    out = np.zeros(g.shape)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = value
    return float(gain[i, j]), out


@dataclass
class AdditiveModel:
    intercept: float
    cuts: list[np.ndarray]
    tables: list[np.ndarray]
    coarse: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray]]

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, rounds: int = 60, pair_rounds: int = 20, rate: float = 0.15, bins: int = 48, coarse_bins: int = 8, n_pairs: int = 6, leaves: int = 3, smooth: float = 5.0) -> AdditiveModel:
        n_features = x.shape[1]
        if not len(y):
            return cls(0.0, [np.zeros(0)] * n_features, [np.zeros(1)] * n_features, [np.zeros(0)] * n_features, [])
        prior = (y.sum() + 0.5) / (len(y) + 1)
        quantiles = lambda v, k: np.unique(np.quantile(v, np.linspace(0, 1, k + 1)[1:-1]))
        model = cls(float(np.log(prior / (1 - prior))), [quantiles(v, bins) for v in x.T], [], [quantiles(v, coarse_bins) for v in x.T], [])
        model.tables = [np.zeros(len(c) + 1) for c in model.cuts]
        fine = [np.searchsorted(c, v, side="right") for c, v in zip(model.cuts, x.T)]
        rough = [np.searchsorted(c, v, side="right") for c, v in zip(model.coarse, x.T)]
        f = np.full(len(y), model.intercept)
        for _ in range(rounds):
            for k in range(n_features):
                p = 1 / (1 + np.exp(-f))
                m = len(model.tables[k])
                step = rate * _tree(np.bincount(fine[k], y - p, m), np.bincount(fine[k], p * (1 - p), m), leaves, smooth)
                model.tables[k] += step
                f += step[fine[k]]
        p = 1 / (1 + np.exp(-f))
        gains = []
        shape = [len(c) + 1 for c in model.coarse]
        square = lambda i, j, v: np.bincount(rough[i] * shape[j] + rough[j], v, shape[i] * shape[j]).reshape(shape[i], shape[j])
        for i in range(n_features):
            for j in range(i):
                if min(shape[i], shape[j]) > 1:
                    gains.append((_quadrants(square(i, j, y - p), square(i, j, p * (1 - p)), smooth)[0], i, j))
        chosen = [(i, j, np.zeros((shape[i], shape[j]))) for _, i, j in sorted(gains, reverse=True)[:n_pairs]]
        for _ in range(pair_rounds):
            for i, j, table in chosen:
                p = 1 / (1 + np.exp(-f))
                step = rate * _quadrants(square(i, j, y - p), square(i, j, p * (1 - p)), smooth)[1]
                table += step
                f += step[rough[i], rough[j]]
        model.pairs = chosen
        return model

    def score(self, x: np.ndarray) -> np.ndarray:
        f = np.full(len(x), self.intercept)
        for k, (cuts, table) in enumerate(zip(self.cuts, self.tables)):
            f += table[np.searchsorted(cuts, x[:, k], side="right")]
        for i, j, table in self.pairs:
            f += table[np.searchsorted(self.coarse[i], x[:, i], side="right"), np.searchsorted(self.coarse[j], x[:, j], side="right")]
        return 1 / (1 + np.exp(-f))


def held_out(id_col: str = "doc_id", parts: int = 3, part: int = 1):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % parts == part, F.lit(False))


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", sample: int = SAMPLE) -> AdditiveModel:
    """Fit on at most `sample` labelled rows that aren't held out."""
    spark = documents.sparkSession
    ship(spark)
    chosen = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull() & ~held_out(id_col)).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).orderBy(F.xxhash64("id"), "id", "y").limit(sample)
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "id")  # at most `sample` pairs of integers

    def run(batches):
        for batch in batches:
            for part, raw, offs in slices(batch, "text"):
                x = features(raw, offs)
                yield pa.RecordBatch.from_arrays([*(part.column(part.schema.get_field_index(c)) for c in ("id", "y")), *(pa.array(v) for v in x.T)], names=["id", "y", *FEATURES])

    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("y", T.IntegerType()), *(T.StructField(f, T.DoubleType()) for f in FEATURES)])
    least = rows.select("id", "y", "text").mapInArrow(run, schema).distinct().orderBy(F.xxhash64("id"), "id", "y", *FEATURES).limit(sample)  # one row a label, but where ids repeat over different texts
    found = least.toPandas().sort_values(["y", *FEATURES], kind="stable")
    return AdditiveModel.fit(found[FEATURES].to_numpy(), found["y"].to_numpy(dtype=float))


def score(documents: DataFrame, model: AdditiveModel, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, score."""
    ship(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)  # some tables of at most 64 numbers

    def run(batches):
        for batch in batches:
            for part, raw, offs in slices(batch, text_col):
                yield pa.RecordBatch.from_arrays([part.column(part.schema.get_field_index(id_col)), pa.array(shared.value.score(features(raw, offs)))], names=[id_col, "score"])

    return documents.select(id_col, text_col).mapInArrow(run, T.StructType([T.StructField(id_col, documents.schema[id_col].dataType), T.StructField("score", T.DoubleType())]))


def keep(documents: DataFrame, model: AdditiveModel, least: float = 0.5, text_col: str = "text") -> DataFrame:
    """The documents, same columns, that score at least `least`."""
    ship(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for part, raw, offs in slices(batch, text_col):
                yield part.filter(pa.array(shared.value.score(features(raw, offs)) >= least))

    return documents.mapInArrow(run, documents.schema)


def report(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, held_out, score, predicted."""
    scored = score(documents, train(documents, labels, id_col, text_col), id_col, text_col)
    return scored.select(id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
