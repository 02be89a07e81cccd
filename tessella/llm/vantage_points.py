"""Nearest neighbours by Euclidean distance with one vantage-point tree per shard.

Rows are dealt to shards of about `shard_rows` by a hash of id and vector; each shard becomes one tree, kept as a
row of the index, so every row is indexed. Below an inner node the rows lie in two halves by their distance from
the vantage point; a half whose distances are from lo to hi can hold nothing nearer than max(lo - d, d - hi) for a
query at distance d. A half is skipped if that exceeds `factor` times the query's present k-th distance: factor
one is exact search, less prunes more. Rows with equal vectors share one place in the tree, which holds
all their ids in ascending order; a search reads only the first k + 1 of them.

Search: queries travel in blocks of at most about `block_rows`. Each block first reads one shard, its home; the k-th distance
found there bounds what can still matter. Then the block goes, with these bounds, to every other shard by an equi-join
on the shard's number; a tree prunes by the bound from the start and answers only rows within it, so the answers of
all shards together are few times k a query. A task holds one tree and one block. Rank within a query decides. Blocks x
shards are read, as asked for: a hash shard spreads over the whole space, so no shard can be left out beforehand.

Defined results: vectors null, empty, all zero, or holding null or non-finite components take no part, nor do null ids;
repeated rows (same id and vector) count once; a query's own row isn't its candidate, other rows are, also one with the
same id and another vector; if an id occurs with several vectors, the least is its query; only vectors of a query's own
length are candidates; empty tables give no rows; further columns are ignored.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tessella.llm.arrays import ranges
from tessella.shipping import ship
from tessella.storage import written

SHARD_ROWS = 8192
BLOCK_ROWS = 256
LEAF = 256
_NO_ID = np.iinfo(np.int64).max


def distances(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Of each row of q from each row of x, in double precision, without cancelling; for few rows."""
    return np.sqrt(((q[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))


def exact(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Row by row, summed from the first component to the last."""
    total = np.zeros(len(q))
    for j in range(q.shape[1]):
        total += (q[:, j] - x[:, j]) ** 2
    return np.sqrt(total)


class Tree:
    """nodes: (vantage point, near (lo, hi, child), far (lo, hi, child)); a leaf: an array of places."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, leaf: int = LEAF, seed: int = 11):
        order = np.lexsort((ids, *vectors.T[::-1]))
        ids, vectors = ids[order], vectors[order]
        new = np.ones(len(ids), dtype=bool)
        new[1:] = (vectors[1:] != vectors[:-1]).any(axis=1)
        self.first = np.append(np.flatnonzero(new), len(ids))
        self.ids, self.vectors, self.nodes = ids, vectors[new], []
        self.leaf, self.random = leaf, np.random.default_rng(seed)
        self.root = self._grow(np.arange(len(self.vectors)))
        del self.random

    def _grow(self, rows: np.ndarray) -> int:
        if len(rows) <= self.leaf:
            self.nodes.append(rows)
            return len(self.nodes) - 1
        tried = self.random.choice(rows, 4, replace=False)
        others = self.random.choice(rows, min(64, len(rows)), replace=False)
        vp = tried[distances(self.vectors[tried], self.vectors[others]).std(axis=1).argmax()]
        rows = rows[rows != vp]
        d = distances(self.vectors[vp : vp + 1], self.vectors[rows])[0]
        half = len(rows) // 2
        order = np.argpartition(d, half)
        sides = []
        for side in (order[:half], order[half:]):
            sides.append((d[side].min(), d[side].max(), self._grow(rows[side])))
        self.nodes.append((int(vp), *sides))
        return len(self.nodes) - 1

    def search(self, own: np.ndarray, q: np.ndarray, k: int, factor: float = 1.0, bound: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """ids, places and distances of the k nearest within the bound (k columns); missing ones have an infinite distance."""
        m = len(q)
        bound = np.full(m, np.inf) if bound is None else bound * (1 + 1e-12)
        best = np.full((m, k), np.inf)
        ids, places = np.full((m, k), _NO_ID), np.zeros((m, k), dtype=np.int64)
        q_norm, x_norm = (q * q).sum(axis=1), (self.vectors * self.vectors).sum(axis=1)

        def offer(act: np.ndarray, rows: np.ndarray) -> None:
            """Nearness by one matrix product nominates; what can still be among the k nearest is measured exactly."""
            size = q_norm[act][:, None] + x_norm[rows][None, :]
            near = size - 2 * (q[act] @ self.vectors[rows].T)
            limit = np.minimum(best[act, k - 1], bound[act]) ** 2
            if len(rows) > k + 1:  # one place may hold the query's own row
                limit = np.minimum(limit, np.partition(near, k, axis=1)[:, k])
            line, col = np.nonzero(near - 1e-10 * size <= limit[:, None])
            if not len(line):
                return
            row = rows[col]
            d = np.sqrt(((q[act[line]] - self.vectors[row]) ** 2).sum(axis=1))
            same = (q[act[line]] == self.vectors[row]).all(axis=1)
            counts = np.minimum(self.first[row + 1] - self.first[row], k + 1)
            pair = np.repeat(np.arange(len(row)), counts)
            new_id = self.ids[ranges(self.first[row], counts)]
            who = act[line[pair]]
            other = ~(same[pair] & (new_id == own[who])) & (d[pair] <= bound[who])
            pair, new_id, who = pair[other], new_id[other], who[other]
            if not len(who):
                return
            mine = np.unique(who)
            all_q = np.concatenate((np.repeat(mine, k), who))
            all_d = np.concatenate((best[mine].reshape(-1), d[pair]))
            all_i = np.concatenate((ids[mine].reshape(-1), new_id))
            all_p = np.concatenate((places[mine].reshape(-1), row[pair]))
            order = np.lexsort((all_i, all_d, all_q))
            start = np.searchsorted(all_q[order], mine)
            take = order[start[:, None] + np.arange(k)]
            best[mine], ids[mine], places[mine] = all_d[take], all_i[take], all_p[take]

        def visit(node: int, act: np.ndarray) -> None:
            what = self.nodes[node]
            if isinstance(what, np.ndarray):
                if len(what):
                    offer(act, what)
                return
            vp, near, far = what
            d = distances(q[act], self.vectors[vp : vp + 1])[:, 0]
            offer(act, np.array([vp]))
            close = d <= (near[1] + far[0]) / 2
            for first, mine in ((near, close), (far, ~close)):
                other = far if first is near else near
                for lo, hi, child in (first, other):
                    part, e = act[mine], d[mine]
                    apart = np.maximum(np.maximum(lo - e, e - hi), 0)
                    go = part[apart <= factor * np.minimum(best[part, k - 1], bound[part]) * (1 + 1e-12) + 1e-300]
                    if len(go):
                        visit(child, go)

        if m and len(self.vectors):
            visit(self.root, np.arange(m))
        return ids, places, best


def usable(v: Column) -> Column:
    """Neither null nor empty nor zero, and without null or non-finite components."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf)))
    return v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.coalesce(F.exists(v, lambda x: x != 0), F.lit(False))


def _rows(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).cast("array<double>").alias("v"))
    return rows.where(F.col("id").isNotNull() & usable(F.col("v")))


def build(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index: dim, shard, tree (one row for each shard)."""
    ship(vectors.sparkSession)
    rows = _rows(vectors, id_col, vector_col)
    shards = max(1, math.ceil(rows.count() / shard_rows))
    rows = rows.dropDuplicates(["id", "v"]).select("id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("id", "v"), F.lit(shards)).alias("shard"))

    def grown(pdf: pd.DataFrame) -> pd.DataFrame:
        tree = Tree(pdf["id"].to_numpy(np.int64), np.stack(pdf["v"].to_numpy()))
        return pd.DataFrame({"dim": pdf["dim"][:1], "shard": pdf["shard"][:1], "tree": [pickle.dumps(tree, 5)]})

    return rows.groupBy("dim", "shard").applyInPandas(grown, "dim int, shard long, tree binary")


def search(index: DataFrame, queries: DataFrame, k: int = 10, factor: float = 1.0, id_col: str = "vec_id", vector_col: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k nearest in the index, ties to the smaller id."""
    ship(index.sparkSession)
    rows = _rows(queries, id_col, vector_col).groupBy("id").agg(F.min("v").alias("v"))
    blocks = max(1, math.ceil(queries.count() / block_rows))
    rows = rows.select("id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(blocks)).alias("block"))
    shards = index.select("dim", "shard")
    home = rows.select("dim", "block").distinct().join(shards, "dim").groupBy("dim", "block").agg(F.min_by("shard", F.xxhash64("block", "shard")).alias("home"))
    packed = lambda df: df.groupBy("dim", "block").agg(F.collect_list(F.struct("id", "v", "bound")).alias("queries")).join(home, ["dim", "block"])
    first = written(_asked(index, packed(rows.withColumn("bound", F.lit(math.inf))).withColumnRenamed("home", "shard"), k, factor), "nearest-at-home")
    bounds = first.groupBy(F.col("query_id").alias("id")).agg(F.max("score").alias("bound"), F.count("*").alias("n")).where(F.col("n") == k).drop("n")
    bounded = rows.join(bounds.hint("merge"), "id", "left").withColumn("bound", F.coalesce("bound", F.lit(math.inf)))
    rest = _asked(index, packed(bounded).join(shards, "dim").where("shard <> home"), k, factor)
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return first.unionByName(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _asked(index: DataFrame, blocks: DataFrame, k: int, factor: float) -> DataFrame:
    """query_id, vec_id, score: what each block's queries find in the one shard it is addressed to."""
    blocks = blocks.select("dim", "shard", F.lit(1).alias("kind"), F.lit(None).cast("binary").alias("tree"), "queries")
    trees = index.select("dim", "shard", F.lit(0).alias("kind"), "tree", F.lit(None).cast(blocks.schema["queries"].dataType).alias("queries"))

    def run(batches):
        tree = None
        for batch in batches:
            for i in range(batch.num_rows):
                if batch.column(2)[i].as_py() == 0:
                    tree = pickle.loads(batch.column(3)[i].as_py())
                    continue
                block = batch.column(4)[i].as_py()
                own = np.array([x["id"] for x in block], dtype=np.int64)
                q = np.array([x["v"] for x in block])
                ids, places, best = tree.search(own, q, k, factor, np.array([x["bound"] for x in block]))
                line, col = np.nonzero(~np.isinf(best))
                yield pa.RecordBatch.from_arrays([pa.array(own[line]), pa.array(ids[line, col]), pa.array(exact(q[line], tree.vectors[places[line, col]]))], names=["query_id", "vec_id", "score"])

    return trees.unionByName(blocks).repartition("dim", "shard").sortWithinPartitions("dim", "shard", "kind").mapInArrow(run, "query_id long, vec_id long, score double")


def report(vectors: DataFrame, every: int = 100, k: int = 10, factor: float = 1.0, id_col: str = "vec_id", vector_col: str = "embedding", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The rows whose id is divisible by `every` against all rows, through a written index."""
    index = written(build(vectors, id_col, vector_col, shard_rows), "vantage-points")
    return search(index, vectors.where(F.col(id_col) % every == 0), k, factor, id_col, vector_col)
