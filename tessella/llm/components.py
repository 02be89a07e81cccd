"""Connected components of a link table: each partition unites its own links, then large-star and small-star steps.

The same plan at every size: partitions grow in number, not in size. Where all links lie in one partition the first step has
finished and one round of stars confirms it.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tessella.storage import written

#: Links that a partition unites: what bounds a task's memory, some 100 MB.
UNITED = 250_000


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step: neighbours on one side of each node hang themselves on the least node around it.

    The least nodes are a written table, so that the join with a hub's many neighbours can be split by adaptive execution.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v"))
    both = both.unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    if not large:
        both = both.where("v < u")
    least = written(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least-nodes")
    hung = both.join(least, "u")
    if large:
        hung = hung.where("v > u").select(F.col("v").alias("b"), F.col("m").alias("a"))
    else:
        hung = hung.select(F.col("v").alias("b"), F.col("m").alias("a")).unionByName(least.select(F.col("u").alias("b"), F.col("m").alias("a")))
    return hung.where("a < b").distinct().select("a", "b")


def _united(batches):
    """The links of one partition as links of each node to the least it is connected with (a: least, b: node)."""
    parent: dict = {}

    def find(x):
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    kind = None
    for batch in batches:
        kind = batch.column(0).type
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            x, y = find(parent.setdefault(a, a)), find(parent.setdefault(b, b))
            if x != y:
                parent[max(x, y)] = min(x, y)
    nodes = [n for n in parent if find(n) != n]
    if nodes:
        yield pa.RecordBatch.from_arrays([pa.array([find(n) for n in nodes], kind), pa.array(nodes, kind)], names=["a", "b"])


def components(links: DataFrame, name: str = "components", most: int = 60, united: int = UNITED) -> DataFrame:
    """node, label: the least node of the component, for every node that has a link. links: a, b (any orderable type).

    Each round is written to the shared folder, so that a lost executor costs one round. Rounds grow with the
    logarithm of the component's size; the steps never gather a node's neighbours in one place.
    """
    edges = links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    kind = edges.schema["a"].dataType
    edges = written(edges, name)
    edges = written(edges.coalesce(max(1, math.ceil(edges.count() / united))).mapInArrow(_united, T.StructType([T.StructField("a", kind), T.StructField("b", kind)])), name)
    state = _state(edges)
    for _ in range(most):
        edges = written(_star(_star(edges, True), False), name)
        before, state = state, _state(edges)
        if before == state:
            break
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("b").alias("node"), F.col("a").alias("label")).unionByName(edges.select(F.col("a").alias("node"), F.col("a").alias("label"))).distinct()


def _state(edges: DataFrame) -> tuple:
    """Number and sum of hashes of the links: equal before and after a round that changed nothing."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
