"""Connected components of an edge table by alternating star steps."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges (u, v) with u > v.

    Large: every larger neighbour of a node is linked to the node's least neighbour.
    Small: the node and its lesser neighbours are linked to the least of them.
    The least neighbour is a plain aggregate, combined before the shuffle, so a
    node with very many neighbours costs its own task no more than its rows' joins,
    which adaptive execution splits.
    """
    if large:
        both = edges.select("u", "v").unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        both = edges.select("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).withColumnRenamed("u", "node")
    joined = both.join(least, F.col("u") == F.col("node"))
    if large:
        out = joined.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select(F.col("node").alias("u"), F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges of a task, replaced by one from every node to the least node it is tied to within the task."""
    up: dict = {}

    def top(x):
        while up.setdefault(x, x) != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    kind = None
    for batch in batches:
        kind = batch.column("u").type
        for u, v in zip(batch.column("u").to_pylist(), batch.column("v").to_pylist()):
            a, b = top(u), top(v)
            if a != b:
                up[max(a, b)] = min(a, b)
    if up:
        nodes = [(x, top(x)) for x in up]
        nodes = [(x, y) for x, y in nodes if x != y]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in nodes], kind), pa.array([y for _, y in nodes], kind)], ["u", "v"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): every node with an edge, but for the roots, and the least node reachable from it.

    Tasks first contract the edges they hold, which takes away most of the
    length of paths.  Null ends and loops are left out.  Each round is written to the shared
    folder, and rounds end when one changes nothing; their number grows with
    the logarithm of the longest path.
    """
    plain = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).filter("a <> b")
    kind = dict(plain.dtypes)["a"]
    once = plain.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    held = materialize(once.mapInArrow(contract, f"u {kind}, v {kind}"), "edges")

    def state(e: DataFrame):
        return e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = state(held)
    while True:
        held = materialize(_star(_star(held, True), False), "edges")
        now = state(held)
        if now == before:
            return held.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now
