"""Connected components of a graph given as edges, by alternating stars, for graphs of any size."""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import _arrow_schema, checkpointed, mapped

#: Parts into which the neighbours of one node are dealt when they meet the node's minimum.
SALTS = 16
#: Parts into which `thinned` deals nodes at least, edges of one of its tiles, about, and nodes that a task holds at a time.
PARTS, TILE, HELD = 4, 1 << 18, 1 << 20


def thinned(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Edges a, b that connect the same nodes as `edges`, each node at most once for each tile that it is in, however many edges it has.

    Nodes are dealt into parts by a hash and each pair of parts is a tile, whose edges one task joins: there each node keeps one edge, to the
    least node that it reaches. So of a dense graph's edges PARTS a node are left, or some more parts where there are many edges. A task that
    has met HELD nodes gives their edges and begins anew.
    """
    kind = edges.schema[a].dataType.simpleString()
    fields = edges.sparkSession.createDataFrame([], f"a {kind}, b {kind}").schema
    arrow = _arrow_schema(fields)
    parts = max(PARTS, math.ceil(math.sqrt(2 * edges.count() / TILE)))
    part = lambda c: F.pmod(F.xxhash64(c), F.lit(parts))

    def join(batches):
        parent: dict = {}

        def root(x):
            while (up := parent[x]) != x:
                parent[x] = x = parent[up]
            return x

        def left():
            joined = [(x, r) for x in parent if (r := root(x)) != x]
            return pa.RecordBatch.from_arrays([pa.array([e[i] for e in joined], f.type) for i, f in enumerate(arrow)], schema=arrow)

        for batch in batches:
            for x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                parent.setdefault(x, x)
                parent.setdefault(y, y)
                one, two = root(x), root(y)
                if one < two:
                    parent[two] = one
                elif two < one:
                    parent[one] = two
            if len(parent) > HELD:
                yield left()
                parent.clear()
        yield left()

    met = edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(F.col(a).alias("a"), F.col(b).alias("b"))
    return mapped(met.repartition(F.least(part("a"), part("b")), F.greatest(part("a"), part("b"))), join, fields)


def _with_least(edges: DataFrame, least: DataFrame) -> DataFrame:
    """edges (u, v) with m, the least of u; a node with many edges is dealt to SALTS tasks."""
    salted = edges.withColumn("_s", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int"))
    copies = least.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, ["u", "_s"]).select("u", "v", "m")


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node and root, the least node that it is connected to, for each node of an edge that isn't a root.

    Large stars link each greater neighbour to the least; small stars link each lesser one. Edges are aggregated per
    partition first, each round ends in a checkpoint, and the rounds end when the edges stay the same. Loops, repeated
    and null edges have no effect.
    """
    u, v = F.greatest(a, b), F.least(a, b)
    now = checkpointed(edges.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).select(u.alias("u"), v.alias("v")).filter("u != v").distinct())
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = _with_least(both, least).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        # u keeps its least neighbour; the other neighbours are linked to that one
        small = least.select("u", F.col("m").alias("v")).unionByName(
            _with_least(large, least).filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        )
        now = checkpointed(small.distinct())
        state = now.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = state
