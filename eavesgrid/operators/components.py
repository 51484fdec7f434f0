"""Connected components by alternating large-star and small-star rounds (Kiveris et al., 2014).

The edge table is checkpointed after each round.  Nodes that own a large part of all edges are salted: their
minimum comes from a partial aggregate, and their edges are spread over several tasks for the join with it.

Before the rounds each task makes stars of the components among the edges it holds, ``CHUNK`` at a time.  Few edges are
settled by that alone, and edges that were dealt by place keep few links from task to task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut, ship_package

HOT_SHARE = 1_000  # a node is hot with more than 1/1000 of all edges, so fewer than 2000 nodes can be hot
HOT_MINIMUM = 100_000
EDGES_PER_TASK = 200_000
CHUNK = 400_000  # edges that one task looks at together


def _oriented(edges: DataFrame) -> DataFrame:
    """Distinct edges from the larger to the smaller node, without loops."""
    return (
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )


def _stars(edges: pa.Table) -> pa.RecordBatch:
    """Every node of the edges but the smallest of its component, with that smallest one."""
    n = len(edges)
    ends = pa.chunked_array(edges["u"].chunks + edges["v"].chunks).combine_chunks().dictionary_encode()
    order = pc.sort_indices(ends.dictionary).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    code = rank[ends.indices.to_numpy()]
    u, v, low = code[:n], code[n:], np.arange(len(order))
    while True:
        a, b = low[u], low[v]
        apart = a != b
        if not apart.any():
            break
        u, v, a, b = u[apart], v[apart], a[apart], b[apart]
        np.minimum.at(low, np.maximum(a, b), np.minimum(a, b))
        while (low[low] != low).any():
            low = low[low]
    moved = np.flatnonzero(low != np.arange(len(order)))
    nodes = ends.dictionary.take(pa.array(order))
    return pa.RecordBatch.from_arrays([nodes.take(pa.array(moved)), nodes.take(pa.array(low[moved]))], ["u", "v"])


def contracted(edges: DataFrame) -> DataFrame:
    """``u, v``: stars with the same components as the edges, made of up to ``CHUNK`` edges of a task at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(batch)
            rows += batch.num_rows
            if rows >= CHUNK:
                star = _stars(pa.Table.from_batches(held))
                held, rows = [star] if star.num_rows < CHUNK // 2 else [], star.num_rows
                if not held:
                    yield star
                    rows = 0
        if held:
            yield _stars(pa.Table.from_batches(held))

    ship_package(edges.sparkSession)
    pairs = edges.select("u", "v")
    return pairs.mapInArrow(run, pairs.schema)


def _tasks(n_edges: int) -> int:
    """Rounds over few edges are spread over few tasks, whatever the number of shuffle partitions is."""
    return 1 + n_edges // EDGES_PER_TASK


def _progress(edges: DataFrame) -> tuple[int, int]:
    """Number of edges, and of nodes that keep them from forming separate stars."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("hub")).unionByName(
        edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("hub"))
    )
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("hub").alias("hub"))
    loose = (F.col("up") > 1) | ((F.col("up") > 0) & (F.col("hub") > 0))
    row = nodes.agg(F.sum("up"), F.sum(loose.cast("int"))).first()
    return int(row[0] or 0), int(row[1] or 0)


def _with_minimum(directed: DataFrame, n_edges: int, hot_minimum: int) -> DataFrame:
    """``u, v, m``: every directed edge with the smallest node of u's neighbourhood, u included."""
    limit = max(hot_minimum, n_edges // HOT_SHARE)
    if n_edges <= limit:  # no node can be hot: one shuffle, and groups fit a task
        return directed.withColumn("m", F.least("u", F.min("v").over(Window.partitionBy("u"))))
    minima = directed.groupBy("u").agg(F.min("v").alias("nv"), F.count(F.lit(1)).alias("n"))
    minima = minima.select("u", F.least("u", "nv").alias("m"), F.greatest(F.ceil(F.col("n") / limit), F.lit(1)).alias("salts"))
    # There are at most 2 * n_edges directed edges, hence fewer than 2 * HOT_SHARE rows in this table.
    hot = minima.where(F.col("salts") > 1).select("u", "salts")
    spread = directed.join(F.broadcast(hot), "u", "left").withColumn(
        "salt", F.pmod(F.xxhash64("v"), F.coalesce("salts", F.lit(1)))
    )
    minima = minima.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)))
    return spread.drop("salts").join(minima.drop("salts"), ["u", "salt"]).select("u", "v", "m")


def connected_components(
    edges: DataFrame, src: str = "id_a", dst: str = "id_b", hot_minimum: int = HOT_MINIMUM
) -> DataFrame:
    """``id, component`` for every node of an edge; the component is named by its smallest id."""
    current = cut(_oriented(edges.select(F.col(src).alias("u"), F.col(dst).alias("v"))))
    n_edges, loose = _progress(current)
    if loose:
        current = cut(contracted(current.coalesce(_tasks(n_edges))).distinct())
        n_edges, loose = _progress(current)
    current = current.coalesce(_tasks(n_edges))
    while loose:  # each round shortens every path to a minimum, so this ends after about log2 of the longest one
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_minimum(both, n_edges, hot_minimum)
        large = large.where((F.col("v") > F.col("u")) & (F.col("v") != F.col("m"))).select(
            F.col("v").alias("u"), F.col("m").alias("v")
        )
        small = _with_minimum(large, n_edges, hot_minimum)
        # The neighbours and the node itself all point to the minimum.
        small = small.select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
        current = cut(_oriented(small).coalesce(_tasks(n_edges)))
        n_edges, loose = _progress(current)
    roots = current.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()
    return current.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(roots)
