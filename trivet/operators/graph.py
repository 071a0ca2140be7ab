"""Connected components of many graphs at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trivet.storage import cut


def solve(graph: np.ndarray, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Components of many small graphs in memory: an edge of each node, the node, its smallest reachable node."""
    g, ids = np.concatenate([graph, graph]), np.concatenate([a, b])
    order = np.lexsort((ids, g))
    new = np.concatenate([[True], (g[order][1:] != g[order][:-1]) | (ids[order][1:] != ids[order][:-1])])
    node = np.empty(len(g), np.int64)
    node[order] = np.cumsum(new) - 1
    first = order[new]
    u, v = node[: len(a)], node[len(a) :]
    label = np.arange(len(first))
    while True:
        x, y = label[u], label[v]
        if (x == y).all():
            return first % len(a), ids[first], ids[first][label]
        low = np.minimum(x, y)
        np.minimum.at(label, x, low)
        np.minimum.at(label, y, low)
        while (label[label] != label).any():
            label = label[label]


def _local(edges: DataFrame, key: str) -> DataFrame:
    """Graphs that fit in a task: one shuffle by graph, then `solve` on about a million edges at a time."""
    spark = edges.sparkSession
    e = edges.withColumn("_h", F.xxhash64(key))
    e = e.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "_h").sortWithinPartitions("_h")

    def answer(t: pa.Table) -> pa.RecordBatch:
        at, ids, comp = solve(*(t.column(c).to_numpy() for c in ("_h", "a", "b")))
        keys = t.column(key).combine_chunks().take(pa.array(at))
        return pa.RecordBatch.from_arrays([keys, pa.array(ids), pa.array(comp)], names=[key, "id", "component"])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            h = b.column(b.schema.get_field_index("_h")).to_numpy()
            # The rows of the last graph of this batch may go on in the next.
            last = int(np.searchsorted(h, h[-1]))
            if last and sum(x.num_rows for x in held) + last > 1_000_000:
                yield answer(pa.Table.from_batches([*held, b.slice(0, last)]))
                held = [b.slice(last)]
            else:
                held.append(b)
        if held:
            yield answer(pa.Table.from_batches(held))

    schema = edges.select(key, F.lit(0).cast("long").alias("id"), F.lit(0).cast("long").alias("component")).schema
    return e.select(key, "_h", "a", "b").mapInArrow(work, schema)


def components(edges: DataFrame, key: str, max_rounds: int = 60, local_edges: int = 200_000) -> DataFrame:
    """Connected components of undirected edges (key, a, b): rows (key, id, component), component the smallest id.

    If no graph has more than local_edges edges (counted first), each is solved within a task. Else
    alternating large-star and small-star rounds work on all graphs together; a round is two aggregates
    and two joins on single nodes, so a graph of any size spreads over the cluster, and rounds are
    cut by tables in the shared folder. Nodes without an edge to another node are not returned.
    """
    edges = cut(edges.select(key, "a", "b").where("a <> b"), "graph")
    if (edges.groupBy(key).count().agg(F.max("count")).first()[0] or 0) <= local_edges:
        return _local(edges, key)
    e = cut(edges.select(key, F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).distinct(), "graph")
    mark = None
    for _ in range(max_rounds):
        both = e.select(key, F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(e.select(key, F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy(key, "u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, [key, "u"]).where("v > u").select(key, F.col("m").alias("lo"), F.col("v").alias("hi")).where("lo < hi").distinct()
        low = large.groupBy(key, "hi").agg(F.min("lo").alias("m"))
        star = large.join(low, [key, "hi"])
        e = cut(
            star.select(key, F.col("m").alias("lo"), "hi").unionByName(star.select(key, F.col("m").alias("lo"), F.col("lo").alias("hi"))).where("lo < hi").distinct(),
            "graph",
        )
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64(key, "lo", "hi").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(key, F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(
        e.select(key, F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    )
