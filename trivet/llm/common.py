"""What the operators of this folder share: words, let-binding, hashes, components; cuts come from trivet.storage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trivet.operators.graph import solve
from trivet.storage import cut, free, new_path

__all__ = ["SPACE", "WORD", "components", "count_words", "cut", "free", "hash60", "let", "new_path"]

#: A word is a run of anything but the six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once, however often body names it."""
    return F.transform(F.array(value), body)[0]


def hash60(value: Column) -> Column:
    """The first 60 bits of MD5 as a long: uniform, and the same in other engines."""
    return F.conv(F.substring(F.md5(value), 1, 15), 16, 10).cast("long")


def count_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _solved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held = [b for b in batches if b.num_rows]
    if held:
        t = pa.Table.from_batches(held)
        lo, hi = t.column("lo").to_numpy(), t.column("hi").to_numpy()
        _, ids, comp = solve(np.zeros(len(lo), np.int64), lo, hi)
        yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(comp)], names=["id", "component"])


def components(edges: DataFrame, max_rounds: int = 60, local_links: int = 200_000) -> DataFrame:
    """Connected components of links (a long, b long): rows (id, component), the smallest id reachable.

    Up to local_links links (counted first; some 3 MB) are solved within one task. Beyond, alternating
    large-star and small-star steps: each round hangs the neighbours of every node on the
    smallest id seen, until only stars are left. No round puts a component into one task; minima are
    aggregated map-side and the joins are on single nodes. Nodes without a link are not returned;
    links to itself and nulls are ignored; an empty input gives an empty result.
    """
    e = cut(edges.select(F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi")).where("lo < hi").distinct(), "links")
    if e.count() <= local_links:
        out = cut(e.coalesce(1).mapInArrow(_solved, "id long, component long"), "components")
        free(e)
        return out
    mark = None
    for _ in range(max_rounds):
        both = e.select(F.col("lo").alias("u"), F.col("hi").alias("v")).unionByName(e.select(F.col("hi").alias("u"), F.col("lo").alias("v")))
        least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("m").alias("lo"), F.col("v").alias("hi")).where("lo < hi").distinct()
        low = large.groupBy("hi").agg(F.min("lo").alias("m"))
        star = large.join(low, "hi")
        old, e = e, cut(
            star.select(F.col("m").alias("lo"), "hi").unionByName(star.select(F.col("m").alias("lo"), F.col("lo").alias("hi"))).where("lo < hi").distinct(),
            "links",
        )
        free(old)
        now = tuple(e.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first())
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return e.select(F.col("hi").alias("id"), F.col("lo").alias("component")).unionByName(
        e.select(F.col("lo").alias("id"), F.col("lo").alias("component")).distinct()
    )
