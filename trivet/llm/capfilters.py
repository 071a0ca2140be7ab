"""Embedding near-dedup by spherical-cap filters."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trivet.llm.common import components, cut, free

MODULUS = 4096  # filter ids are told apart by the vectors' length modulo this


class CapCode:
    """One random product code: filter directions are all concatenations of one codeword a block.

    The space is rotated at random and split into blocks; each block has `words` random unit vectors.
    A vector's score with a direction is the sum of its scores with the codewords, so all directions
    above the threshold are listed block by block, dropping a partial sum as soon as the best
    codewords of the blocks to come cannot lift it over.
    """

    def __init__(self, dim: int, words: int, per_vector: float, seed: int, blocks: int = 3, least: int = 10):
        self.least = least
        rng = np.random.default_rng((seed, dim, words))
        self.blocks = min(blocks, dim)
        self.rotation = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        self.parts = np.array_split(np.arange(dim), self.blocks)
        self.words = [c / np.linalg.norm(c, axis=1, keepdims=True) for c in (rng.standard_normal((words, len(p))) for p in self.parts)]
        probe = rng.standard_normal((64, dim))
        scores = [self.scores(v) for v in probe / np.linalg.norm(probe, axis=1, keepdims=True)]
        low, high = 0.0, float(self.blocks)
        for _ in range(13):  # the threshold at which random vectors pass per_vector filters on average
            self.threshold = (low + high) / 2
            if sum(self.count(s) for s in scores) > per_vector * len(probe):
                low = self.threshold
            else:
                high = self.threshold

    def scores(self, v: np.ndarray) -> list[np.ndarray]:
        y = v @ self.rotation
        return [w @ y[p] for w, p in zip(self.words, self.parts, strict=True)]

    def count(self, scores: list[np.ndarray]) -> int:
        """How many directions pass; over a million counts as a million."""
        return len(self._list(scores, 1_000_000)[0])

    def _list(self, scores: list[np.ndarray], most: int | None = None, threshold: float | None = None) -> tuple[np.ndarray, np.ndarray]:
        threshold = self.threshold if threshold is None else threshold
        total, ids = np.zeros(1), np.zeros(1, np.int64)
        best = np.array([s.max() for s in scores])
        for b, s in enumerate(scores):
            order = np.argsort(-s)
            falling = -s[order]
            n = np.searchsorted(falling, total + best[b + 1 :].sum() - threshold, side="right")
            if most is not None and n.sum() > most:
                return np.zeros(most), np.zeros(most, np.int64)
            at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            total = np.repeat(total, n) - falling[at]
            ids = np.repeat(ids, n) * len(s) + order[at]
        return total, ids

    def filters(self, v: np.ndarray) -> np.ndarray:
        """The directions that v exceeds, by number; its `least` best ones where it exceeds fewer."""
        scores = self.scores(v)
        total, ids = self._list(scores)
        low, floor = self.threshold, min(self.least, int(np.prod([float(len(w)) for w in self.words])))
        while len(ids) < floor:
            low -= 0.04 + 0.05 * abs(low)
            total, ids = self._list(scores, threshold=low)
        if low < self.threshold and len(ids) > floor:
            ids = ids[np.argsort(-total, kind="stable")[:floor]]
        return ids


_codes: dict[tuple, CapCode] = {}


def cap_code(dim: int, words: int, per_vector: float, seed: int) -> CapCode:
    key = (dim, words, per_vector, seed)
    if key not in _codes:
        _codes[key] = CapCode(dim, words, per_vector, seed)
    return _codes[key]


def _matrix(column: pa.Array, unit: bool = True) -> list[np.ndarray]:
    out = []
    for x in column:
        v = np.asarray(x.values.to_numpy(zero_copy_only=False), np.float64)
        v = v / np.abs(v).max() if unit else v
        out.append(v / np.linalg.norm(v))
    return out


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """The rows of each key (the first `keys` columns) of a sorted partition, one key in memory at a time."""
    held: list[pa.RecordBatch] = []
    last = None
    for b in batches:
        if not b.num_rows:
            continue
        k = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(np.int64) for i in range(keys)], axis=1)
        starts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1).tolist(), len(k)]
        for a, e in zip(starts[:-1], starts[1:], strict=True):
            now = tuple(k[a].tolist())
            if held and now != last:
                yield pa.Table.from_batches(held)
                held = []
            last = now
            held.append(b.slice(a, e - a))
    if held:
        yield pa.Table.from_batches(held)


def _blocks(df: DataFrame, key: str, size: str, block: int) -> DataFrame:
    """Deals the rows of a large key to blocks, and each row to the pairs of blocks that hold its own.

    A key of up to `block` rows is one task's matter; beyond, each pair of its blocks is.
    """
    many = F.greatest(F.lit(1), F.ceil(F.col(size) / block)).cast("int")
    own = F.pmod(F.xxhash64("cid"), many).cast("int")
    df = df.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), many - 1)))
    return df.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other")).select(key, "i", "j", "own", "cid", "mult", "v")


def cap_links(
    vectors: DataFrame,
    threshold: float = 0.9,
    tables: int = 6,
    per_table: float = 12.0,
    crowd: float = 0.25,
    block: int = 1024,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """Near-duplicate vectors by cosine: (vec_id, n_links, component_id, kept), a row for each input row.

    Equal vectors are one class. Each class is list-decoded to the filters that it exceeds in `tables`
    random product codes, about per_table in each and its ten best at least; the codes grow with the number of classes so that a
    filter holds `crowd` unrelated vectors on average at any size. Classes that share a filter are
    compared in double precision and the links of a filter leave it as a forest, so its output is
    linear in its rows. Links lie within components; n_links then counts, in each component, the
    pairs with cosine >= threshold, copies included. Filters and components of more than `block`
    rows are dealt to tasks by pairs of blocks. A link is missed only if its two vectors share no
    filter and nothing else connects them; tests hold the recall against brute force.

    A row for each input row, none for an empty table; other columns are ignored, whatever their names.
    Vectors that are null, empty, zero or hold null or non-finite components link with nothing: they
    are their own component. Vectors of different lengths never link. Rows with equal ids are
    separate vectors; a null id is no component id unless all ids of the component are null.
    """
    own = vectors.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    sound = F.col("v").isNotNull() & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists("v", lambda x: x != 0)
    own = cut(own.withColumn("v", F.when(F.coalesce(sound, F.lit(False)), F.col("v"))), "vectors")
    classes = own.where("v is not null").groupBy("v").agg(F.count("*").alias("mult")).select(F.monotonically_increasing_id().alias("cid"), "mult", "v")
    classes = cut(classes, "classes")
    n = max(2, classes.count())
    words = max(8, round((per_table * n / crowd) ** (1 / 3)))

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for a in range(0, whole.num_rows, 500):
                b = whole.slice(a, 500)
                cids, keys = [], []
                for cid, v in zip(b.column(0).to_pylist(), _matrix(b.column(1)), strict=True):
                    for t in range(tables):
                        f = cap_code(len(v), words, per_table, t).filters(v)
                        keys.append((f * tables + t) * MODULUS + len(v) % MODULUS)
                        cids.append(np.full(len(f), cid))
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys)), pa.array(np.concatenate(cids))], names=["f", "cid"])

    hits = cut(classes.select("cid", "v").mapInArrow(decode, "f long, cid long"), "filters")
    crowded = hits.groupBy("f").agg(F.count("*").alias("k")).where("k > 1")
    met = hits.join(crowded, "f").join(classes, "cid")
    parts = max(1, int(own.sparkSession.conf.get("spark.sql.shuffle.partitions")))

    def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, 3):
            cid, vs = t.column("cid").to_numpy(), _matrix(t.column("v").combine_chunks())
            for d in {len(v) for v in vs}:
                at = np.array([i for i, v in enumerate(vs) if len(v) == d])
                x = np.stack([vs[i] for i in at])
                left = np.ones(len(at), bool)
                a, b = [], []
                for i in range(len(at)):
                    if not left[i]:
                        continue
                    left[i] = False
                    front = np.array([i])
                    while len(front):
                        near = left & (x[front] @ x.T >= threshold).any(axis=0)
                        front = np.flatnonzero(near)
                        left[front] = False
                        a += [cid[at[i]]] * len(front)
                        b += cid[at[front]].tolist()
                if a:
                    yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    dealt = _blocks(met, "f", "k", block).repartition(parts, "f", "i", "j").sortWithinPartitions("f", "i", "j")
    comp = components(dealt.mapInArrow(forest, "a long, b long"))
    size = comp.groupBy("component").agg(F.count("*").alias("k"))
    inside = comp.join(size, "component").join(classes, comp["id"] == classes["cid"]).drop("id")

    def tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in runs(batches, 3):
            cid, mult, mine = t.column("cid").to_numpy(), t.column("mult").to_numpy(), t.column("own").to_numpy()
            x = np.stack(_matrix(t.column("v").combine_chunks()))
            i, j = t.column("i")[0].as_py(), t.column("j")[0].as_py()
            for p, q in {(i, j), (j, i)}:
                rows, cols = np.flatnonzero(mine == p), np.flatnonzero(mine == q)
                near = x[rows] @ x[cols].T >= threshold
                near &= cid[rows][:, None] != cid[cols]
                yield pa.RecordBatch.from_arrays([pa.array(cid[rows]), pa.array(near @ mult[cols], pa.int64())], names=["cid", "links"])

    dealt = _blocks(inside, "component", "k", block).repartition(parts, "component", "i", "j").sortWithinPartitions("component", "i", "j")
    links = dealt.mapInArrow(tally, "cid long, links long").groupBy("cid").agg(F.sum("links").alias("links"))
    known = classes.join(links, "cid", "left").join(comp.withColumnRenamed("id", "cid"), "cid", "left")
    known = known.select("v", (F.coalesce("links", F.lit(0)) + F.col("mult") - 1).alias("n_links"), F.coalesce("component", "cid").alias("c"))
    # Rows of one vector meet their class; Spark splits the rows of a very common vector or component.
    rows = cut(own.join(known, "v", "left").select("row", "vec_id", "n_links", "c"), "vector-rows")
    least = rows.where("c is not null").groupBy("c").agg(F.min("vec_id").alias("component_id"))
    out = rows.join(least, "c", "left")
    free(own, classes, hits)
    comp_id = F.when(F.col("c").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        comp_id.alias("component_id"),
        F.col("vec_id").eqNullSafe(comp_id).alias("kept"),
    )
