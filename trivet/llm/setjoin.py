"""N-gram Jaccard join over count vectors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trivet.llm.common import components, cut, free

GROUPS = 64  # coordinates of the coarsest count vector
NEAR = 16  # members of a bucket up to which its pairs leave it at once; larger ones go to the tree
LEAF = 256  # points of a leaf
CHUNK = 1_000_000  # keys that a task combines at a time

_P1, _P2, _P3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))
#: The low bits of a key say where it comes from: the parity of a size class, or a single shingle.
_TAG, _LONE, _ALL = np.uint64(3), 2, (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _P2
    x = (x ^ (x >> np.uint64(29))) * _P3
    return x ^ (x >> np.uint64(32))


class _Words(dict):
    """64-bit hashes of words, kept for frequent words of up to 32 bytes."""

    def __missing__(self, w: bytes) -> int:
        h = xxhash.xxh64_intdigest(w)
        if len(w) <= 32:
            if len(self) > 200_000:
                self.clear()
            self[w] = h
        return h


_words = _Words()


def shingles(text: str | None, k: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles of the whole text, A-Z in lower case.

    With fewer than k words the whole sequence is one shingle; without a word there is none.
    """
    words = (text or "").encode("utf-8", "replace").lower().split()
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    w = np.fromiter(map(_words.__getitem__, words), np.uint64, n)
    width = min(k, n)
    h = np.full(n - width + 1, np.uint64(width), np.uint64)
    for j in range(width):
        h = _mix(h * _P1 + w[j : n - width + 1 + j])
    return np.unique(h)


def _size_class(n: int, num: int, den: int) -> tuple[int, int, int]:
    """The class of set size n: its number, lower and upper bound.

    A class is wide enough that linked sets lie in one class or in neighbours.
    """
    k, low = 0, 1
    while True:
        high = low * den**3 // num**3
        if n <= high:
            return k, low, high
        k, low = k + 1, high + 1


def _differ(n: int, num: int, den: int) -> int:
    """In how many shingles at most a set of size n and one that it links with differ, both sides counted."""
    return (den - num) * (n + n * den // num) // (den + num)


def _levels(n: int, num: int, den: int) -> list[tuple[int, int, int]]:
    """The size classes in which a set of size n may meet another: number, blocks and spare blocks."""
    k, _, high = _size_class(n, num, den)
    highs = [(k, high)]
    if n * den // num > high:  # it may link with sets of the next class
        highs.append((k + 1, (high + 1) * den**3 // num**3))
    out = []
    for k, high in highs:
        most = _differ(high, num, den)
        spare = 3 + most // 16
        out.append((k, most + most // 7 + 2 * spare + 4, spare))
    return out


def _keys(h: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys of a set, and for each how many keys of its kind the set has in common with any set it links with.

    The range of hashes is cut into the blocks of a size class, finer than any count vector; a key is
    the content of a block. Linked sets A and B differ in D shingles at most, so in D blocks at most.
    Of the first D + 1 + spare blocks that are filled in either, spare + 1 at least are equal and
    filled in both, and each set emits them: it emits its first D + 1 + spare filled blocks, D for the
    largest partner that it may have. If fewer blocks are filled in either, then so in both sets;
    such a set also emits the single shingles of its prefix, of which two linked sets share one.
    """
    n = len(h)
    most = _differ(n, num, den)
    if not n or not most:  # it only links with equal sets
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, needs, short = [], [], False
    for k, blocks, spare in _levels(n, num, den):
        at = ((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
        starts = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
        emitted = min(len(starts), most + 1 + spare)
        upto = int(starts[emitted]) if emitted < len(starts) else n
        sums = np.add.reduceat(_mix(h[:upto] + _P1), starts[:emitted])
        key = _mix(sums * _P2 + (at[starts[:emitted]] + np.uint64(1)) * _P3 + np.uint64((k + 1) * int(_P1) & _ALL))
        keys.append((key & ~_TAG) | np.uint64(k & 1))
        few = emitted < most + 1 + spare
        short |= few
        needs.append(np.full(emitted, 1 if few else spare + 1))
    if short:
        keys.append((_mix(h[: n + (-n * num // den) + 1] + _P3) & ~_TAG) | np.uint64(_LONE))
        needs.append(np.zeros(len(keys[-1]), np.int64))
    return np.concatenate(keys).view(np.int64), np.concatenate(needs).astype(np.int64)


def sub_vectors(h: np.ndarray, num: int, den: int) -> np.ndarray:
    """Keys of which two linked sets share one at least (`_keys`)."""
    return _keys(h, num, den)[0]


def least_shared(h: np.ndarray, num: int, den: int) -> int:
    """How many keys at least a set has in common with any other set that links with it."""
    return max(1, int(_keys(h, num, den)[1].min(initial=1 << 40) if len(h) else 1)) if _differ(len(h), num, den) else 1


def _class_id(h: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(h.tobytes()) - (1 << 63)


def fine_counts(h: np.ndarray) -> bytes:
    """A count vector with about two shingles a coordinate, a byte each; twice the coordinates while a count is over 255."""
    groups = GROUPS
    while True:
        if groups * 2 >= len(h):
            c = np.bincount((h & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
            if c.max(initial=0) < 256:
                return c.astype(np.uint8).tobytes()
        groups *= 2


def _folded(v: np.ndarray, groups: int) -> np.ndarray:
    """A count vector at coarser coordinates."""
    return v.reshape(-1, groups).sum(axis=0, dtype=np.int32)


def overlap_bound(a: bytes, b: bytes) -> int:
    """The sum of coordinate minima, at the coarser vector's coordinates."""
    x, y = sorted((np.frombuffer(v, np.uint8) for v in (a, b)), key=len)
    return int(np.minimum(x, _folded(y, len(x))).sum())


def _slices(batches: Iterator[pa.RecordBatch], most: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Slices of batches (text last) of about `most` bytes, one row at least."""
    for b in batches:
        upto = np.cumsum(pc.fill_null(pc.binary_length(b.column(b.num_columns - 1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < b.num_rows:
            end = max(start + 1, int(np.searchsorted(upto, (upto[start - 1] if start else 0) + most, side="right")))
            yield b.slice(start, end - start)
            start = end


def _long_batch(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns.values()], names=list(columns))


def _whole_runs(batches: Iterator[pa.RecordBatch], least: int = 100_000) -> Iterator[list[np.ndarray]]:
    """The long columns of a sorted partition, cut where the first one changes, about `least` rows at a time."""
    held: list[list[np.ndarray]] = []
    rows = 0
    for b in batches:
        held.append([b.column(i).to_numpy(zero_copy_only=False) for i in range(b.num_columns)])
        rows += b.num_rows
        if rows >= least:
            cols = [np.concatenate(x) for x in zip(*held, strict=True)]
            end = int(np.searchsorted(cols[0], cols[0][-1]))
            if end:
                yield [x[:end] for x in cols]
            held, rows = [[x[end:] for x in cols]], rows - end
    if rows:
        yield [np.concatenate(x) for x in zip(*held, strict=True)]


def _starts(*columns: np.ndarray) -> np.ndarray:
    """Where the columns, sorted, take new values."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(new)


def _lengths(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(starts, n))


def _combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From sets (cid, keys, needs): rows (key, cid, meta) with one member of each key for its global bucket.

    meta is 4 * need + kind. Kind 0: the only member so far; kind 1: the first of several, so it has
    met others for certain; kind 2: the rest of these, which need no global bucket. A key that very
    many sets have thus sends one row a chunk to its bucket.
    """

    def combine(keys: list, cids: list, needs: list) -> pa.RecordBatch:
        key, cid, need = (np.concatenate(x) for x in (keys, cids, needs))
        order = np.lexsort((cid, key))
        key, cid, need = key[order], cid[order], need[order]
        starts = _starts(key)
        size = _lengths(starts, len(key))
        kind = np.full(len(key), 2)
        kind[starts] = size > 1
        return _long_batch(key=key, cid=cid, meta=need * 4 + kind)

    seen: set[int] = set()
    keys, cids, needs, rows = [], [], [], 0
    for b in batches:
        for c, k, m in zip(b.column(0).to_pylist(), b.column(1), b.column(2), strict=True):
            if c in seen:
                continue
            seen.add(c)
            keys.append(np.frombuffer(k.as_buffer(), np.int64))
            needs.append(np.frombuffer(m.as_buffer(), np.int32).astype(np.int64))
            cids.append(np.full(len(keys[-1]), c))
            rows += len(keys[-1])
            if rows >= CHUNK:
                yield combine(keys, cids, needs)
                keys, cids, needs, rows = [], [], [], 0
    if rows:
        yield combine(keys, cids, needs)


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows (key, cid, meta) of `_combined`, sorted: (key, cid, need) of the members of buckets with several."""
    for key, cid, meta in _whole_runs(batches):
        starts = _starts(key, cid)
        kind = meta & 3
        sure, bucket = np.maximum.reduceat(kind, starts) > 0, np.minimum.reduceat(kind, starts) < 2
        key, cid, need = key[starts], cid[starts], meta[starts] >> 2
        runs = _starts(key)
        several = np.repeat(np.add.reduceat(bucket.astype(np.int64), runs) > 1, _lengths(runs, len(key)))
        out = sure | (bucket & several)
        yield _long_batch(key=key[out], cid=cid[out], need=need[out])


def _strong(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (cid, key, need) sorted: (key, cid, deg) without keys of a kind that meets too rarely for any link.

    deg is the number of keys that the set keeps.
    """
    for cid, key, need in _whole_runs(batches):
        starts = _starts(cid, key)
        cid, key, need = cid[starts], key[starts], need[starts]
        runs = _starts(cid)
        size = _lengths(runs, len(cid))
        keep = need == 0
        for parity in (0, 1):
            mine = (key & 3) == parity
            keep |= mine & (np.repeat(np.add.reduceat(mine.astype(np.int64), runs), size) >= need)
        deg = np.repeat(np.add.reduceat(keep.astype(np.int64), runs), size)
        yield _long_batch(key=key[keep], cid=cid[keep], deg=deg[keep])


def _near_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From (key, cid, comp) sorted, small buckets: the pairs of a bucket that lie in different components."""
    for key, cid, comp in _whole_runs(batches):
        for step in range(1, min(NEAR, len(key))):
            ok = (key[step:] == key[:-step]) & (comp[step:] != comp[:-step])
            if not ok.any():
                continue
            x, y = cid[:-step][ok], cid[step:][ok]
            yield _long_batch(a=np.minimum(x, y), b=np.maximum(x, y))


def jaccard_components(
    docs: DataFrame,
    words: int = 4,
    num: int = 85,
    den: int = 100,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Groups of documents whose shingle sets link: den * intersection >= num * union, chains included.

    Sets are points: shingle hashes fall into groups and the group counts are coordinates. A box over
    unrelated sets of one size holds nearly any query, so the top of the tree is cut exactly instead:
    sets meet in buckets of equal contents of narrow blocks of coordinates, several of which linked
    sets share (`_keys`). Equal sets are one class from the start, and a task sends one row of a key to
    its bucket, whatever the size of the group.

    1. Classes that share too few buckets with others for any link go.
    2. Each class verifies the bucket centre with which it shares most buckets. A centre is the member
       of most buckets, so an original rather than one of its edited copies.
    3. Buckets whose members are all in one component are done. Of the others, small ones (up to 16)
       give the pairs in different components; crowded ones that share a component form a cluster,
       whose points are packed into a tree by size, component and coordinates (`_tree_pairs`): pairs of leaves
       whose boxes cannot reach the overlap are skipped, pairs of points are bounded by the sum of
       coordinate minima: first only each point's best in a leaf, while that links an eighth of them, then all that are apart.

    All surviving pairs are verified on whole sets. No step emits all pairs of a group, and no link
    between different components is left out.

    Returns a row for each input row: doc_id, t (hash of the text), n_shingles, component_id (the
    smallest doc_id of the component, null only if all are), kept (the first row of its component).
    Null, empty and wordless texts have an empty set and link with nothing; rows with equal or null
    ids are documents of their own, and rows that repeat id and text are one class with a row each.
    An empty table gives an empty result. Other columns of docs are ignored, whatever their names.
    """
    spark = docs.sparkSession
    parts = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches):
            n, cid, digest, keys, needs = [], [], [], [], []
            for t in b.column(b.num_columns - 1).to_pylist():
                h = shingles(t, words)
                key, need = _keys(h, num, den)
                n.append(len(h))
                cid.append(_class_id(h) if len(h) else None)
                digest.append(xxhash.xxh128_intdigest(h.tobytes()) >> 64 if len(h) else None)
                keys.append(key.tobytes())
                needs.append(need.astype(np.int32).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(n, pa.int64()), pa.array(cid, pa.int64()), pa.array([d if d is None else d - (1 << 63) for d in digest], pa.int64()), pa.array(keys, pa.binary()), pa.array(needs, pa.binary())],
                names=["doc_id", "t", "n", "cid", "digest", "keys", "needs"],
            )

    id_type = own.schema["doc_id"].dataType.simpleString()
    sized = own.select("doc_id", F.xxhash64("text").alias("t"), "text").mapInArrow(sizes, f"doc_id {id_type}, t long, n long, cid long, digest long, keys binary, needs binary")
    sized = cut(sized.select(F.monotonically_increasing_id().alias("row"), "*"), "set-sizes")
    place = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"), F.col("row"))
    classes = sized.where("cid is not null").groupBy("cid").agg(F.min(place).alias("first"), F.min_by("t", place).alias("t"), (F.min("digest") != F.max("digest")).alias("clash"))
    classes = cut(classes, "set-classes")
    if classes.where("clash").limit(1).count():
        raise RuntimeError("two sets have one 64-bit class id")

    routed = sized.where(F.length("keys") > 0).select("cid", "keys", "needs").mapInArrow(_combined, "key long, cid long, meta long")
    # The rest of a combined key goes anywhere; the first of each chunk meets in the key's bucket.
    route = F.when(F.col("meta").bitwiseAND(3) == 2, F.xxhash64("key", "cid")).otherwise(F.col("key"))
    met = cut(routed.repartition(parts, route).sortWithinPartitions("key", "cid").mapInArrow(_met, "key long, cid long, need long"), "set-met")
    strong = cut(met.select("cid", "key", "need").repartition(parts, "cid").sortWithinPartitions("cid", "key").mapInArrow(_strong, "key long, cid long, deg long"), "set-strong")
    free(met)

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in _slices(batches, 500_000):
            hs = [shingles(t, words) for t in b.column(1).to_pylist()]
            keep = [i for i, (h, c) in enumerate(zip(hs, b.column(0).to_pylist(), strict=True)) if _class_id(h) == c]
            hs, fine = [hs[i] for i in keep], [fine_counts(hs[i]) for i in keep]
            tiles = [_folded(np.frombuffer(f, np.uint8), 8).astype(">u4").tobytes() for f in fine]
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(pa.array(keep, pa.int64())), pa.array([len(h) for h in hs], pa.int64()), pa.array(fine, pa.binary()), pa.array(tiles, pa.binary()), pa.array([h.view(np.int64) for h in hs], pa.list_(pa.int64()))],
                names=["cid", "n", "fine", "tile", "h"],
            )

    # The whole sets of the classes that meet another. Ids may repeat, so rows are found by id and text.
    s = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    rep = classes.join(strong.select("cid").distinct(), "cid", "left_semi").select(F.coalesce(F.col("first.id").cast("string"), F.lit("")).alias("s"), "t", "cid")
    sets = own.where("text is not null").withColumn("s", s).withColumn("t", F.xxhash64("text")).join(rep, ["s", "t"]).select("cid", "text")
    sets = sets.mapInArrow(whole, "cid long, n long, fine binary, tile binary, h array<long>")
    if sized.where("cid is not null").groupBy("cid", "doc_id").agg(F.count("*").alias("k")).where("k > 1").limit(1).count():
        sets = sets.dropDuplicates(["cid"])
    sets = cut(sets, "sets")

    def reach(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            na, nb = b.column(2).to_numpy(), b.column(3).to_numpy()
            top = np.array([overlap_bound(x.as_py(), y.as_py()) for x, y in zip(b.column(4), b.column(5), strict=True)], np.int64)
            yield b.select([0, 1]).take(pa.array(np.flatnonzero(top * (den + num) >= (na + nb) * num)))

    def linked(pairs: DataFrame) -> DataFrame:
        """Of distinct pairs (a, b), those that link: bounded by count vectors, then verified on whole sets."""
        p = pairs.join(sets.select(F.col("cid").alias("b"), F.col("n").alias("nb"), F.col("fine").alias("fb")), "b")
        p = p.join(sets.select(F.col("cid").alias("a"), F.col("n").alias("na"), F.col("fine").alias("fa")), "a").where(F.least("na", "nb") * den >= F.greatest("na", "nb") * num)
        near = cut(p.select("a", "b", "na", "nb", "fa", "fb").mapInArrow(reach, "a long, b long"), "set-close")
        p = near.join(sets.select(F.col("cid").alias("b"), F.col("h").alias("hb")), "b").join(sets.select(F.col("cid").alias("a"), F.col("h").alias("ha")), "a")
        both = F.size(F.array_intersect("ha", "hb")).cast("long")
        out = cut(p.where(both * den >= (F.size("ha") + F.size("hb") - both) * num).select("a", "b"), "set-links")
        free(near)
        return out

    # A bucket's centre is its member of most buckets.
    centres = strong.groupBy("key").agg(F.max_by("cid", F.struct("deg", "cid")).alias("a"))
    stars = strong.join(centres, "key").where("a <> cid").groupBy("cid", "a").agg(F.count("*").alias("shared"))
    best = stars.groupBy("cid").agg(F.max_by("a", F.struct("shared", "a")).alias("a")).select("a", F.col("cid").alias("b"))
    links = linked(best.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    comp = components(links)

    # Buckets that still hold several components.
    at = strong.select("key", "cid").join(comp.select(F.col("id").alias("cid"), "component"), "cid", "left").select("key", "cid", F.coalesce("component", "cid").alias("component"))
    kinds = at.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("k")).where("lo <> hi").drop("hi")
    at = cut(at.join(kinds, "key"), "set-mixed")
    small = at.where(F.col("k") <= NEAR).select("key", "cid", "component").repartition(parts, "key").sortWithinPartitions("key", "cid")
    pairs = small.mapInArrow(_near_pairs, "a long, b long").distinct()
    crowd = at.where(F.col("k") > NEAR).select("lo", "cid", "component").distinct()
    crowded = crowd.limit(1).count() > 0
    if crowded:
        cluster = components(crowd.select(F.col("lo").alias("a"), F.col("component").alias("b"))).select(F.col("id").alias("component"), F.col("component").alias("cluster"))
        points = crowd.select("cid", "component").distinct().join(cluster, "component").drop("component").join(sets.select("cid", "n", "fine", "tile"), "cid")
        points = cut(points, "set-points")

    best_only = crowded
    while True:
        was_all = not best_only
        if crowded:
            now = points.join(comp.select(F.col("id").alias("cid"), "component"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
            more = _tree_pairs(now, num, den, best_only)
            pairs = cut((pairs.unionByName(more) if pairs else more).distinct(), "set-pairs")
        found = linked(pairs)
        best_only = best_only and found.count() * 8 >= pairs.count()
        free(pairs)
        links = links.unionByName(found)
        comp = components(links)
        if was_all:
            break
        pairs = None
    free(at)

    known = classes.select("cid", "first").join(comp.withColumnRenamed("id", "cid"), "cid", "left").withColumn("component", F.coalesce("component", "cid"))
    known = cut(known.join(known.groupBy("component").agg(F.min("first").alias("least")), "component").select("cid", "least"), "set-known")
    free(strong, sets, classes)
    out = sized.select("row", "doc_id", "t", "n", "cid").join(known, "cid", "left")
    alone = F.col("least").isNull()
    return out.select(
        "doc_id",
        "t",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("least.id")).alias("component_id"),
        (alone | (F.col("least.row") == F.col("row"))).alias("kept"),
    )


def pack_leaves(leaf: int, num: int, den: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Packs sorted points (cluster, level, cid, component, n, fine) into leaves of up to `leaf`, each with its box."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = TaskContext.get().partitionId() << 32

        def emit(key: tuple[int, int], rows: list[tuple]) -> pa.RecordBatch:
            nonlocal made
            made += 1
            cid, comp, n, fine = zip(*rows, strict=True)
            box = np.max([_folded(np.frombuffer(f, np.uint8), GROUPS) for f in fine], axis=0)
            one = comp[0] if len(set(comp)) == 1 else None
            kinds = ("int64", "int32", "int64", "int64", "int64")
            head = [pa.array([x], getattr(pa, k)()) for x, k in zip((key[0], key[1], made, min(n), one), kinds, strict=True)]
            body = [pa.array([x], pa.list_(k)) for x, k in ((box, pa.int32()), (cid, pa.int64()), (comp, pa.int64()), (n, pa.int64()), (fine, pa.binary()))]
            return pa.RecordBatch.from_arrays([*head, *body], names=["cluster", "level", "leaf", "least", "one", "box", "cids", "comps", "ns", "fines"])

        at, held = None, []
        for b in batches:
            for cluster, level, *row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if held and ((cluster, level) != at or len(held) == leaf):
                    yield emit(at, held)
                    held = []
                at = (cluster, level)
                held.append(tuple(row))
        if held:
            yield emit(at, held)

    return pack


def _tree_pairs(points: DataFrame, num: int, den: int, best_only: bool, leaf: int | None = None, counted: list | None = None) -> DataFrame:
    """Pairs of points of one cluster in different components whose coordinate minima reach a link's overlap.

    points: cluster, cid, component, n, fine, tile. They are sorted by cluster, size level, component
    and coordinates and packed into leaves in that order. Pairs of leaves meet on boxes alone; those
    that are left carry their points once each. best_only: of each point's partners in a leaf only
    the best, else all. counted gets how many pairs of leaves there are, how
    many of them differ in component at near levels, and how many of these the boxes leave.
    """
    # Sizes of a link are within num/den, so leaves of far levels are not even paired.
    level = F.floor(F.log(F.col("n").cast("double")) / F.log(F.lit(den / num))).cast("int")
    p = points.withColumn("level", level).sort("cluster", "level", "component", "tile", "cid").select("cluster", "level", "cid", "component", "n", "fine")
    kinds = "cluster long, level int, leaf long, least long, one long, box array<int>, cids array<long>, comps array<long>, ns array<long>, fines array<binary>"
    leaves = cut(p.mapInArrow(pack_leaves(leaf or LEAF, num, den), kinds), "set-leaves")
    head = ("cluster", "level", "leaf", "least", "one", "box")
    x = leaves.select(*[F.col(c).alias(f"{c}_x") for c in head])
    y = leaves.select(*[F.col(c).alias(f"{c}_y") for c in head])
    top = F.aggregate(F.zip_with("box_x", "box_y", lambda u, v: F.least(u, v)), F.lit(0), lambda s, u: s + u)
    met = x.join(y, (F.col("cluster_x") == F.col("cluster_y")) & (F.col("leaf_x") <= F.col("leaf_y")))
    near = met.where((F.abs(F.col("level_x") - F.col("level_y")) <= 1) & ~F.coalesce(F.col("one_x") == F.col("one_y"), F.lit(False)))
    left = near.where(top * (den + num) >= (F.col("least_x") + F.col("least_y")) * num)
    if counted is not None:
        counted += [met.count(), near.count(), left.count()]
    body = ("leaf", "cids", "comps", "ns", "fines")
    left = left.select("leaf_x", "leaf_y").join(leaves.select(*[F.col(c).alias(f"{c}_x") for c in body]), "leaf_x").join(leaves.select(*[F.col(c).alias(f"{c}_y") for c in body]), "leaf_y")

    def points_of(b: pa.RecordBatch, i: int, side: str) -> tuple[np.ndarray, ...]:
        cid, comp, n = (np.asarray(b.column(f"{c}_{side}")[i].values) for c in ("cids", "comps", "ns"))
        return cid, comp, n, [np.frombuffer(f, np.uint8) for f in b.column(f"fines_{side}")[i].as_py()]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                (c1, g1, n1, f1), (c2, g2, n2, f2) = points_of(b, i, "x"), points_of(b, i, "y")
                groups = min(map(len, [*f1, *f2]))
                v1, v2 = (np.stack([_folded(f, groups) for f in fs]) for fs in (f1, f2))
                room = np.stack([np.minimum(v, v2).sum(axis=1) for v in v1]) * (den + num) - (n1[:, None] + n2) * num
                room[g1[:, None] == g2] = -1
                if best_only:  # the best partner of each point of either side
                    j, k = np.arange(len(c1)), np.arange(len(c2))
                    j, k = np.concatenate([j, room.argmax(axis=0)]), np.concatenate([room.argmax(axis=1), k])
                    j, k = j[room[j, k] >= 0], k[room[j, k] >= 0]
                else:
                    j, k = np.nonzero(room >= 0)
                yield _long_batch(a=np.minimum(c1[j], c2[k]), b=np.maximum(c1[j], c2[k]))

    return left.mapInArrow(meet, "a long, b long")
