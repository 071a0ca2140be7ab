"""Mixing sources to target weights by hash-threshold histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trivet.llm.common import count_words, cut, hash60

BITS, LEVELS = 12, 5  # 60 bits of hash, found 12 bits at a time
_MASK = (1 << 60) - 1


def targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: int) -> DataFrame:
    """Adds `target` to (source, source_size): weights by code-point order of source (null last), repeating.

    The budget is share * all sizes; no target exceeds cap * its source's size, and what that frees is
    shared again by weight. In the order of cap / weight that is one prefix sum: the level is the
    budget left over the weights left, at the first source that stays below its cap. The window has
    one row a source.
    """
    everything = Window.partitionBy(F.lit(1))
    ranked = sizes.withColumn("_r", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1)
    w = F.element_at(F.array(*[F.lit(int(x)) for x in weights]), (F.col("_r") % len(weights) + 1).cast("int")).cast("long")
    s = ranked.withColumn("_w", w).withColumn("_cap", F.col("source_size") * cap)
    by_ratio = everything.orderBy(F.col("_cap") / F.col("_w"), "_r")
    before = F.coalesce(F.sum("_cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("_w").over(by_ratio.rowsBetween(0, Window.unboundedFollowing))
    s = s.withColumn("_level", (F.sum("source_size").over(everything) * F.lit(float(share)) - before) / left)
    fits = F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.col("_level"))
    s = s.withColumn("_level", F.max(fits).over(everything))
    own = F.coalesce(F.least(F.col("_cap").cast("double"), F.col("_level") * F.col("_w")), F.col("_cap").cast("double"))
    return s.select("source", "source_size", own.alias("target"))


def _bucket(h: str, level: int) -> Column:
    return F.shiftright(h, 60 - BITS * level).bitwiseAND((1 << BITS) - 1)


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (3, 1, 2),
    share: float = 1.5,
    cap: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """How often the mix takes each document so that every source comes near its target in words.

    A source takes each document floor(target / size) times; the rest of the target is met by a
    threshold on a 60-bit hash of the id: tokens are summed by source and 12-bit hash bucket, the
    bucket where the running sum passes the budget is found, and only the rows of that boundary
    bucket are summed again by their next 12 bits, until one hash value is left. Should several rows
    have it (ids that repeat), they go on by a hash of the text, then of the row, until one is left. It
    joins the mix if that brings the source nearer its target. The thresholds of the copies are nested,
    no row is sorted, and each level after the first reads 1/4096 of the rows.

    Returns (doc_id, size, source_size, target, taken, source, copies) and the columns of carry.
    Null text has size 0, null source is a source of its own and comes last, a null id hashes as its
    text. Of rows that repeat id and text any may be the ones taken: reruns take as many. An empty table gives no row.
    Other columns of docs are ignored, so their names cannot clash.
    """
    d = docs.select(
        F.col(id_col).alias("doc_id"),
        count_words(F.col(text_col)).alias("size"),
        F.col(source_col).alias("source"),
        hash60(F.coalesce(F.col(id_col).cast("string"), F.md5(F.coalesce(F.col(text_col), F.lit(""))))).alias("h"),
        F.xxhash64(text_col).bitwiseAND(_MASK).alias("h2"),
        *[F.col(c).alias(f"_c_{c}") for c in carry],
    )
    d = cut(d.withColumn("_null", F.col("source").isNull()).withColumn("_src", F.coalesce("source", F.lit(""))).withColumn("h3", F.xxhash64(F.monotonically_increasing_id()).bitwiseAND(_MASK)), "mix-docs")
    sizes = d.groupBy("_null", "_src").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    plan = targets(sizes, weights, share, cap)
    copies = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    plan = plan.select(
        F.col("source").isNull().alias("_null"), F.coalesce("source", F.lit("")).alias("_src"), "source_size", "target", copies.cast("long").alias("full")
    )
    plan = cut(plan.withColumn("rest", F.col("target") - F.col("full") * F.col("source_size")), "mix-plan")

    # Of each source: the hash prefix of the boundary bucket, the budget still open below it.
    edge = plan.where("rest > 0").select("_null", "_src", F.lit(0).cast("long").alias("prefix"), F.col("rest").alias("open"))
    rows = d.where("size > 0").select("_null", "_src", "size", "h", "h2", "h3")
    key = Window.partitionBy("_null", "_src")
    bounds = []
    for h in ("h", "h2", "h3"):
        for level in range(1, LEVELS + 1):
            at = F.shiftright(h, 60 - BITS * (level - 1)).alias("prefix")
            here = rows if level == 1 else rows.withColumn("prefix", at).join(edge.select("_null", "_src", "prefix"), ["_null", "_src", "prefix"]).drop("prefix")
            if level == 2:
                here = rows = cut(here, "mix-edge")
            tall = here.groupBy("_null", "_src", _bucket(h, level).alias("b")).agg(F.sum("size").alias("n"), F.count("*").alias("k"))
            run = tall.withColumn("upto", F.sum("n").over(key.orderBy("b"))).join(edge.select("_null", "_src", "prefix", "open"), ["_null", "_src"])
            run = run.where(F.col("upto") > F.col("open"))
            edge = run.groupBy("_null", "_src").agg(F.min(F.struct("b", "upto", "n", "open", "prefix", "k")).alias("x")).select(
                "_null",
                "_src",
                (F.shiftleft("x.prefix", BITS) + F.col("x.b")).alias("prefix"),
                (F.col("x.open") - (F.col("x.upto") - F.col("x.n"))).alias("open"),
                F.col("x.n").alias("n"),
                F.col("x.k").alias("k"),
            )
            edge = cut(edge, "mix-level")
        # A bucket is one hash value now; a value of one row is taken if half of it or more is still open.
        bound = (F.col("prefix") + F.when((F.col("k") == 1) & (F.col("n") <= 2 * F.col("open")), 1).otherwise(0)).alias(f"bound_{h}")
        bounds.append(edge.select("_null", "_src", bound))
        if h == "h3" or not edge.where("k > 1").limit(1).count():
            break
        rows = rows.withColumn("prefix", F.col(h)).join(edge.where("k > 1").select("_null", "_src", "prefix"), ["_null", "_src", "prefix"]).drop("prefix")
        edge = edge.where("k > 1").select("_null", "_src", F.lit(0).cast("long").alias("prefix"), "open")
    for more in bounds:
        plan = plan.join(more, ["_null", "_src"], "left")
    plan = plan.drop("rest")

    salts = 16  # so that a source with a third of the rows is dealt to many tasks
    plan = plan.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    d = d.withColumn("_salt", (F.col("h") % salts).cast("int"))
    below = F.lit(False)
    for h in [c.removeprefix("bound_") for c in reversed(plan.columns) if c.startswith("bound_")]:
        own, most = F.col(h), F.col(f"bound_{h}")
        below = (own < most) | ((own == most) & below)
    n = F.col("full") + F.when(below, 1).otherwise(0)
    return d.join(plan, ["_null", "_src", "_salt"]).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * n).alias("taken"), "source", n.alias("copies"), *[F.col(f"_c_{c}").alias(c) for c in carry]
    )
