"""Line dedup by content-defined chunks of lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trivet.llm.common import WORD, cut, let

#: The multiplier of the rolling hash, a prime.
ROLL = 1_000_003


def line_hash(line: Column) -> Column:
    """32 bits of MD5."""
    return F.conv(F.substring(F.md5(line), 1, 8), 16, 10).cast("long")


def chunk_spans(lines: Column, window: int, divisor: int) -> Column:
    """The chunks of an array of lines: array of (first line, number of lines), in order.

    A chunk ends after line i if the rolling hash of lines i-window+1..i is divisible by divisor, so
    whether a boundary is there depends on the lines before it alone, wherever they stand.
    """

    def spans(h: Column) -> Column:
        n = F.size(h)

        def rolled(i: Column) -> Column:
            r = F.lit(0).cast("long")
            for back in range(window - 1, -1, -1):
                r = (r * ROLL + F.get(h, i - back)) % (1 << 31)
            return r

        ends = F.filter(F.sequence(F.lit(0), n - 1), lambda i: (i == n - 1) | ((i >= window - 1) & (rolled(i) % divisor == 0)))
        return let(
            ends,
            lambda e: F.zip_with(
                F.concat(F.array(F.lit(0)), F.transform(F.slice(e, 1, F.size(e) - 1), lambda x: x + 1)),
                e,
                lambda a, b: F.struct(a.alias("first"), (b - a + 1).alias("n")),
            ),
        )

    return let(F.transform(lines, line_hash), spans)


def dedup_lines(
    docs: DataFrame,
    window: int = 2,
    divisor: int = 2,
    min_lines: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Removes chunks of min_lines lines or more that stand earlier in the corpus, whole and byte for byte.

    Chunks are cut by a rolling hash over line hashes (`chunk_spans`), so a passage is cut alike
    behind any other text. Chunk hashes alone are counted first; the texts of those that occur twice
    are then grouped by their bytes, and of each group the first chunk stays: the one of the smallest
    doc_id (null last), then text hash, then line. Chunks without a word are never removed.

    Chunks have no least length: about half of them are a single line, and those of fewer than
    min_lines lines always stay, so a repeated passage is removed in part only. This is what the SQL
    of `op5_line_dedup` says; `dedup_runs` removes repeated passages whole.

    Returns (doc_id, text, n_lines, n_removed) and the columns of carry, a row for each input row;
    text is null only where it was. Rows that share both doc_id and text are one document and get the
    same result. Very common chunks: counts are combined map-side and joins are on chunk hashes,
    whose hot keys are salted. Other columns of docs are ignored.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"_c_{c}") for c in carry])
    lines = F.split("text", "\n", -1)
    keyed = own.withColumn("_t", F.xxhash64("text")).withColumn("_i", F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    # The key of a document: its id (nulls apart from the empty string by _n) and its text's hash.
    keyed = keyed.withColumn("_n", F.col("doc_id").isNull())
    key = ["_n", "_i", "_t"]

    hashed = F.filter(
        let(lines, lambda a: F.transform(chunk_spans(a, window, divisor), lambda s: F.struct(s["first"].alias("first"), s["n"].alias("n"), F.xxhash64(F.slice(a, s["first"] + 1, s["n"])).alias("h")))),
        lambda s: s["n"] >= min_lines,
    )
    chunks = keyed.where("text is not null").select(*key, F.explode(hashed).alias("c")).select(*key, "c.*").distinct()
    chunks = cut(chunks, "chunks")
    twice = chunks.groupBy("h").agg(F.count("*").alias("_k")).where("_k > 1")
    salts = 16
    spread = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_s")
    again = chunks.withColumn("_s", F.pmod("_t", F.lit(salts)).cast("int")).join(twice.select("h", "_k", spread), ["h", "_s"])
    # Texts of a common chunk are dealt to one task for each thousand occurrences.
    again = again.groupBy(*key).agg(F.collect_list(F.struct("first", "n", "h", F.expr("_k div 1000").alias("k"))).alias("cs"))

    # The bytes of the chunks that may be repeated; a document's chunks are no more than its lines.
    part = keyed.join(again, key).withColumn("a", lines).select(*key, "doc_id", "a", F.explode("cs").alias("c")).select(
        *key, "doc_id", "c.first", "c.n", "c.h", "c.k", F.concat_ws("\n", F.slice("a", F.col("c.first") + 1, F.col("c.n"))).alias("bytes")
    )
    part = part.where(F.col("bytes").rlike(WORD))
    place = F.struct(F.col("_n").alias("n"), F.col("doc_id").alias("d"), F.col("_t").alias("t"), F.col("first").alias("f"))
    first = part.groupBy("h", "k", "bytes").agg(F.min(place).alias("keep"), F.count("*").alias("rows")).where("rows > 1")
    gone = (
        part.withColumn("_s", F.pmod("_t", F.col("k") + 1))
        .join(first.select("h", "bytes", "keep", F.explode(F.sequence(F.lit(0).cast("long"), F.col("k"))).alias("_s")), ["h", "bytes", "_s"])
        .where(~place.eqNullSafe(F.col("keep")))
        .groupBy(*key)
        .agg(F.collect_set(F.struct("first", "n")).alias("gone"))
    )
    out = keyed.join(gone, key, "left").withColumn("a", lines)
    drop = F.flatten(F.transform("gone", lambda g: F.sequence(g["first"], g["first"] + g["n"] - 1)))
    kept = let(drop, lambda dr: F.filter(F.col("a"), lambda x, i: ~F.array_contains(dr, i)))
    return out.select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.concat_ws("\n", kept)).alias("text"),
        F.coalesce(F.when(F.col("text").isNotNull(), F.size("a")), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.aggregate("gone", F.lit(0), lambda x, g: x + g["n"]), F.lit(0)).cast("long").alias("n_removed"),
        *[F.col(f"_c_{c}").alias(c) for c in carry],
    )


def dedup_runs(
    docs: DataFrame,
    min_lines: int = 2,
    id_col: str = "doc_id",
    text_col: str = "text",
    carry: tuple[str, ...] = (),
) -> DataFrame:
    """Removes every line of the passages of min_lines lines or more that stand earlier in the corpus.

    Every min_lines neighbouring lines are a window, compared by SHA-256 of its bytes. The first place
    of a window (the smallest doc_id, null last, then text hash, then line) stays, and the lines of all
    its other places go. Windows overlap, so a repeated passage loses all its lines wherever it begins,
    and a copy of a text of min_lines lines or more loses everything. Of a line that goes there is an
    earlier one that stays, though perhaps with other neighbours. Runs of lines without a word stay.

    Returns (doc_id, text, n_lines, n_removed) and the columns of carry, a row for each input row;
    text is null only where it was. Rows that share both doc_id and text are one document and get the
    same result. Very common windows: places are combined map-side, and the join on windows is salted.
    Other columns of docs are ignored.
    """
    own = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *[F.col(c).alias(f"_c_{c}") for c in carry])
    lines = F.split("text", "\n", -1)
    keyed = own.withColumn("_t", F.xxhash64("text")).withColumn("_i", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).withColumn("_n", F.col("doc_id").isNull())
    key = ["_n", "_i", "_t"]

    def windows(a: Column) -> Column:
        digest = lambda i: F.unhex(F.sha2(F.concat_ws("\n", F.slice(a, i + 1, min_lines)), 256))
        each = F.transform(F.sequence(F.lit(0), F.size(a) - min_lines), lambda i: F.struct(i.alias("first"), digest(i).alias("h")))
        return F.when(F.size(a) >= min_lines, each)

    spots = keyed.where("text is not null").select(*key, "doc_id", F.explode(let(lines, windows)).alias("w")).select(*key, "doc_id", "w.*")
    spots = cut(spots, "windows")
    place = F.struct(F.col("_n").alias("n"), F.col("doc_id").alias("d"), F.col("_t").alias("t"), F.col("first").alias("f"))
    salts = 16
    spread = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_s")
    twice = spots.groupBy("h").agg(F.min(place).alias("keep"), F.count("*").alias("_k")).where("_k > 1").select("h", "keep", spread)
    gone = (
        spots.withColumn("_s", F.pmod("_t", F.lit(salts)).cast("int"))
        .join(twice, ["h", "_s"])
        .where(~place.eqNullSafe(F.col("keep")))
        .groupBy(*key)
        .agg(F.collect_set("first").alias("gone"))
    )

    def with_words(a: Column, at: Column) -> Column:
        """The positions at (in order) of those runs of neighbours that hold a word."""
        runs = F.transform(at, lambda x, i: F.struct(x.alias("x"), (x - i).alias("run")))
        return let(
            runs,
            lambda r: let(
                F.array_distinct(F.transform(F.filter(r, lambda s: F.get(a, s["x"]).rlike(WORD)), lambda s: s["run"])),
                lambda good: F.transform(F.filter(r, lambda s: F.array_contains(good, s["run"])), lambda s: s["x"]),
            ),
        )

    covered = F.array_sort(F.array_distinct(F.flatten(F.transform("gone", lambda g: F.sequence(g, g + min_lines - 1)))))
    out = keyed.join(gone, key, "left").withColumn("a", lines).withColumn("gone", F.when(F.col("gone").isNotNull(), let(covered, lambda at: with_words(F.col("a"), at))))
    kept = let(F.col("gone"), lambda dr: F.filter(F.col("a"), lambda x, i: ~F.array_contains(dr, i)))
    return out.select(
        "doc_id",
        F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.concat_ws("\n", kept)).alias("text"),
        F.coalesce(F.when(F.col("text").isNotNull(), F.size("a")), F.lit(0)).cast("long").alias("n_lines"),
        F.when(F.col("gone").isNull(), 0).otherwise(F.size("gone")).cast("long").alias("n_removed"),
        *[F.col(f"_c_{c}").alias(c) for c in carry],
    )
