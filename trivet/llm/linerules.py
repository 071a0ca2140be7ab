"""Quality rules: base statistics and cross-document line frequency."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trivet.llm.common import SPACE, WORD, cut, let

SYMBOLS = "#*$%&|<>"
#: Upper case and digits of a line are levelled before it is counted.
LEVEL_FROM, LEVEL_TO = "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000"


def normal_line(line: Column) -> Column:
    """Lower ASCII, digits as 0, white space trimmed and as single spaces."""
    return F.translate(F.trim(F.regexp_replace(line, r"[\x20\x09-\x0D]+", " ")), LEVEL_FROM, LEVEL_TO)


def repeated_words(words: Column, width: int = 5) -> Column:
    """How many words lie in windows of `width` words that occur twice or more in the array.

    Windows are compared by 64-bit hashes; only if two are equal are they sorted, the positions of
    equal neighbours taken, and the words that these windows cover counted, overlaps once.
    """
    windows = let(words, lambda w: F.when(F.size(w) >= width, F.transform(F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(width)]))).otherwise(F.array().cast("array<bigint>")))

    def covered(h: Column) -> Column:
        order = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        both = let(order, lambda o: F.flatten(F.zip_with(F.slice(o, 1, F.size(o) - 1), F.slice(o, 2, F.size(o) - 1), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], b["i"])).otherwise(F.array().cast("array<int>")))))
        start = F.array_sort(F.array_distinct(both))
        return let(start, lambda p: F.aggregate(F.zip_with(F.slice(p, 1, F.size(p) - 1), F.slice(p, 2, F.size(p) - 1), lambda a, b: F.least(b - a, F.lit(width))), F.lit(width), lambda s, x: s + x))

    return let(windows, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h)))


def line_rules(
    docs: DataFrame,
    min_words: int = 10,
    max_repeat_pct: int = 20,
    min_docs: int = 50,
    max_doc_pct: float = 1.0,
    min_left_pct: int = 30,
    id_col: str = "doc_id",
    text_col: str = "text",
    host_col: str = "source",
) -> DataFrame:
    """Base statistics of each text, then the verdict of cross-document line frequency.

    Lines are normalised and hashed, and the distinct documents of a host that hold a line are
    counted. A line in more than min_docs documents and more than max_doc_pct percent of its host's
    documents is removed everywhere in the host; a document that keeps less than min_left_pct
    percent of its words is rejected, as is one that fails the base rules (fewer than min_words
    words, or more than max_repeat_pct percent of its words in repeated 5-word windows).

    Returns a row for each input row: doc_id, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, kept, n_left. Null text has no word; a null host is a host of its
    own; rows with one doc_id count once for a line, null ids together as one. Counts are combined
    map-side, so one line in all documents of a host is no hot key. Other columns are ignored.
    """
    t = F.coalesce(F.col(text_col), F.lit(""))
    words = F.regexp_extract_all(t, F.lit(WORD), F.lit(0))
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
    counted = F.transform(lines, lambda x: F.struct(F.xxhash64(normal_line(x)).alias("h"), F.regexp_count(x, F.lit(WORD)).alias("w")))
    base = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.concat(F.lit("="), F.col(host_col)), F.lit("")).alias("_host"),
        F.regexp_count(t, F.lit(WORD)).cast("long").alias("n_words"),
        F.length(F.translate(t, SPACE, "")).cast("long").alias("word_chars"),
        (F.length(t) - F.length(F.translate(t, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        let(lines, lambda a: F.size(a) - F.size(F.array_distinct(a))).cast("long").alias("n_dup_lines"),
        repeated_words(words).cast("long").alias("n_repeat_words"),
        counted.alias("_lines"),
    )
    base = cut(base, "line-rules")

    each = base.select("_row", "doc_id", "_host", F.explode("_lines").alias("l")).select("_row", "doc_id", "_host", "l.h", "l.w")
    hosts = base.select("_host", "doc_id").distinct().groupBy("_host").agg(F.count("*").alias("_docs"))
    often = each.select("_host", "h", "doc_id").distinct().groupBy("_host", "h").agg(F.count("*").alias("_n")).where(F.col("_n") > min_docs)
    often = often.join(hosts, "_host").where(F.col("_n") * 100 > F.col("_docs") * max_doc_pct).select("_host", "h")
    salts = 16
    often = often.withColumn("_s", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    lost = each.withColumn("_s", F.pmod("_row", F.lit(salts)).cast("int")).join(often, ["_host", "h", "_s"]).groupBy("_row").agg(F.sum("w").alias("_lost"))
    n = F.col("n_words")
    failed = (n < min_words) | (F.col("n_repeat_words") * 100 > n * max_repeat_pct)
    left = n - F.coalesce("_lost", F.lit(0))
    return base.drop("_lines").join(lost, "_row", "left").select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & (left * 100 >= n * min_left_pct)).alias("kept"), left.alias("n_left"),
    )
