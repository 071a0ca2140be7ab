"""URL filters: dated lists as validity intervals, joined as of the fetch time."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trivet.llm.common import let

HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#@]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^?#]*)"


def host_of(url: Column) -> Column:
    """The host in lower case without a trailing dot; an empty string where there is none."""
    return F.coalesce(F.regexp_replace(F.lower(F.regexp_extract(url, HOST, 1)), r"\.+$", ""), F.lit(""))


def url_keys(url: Column) -> Column:
    """What a list may name to catch the URL: its host, the domains above, and host/directory prefixes."""

    def of_host(h: Column) -> Column:
        labels = F.split(h, r"\.")
        domains = let(labels, lambda a: F.transform(F.sequence(F.lit(1), F.size(a)), lambda i: F.array_join(F.slice(a, i, F.size(a) - i + 1), ".")))
        parts = F.filter(F.split(F.regexp_extract(url, PATH, 1), "/"), lambda x: x != "")
        paths = let(
            parts,
            lambda p: F.when(F.size(p) == 0, F.array().cast("array<string>")).otherwise(
                F.transform(F.sequence(F.lit(1), F.size(p)), lambda i: F.concat(h, F.lit("/"), F.array_join(F.slice(p, F.lit(1), i), "/")))
            ),
        )
        return F.array_distinct(F.concat(domains, paths))

    host = host_of(url)
    return F.when(host == "", F.array().cast("array<string>")).otherwise(let(host, of_host))


def intervals(entries: DataFrame) -> DataFrame:
    """Validity intervals of list entries (key, category, op, day): rows (key, category, start, stop).

    An add opens an interval unless one is open, a remove closes it from that day on; stop is null
    while it is open. On one day removals come before additions. Repeated entries, a removal of what
    is not listed, and rows with a null key, day or unknown op change nothing; null is a category.
    """
    e = entries.where("key is not null and day is not null and op in ('add', 'remove')")
    e = e.select("key", "category", "day", F.when(F.col("op") == "add", 1).otherwise(0).alias("on")).distinct()
    w = Window.partitionBy("key", "category").orderBy("day", "on")
    turns = e.withColumn("was", F.coalesce(F.lag("on").over(w), F.lit(0))).where(F.col("on") != F.col("was"))
    return turns.withColumn("stop", F.lead("day").over(w)).where("on = 1").select("key", "category", F.col("day").alias("start"), "stop")


def filter_urls(
    captures: DataFrame,
    entries: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    time_col: str = "fetch_day",
) -> DataFrame:
    """Evaluates each capture against the list entries that were active when it was fetched.

    A capture asks for its host, the domains above it and its directory prefixes; each of these keys
    is looked up in the list, whose intervals are one array a key, and an interval counts if
    start <= fetch time < stop. Returns a row for each capture: page_id, fetch_day, n_active,
    categories (distinct, sorted, comma-separated; null counts as `unknown`), since (the latest start
    among the active), blocked.

    A null URL or one without a host asks for nothing; with a null fetch time nothing is active.
    A host with very many captures is dealt by salt; list rows go to every salt. Other columns are
    ignored, repeated captures are evaluated each on its own.
    """
    salts = 16
    c = captures.select(
        F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("page_id"), F.col(time_col).alias("fetch_day"), url_keys(F.col(url_col)).alias("keys")
    )
    asked = c.select("row", "page_id", "fetch_day", F.explode_outer("keys").alias("key")).withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(salts)).cast("int"))
    spans = intervals(entries).groupBy("key").agg(F.collect_list(F.struct("category", "start", "stop")).alias("spans"))
    spans = spans.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    met = asked.join(spans, ["key", "salt"], "left")
    t = F.col("fetch_day")
    active = F.filter("spans", lambda s: (s["start"] <= t) & (s["stop"].isNull() | (t < s["stop"])))
    met = met.withColumn("active", F.coalesce(active, F.array().cast(met.schema["spans"].dataType)))
    out = met.groupBy("row", "page_id", "fetch_day").agg(F.flatten(F.collect_list("active")).alias("a"))
    return out.select(
        "page_id",
        "fetch_day",
        F.size("a").cast("long").alias("n_active"),
        F.array_join(F.array_sort(F.array_distinct(F.transform("a", lambda s: F.coalesce(s["category"], F.lit("unknown"))))), ",").alias("categories"),
        F.array_max(F.transform("a", lambda s: s["start"])).alias("since"),
        (F.size("a") > 0).alias("blocked"),
    )
