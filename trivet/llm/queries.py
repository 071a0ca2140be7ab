"""The registered queries of this folder and, where SQL can say it, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trivet.llm.capfilters import cap_links
from trivet.llm.langid import identify
from trivet.llm.linededup import dedup_lines, dedup_runs
from trivet.llm.linerules import line_rules
from trivet.llm.common import hash60
from trivet.llm.mixing import mix
from trivet.llm.pieces import encode_pieces
from trivet.llm.quality import classify
from trivet.llm.setjoin import jaccard_components
from trivet.llm.urlfilter import filter_urls, host_of
from trivet.llm.warc import read_archives, write_archives


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(_read(spark, sf_dir, "documents"))


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify(_read(spark, sf_dir, "documents"))


def piece_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_pieces(_read(spark, sf_dir, "documents"), piece_model())


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """pages has neither fetch days nor lists, so both are made by rule from all its rows.

    A page is fetched on day page_id mod 730 from 2023-01-01. By the hash of its name a host is listed
    as spam for 90 days and again from day 240 after, or one of its directories as adult for good.
    """
    first = F.to_date(F.lit("2023-01-01"))
    pages = _read(spark, sf_dir, "pages").select("page_id", "url", F.date_add(first, (F.col("page_id") % 730).cast("int")).alias("fetch_day"))
    hosts = pages.select(host_of(F.col("url")).alias("host")).where("host <> ''").distinct().withColumn("v", hash60(F.col("host")))
    day = F.date_add(first, (F.shiftright("v", 8) % 500).cast("int"))
    turns = F.array(
        *[F.struct(F.lit(op).alias("op"), F.lit(after).alias("after")) for op, after in (("add", 0), ("remove", 90), ("add", 240))],
    )
    spam = hosts.where("v % 4 = 0").select(F.col("host").alias("key"), F.lit("spam").alias("category"), F.explode(turns).alias("x"), day.alias("d"))
    spam = spam.select("key", "category", "x.op", F.date_add("d", F.col("x.after")).alias("day"))
    lang = F.element_at(F.array(*[F.lit(x) for x in ("en", "fr", "de", "es")]), (F.shiftright("v", 4) % 4 + 1).cast("int"))
    adult = hosts.where("v % 4 in (0, 1)").select(F.concat("host", F.lit("/"), lang).alias("key"), F.lit("adult").alias("category"), F.lit("add").alias("op"), day.alias("day"))
    return filter_urls(pages, spam.unionByName(adult))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = dedup_lines(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


def op5_line_dedup_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated passages whole; `op5_line_dedup` is held to its SQL, which leaves one-line chunks."""
    out = dedup_runs(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.md5("text").alias("text_md5"))


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_rules(_read(spark, sf_dir, "documents"))


def op7_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_archives(spark, write_archives(_read(spark, sf_dir, "pages"))).drop("payload", "url")


def op9_cap_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_links(_read(spark, sf_dir, "embeddings"))


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(_read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix_sources": op1_mix_sources,
        "op2_language_id": op2_language_id,
        "op3_sentencepiece": op3_sentencepiece,
        "op4_url_filter": op4_url_filter,
        "op5_line_dedup": op5_line_dedup,
        "op5_line_dedup_runs": op5_line_dedup_runs,
        "op6_line_rules": op6_line_rules,
        "op7_quality_rank": op7_quality_rank,
        "op8_warc": op8_warc,
        "op9_cap_filters": op9_cap_filters,
        "op10_jaccard_join": op10_jaccard_join,
    }


_MIX = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15)) AS BIGINT) AS h
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
r AS (SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS r FROM s),
w AS (SELECT *, CASE r % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS w, source_size * 2 AS cap FROM r),
l AS (SELECT *, (CAST((SELECT sum(source_size) FROM s) AS DOUBLE) * 1.5
             - coalesce(sum(cap) OVER (ORDER BY cap / CAST(w AS DOUBLE), r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
             / sum(w) OVER (ORDER BY cap / CAST(w AS DOUBLE), r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev FROM w),
m AS (SELECT max(CASE WHEN lev * w <= cap THEN lev END) AS lev FROM l),
t AS (SELECT l.source, l.source_size, coalesce(least(CAST(l.cap AS DOUBLE), m.lev * l.w), CAST(l.cap AS DOUBLE)) AS target FROM l, m),
p AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS full_n FROM t),
q AS (SELECT d.*, p.source_size, p.target, p.full_n, p.target - p.full_n * p.source_size AS rest,
             CAST(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.h) AS BIGINT) AS upto,
             CAST(sum(d.size) OVER (PARTITION BY d.source, d.h) AS BIGINT) AS tied
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source),
c AS (SELECT *, CASE WHEN rest > 0 AND (upto <= rest OR (upto - tied <= rest AND tied <= 2 * (rest - (upto - tied)))) THEN 1 ELSE 0 END AS extra FROM q)
SELECT doc_id, size, source_size, target, CAST(size * (full_n + CASE WHEN size > 0 THEN extra ELSE 0 END) AS BIGINT) AS taken, source,
       CAST(full_n + extra AS BIGINT) AS copies
FROM c
"""

_URL_FILTER = r"""
WITH p AS (
  SELECT page_id, url, DATE '2023-01-01' + CAST(page_id % 730 AS INTEGER) AS fetch_day,
         lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/:?#@]+)', 1)) AS host,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*/([^?#]*)', 1), '/'), lambda x: x <> '') AS parts
  FROM pages),
h AS (SELECT DISTINCT host, CAST(('0x' || substr(md5(host), 1, 15)) AS BIGINT) AS v FROM p WHERE host <> ''),
l AS (SELECT host, v, DATE '2023-01-01' + CAST((v >> 8) % 500 AS INTEGER) AS d FROM h),
spans AS (
  SELECT host AS key, 'spam' AS category, d AS start, d + 90 AS stop FROM l WHERE v % 4 = 0
  UNION ALL SELECT host, 'spam', d + 240, NULL FROM l WHERE v % 4 = 0
  UNION ALL SELECT host || '/' || CASE (v >> 4) % 4 WHEN 0 THEN 'en' WHEN 1 THEN 'fr' WHEN 2 THEN 'de' ELSE 'es' END, 'adult', d, NULL FROM l WHERE v % 4 IN (0, 1)),
k AS (
  SELECT DISTINCT page_id, fetch_day, key FROM (
    SELECT page_id, fetch_day, unnest(list_transform(range(1, len(string_split(host, '.')) + 1), lambda i: array_to_string(string_split(host, '.')[i:], '.'))) AS key FROM p WHERE host <> ''
    UNION ALL
    SELECT page_id, fetch_day, unnest(list_transform(range(1, len(parts) + 1), lambda i: host || '/' || array_to_string(parts[1:i], '/'))) FROM p WHERE host <> '')),
a AS (SELECT page_id, category, start FROM k JOIN spans USING (key) WHERE start <= fetch_day AND (stop IS NULL OR fetch_day < stop)),
g AS (SELECT page_id, count(*) AS n, string_agg(DISTINCT category, ',' ORDER BY category) AS c, max(start) AS since FROM a GROUP BY page_id)
SELECT p.page_id, p.fetch_day, coalesce(g.n, 0) AS n_active, coalesce(g.c, '') AS categories, g.since, g.n IS NOT NULL AS blocked
FROM p LEFT JOIN g ON p.page_id = g.page_id
"""

_LINE_DEDUP = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i,
         len(string_split(text, chr(10))) AS n FROM documents WHERE text IS NOT NULL),
h AS (SELECT *, CAST(('0x' || substr(md5(line), 1, 8)) AS BIGINT) AS h FROM l),
b AS (SELECT *, CASE WHEN i >= 1 AND (((lag(h) OVER w) % 2147483648) * 1000003 + h) % 2147483648 % 2 = 0 THEN 1 ELSE 0 END AS cut
      FROM h WINDOW w AS (PARTITION BY doc_id ORDER BY i)),
k AS (SELECT *, coalesce(sum(cut) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS chunk FROM b),
c AS (SELECT doc_id, chunk, min(i) AS f, count(*) AS n, string_agg(line, chr(10) ORDER BY i) AS bytes FROM k GROUP BY doc_id, chunk),
g AS (SELECT *, row_number() OVER (PARTITION BY bytes ORDER BY doc_id, f) AS rn FROM c WHERE n >= 2 AND regexp_matches(bytes, '[^\x20\x09-\x0D]')),
x AS (SELECT doc_id, chunk FROM g WHERE rn > 1),
o AS (SELECT k.doc_id, count(*) AS n_lines, count(x.chunk) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE x.chunk IS NULL), '') AS t
      FROM k LEFT JOIN x USING (doc_id, chunk) GROUP BY k.doc_id)
SELECT d.doc_id, coalesce(o.n_lines, 0) AS n_lines, coalesce(o.n_removed, 0) AS n_removed, md5(o.t) AS text_md5
FROM documents d LEFT JOIN o ON d.doc_id = o.doc_id
"""

_LINE_RUNS = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS i FROM documents WHERE text IS NOT NULL),
w AS (SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY i) AS nx FROM l),
g AS (SELECT doc_id, i, row_number() OVER (PARTITION BY line || chr(10) || nx ORDER BY doc_id, i) AS rn FROM w WHERE nx IS NOT NULL),
x AS (SELECT doc_id, i FROM g WHERE rn > 1 UNION SELECT doc_id, i + 1 FROM g WHERE rn > 1),
y AS (SELECT doc_id, i, i - row_number() OVER (PARTITION BY doc_id ORDER BY i) AS run FROM x),
z AS (SELECT y.doc_id, y.i, bool_or(regexp_matches(line, '[^\x20\x09-\x0D]')) OVER (PARTITION BY y.doc_id, run) AS word FROM y JOIN l ON y.doc_id = l.doc_id AND y.i = l.i),
o AS (SELECT l.doc_id, count(*) AS n_lines, count(z.i) AS n_removed, coalesce(string_agg(line, chr(10) ORDER BY l.i) FILTER (WHERE z.i IS NULL), '') AS t
      FROM l LEFT JOIN z ON l.doc_id = z.doc_id AND l.i = z.i AND z.word GROUP BY l.doc_id)
SELECT d.doc_id, coalesce(o.n_lines, 0) AS n_lines, coalesce(o.n_removed, 0) AS n_removed, md5(o.t) AS text_md5
FROM documents d LEFT JOIN o ON d.doc_id = o.doc_id
"""

_LINE_RULES = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
ws AS (SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS i FROM d),
v AS (SELECT doc_id, i, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' || lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS g
      FROM ws WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
rep AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM v WHERE g IS NOT NULL) WHERE c > 1),
rw AS (SELECT doc_id, CAST(sum(least(5, coalesce(nx - i, 5))) AS BIGINT) AS n
       FROM (SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nx FROM rep) GROUP BY doc_id),
ls AS (SELECT doc_id, source, unnest(string_split(t, chr(10))) AS line FROM d),
ln AS (SELECT *, translate(trim(regexp_replace(line, '[\x20\x09-\x0D]+', ' ', 'g')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000') AS nl,
              len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) AS nw FROM ls WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM ln GROUP BY doc_id),
hd AS (SELECT source, count(DISTINCT doc_id) AS docs FROM d GROUP BY source),
lf AS (SELECT ln.source, nl, count(DISTINCT doc_id) AS c FROM ln GROUP BY ln.source, nl),
often AS (SELECT lf.source, nl FROM lf JOIN hd ON lf.source IS NOT DISTINCT FROM hd.source WHERE c > 50 AND c * 100 > docs),
lost AS (SELECT doc_id, CAST(sum(nw) AS BIGINT) AS n FROM ln JOIN often ON ln.source IS NOT DISTINCT FROM often.source AND ln.nl = often.nl GROUP BY doc_id),
b AS (SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words,
             CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
             CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
             CAST(coalesce(dup.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rw.n, 0) AS BIGINT) AS n_repeat_words,
             CAST(len(w) - coalesce(lost.n, 0) AS BIGINT) AS n_left
      FROM d LEFT JOIN dup ON d.doc_id = dup.doc_id LEFT JOIN rw ON d.doc_id = rw.doc_id LEFT JOIN lost ON d.doc_id = lost.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND n_left * 100 >= n_words * 30 AS kept, n_left
FROM b
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_mix_sources": _MIX, "op4_url_filter": _URL_FILTER, "op5_line_dedup": _LINE_DEDUP, "op5_line_dedup_runs": _LINE_RUNS, "op6_line_rules": _LINE_RULES}
